"""App-log stage: parse, dirty branch, new-visitor repair, three-way split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberflow import schemas as S

_CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(S.PAGE_LOG.fields + [T.StructField(_CORRUPT, T.StringType())])


def is_entry_page(last_page_id: str | Column = "page.last_page_id") -> Column:
    """``last_page_id`` is null or empty: the visit starts on this page."""
    c = F.col(last_page_id) if isinstance(last_page_id, str) else last_page_id
    return F.coalesce(F.length(c), F.lit(0)) == 0


def parse_log(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON log lines; flag the lines that do not parse as an object.

    Output: every input column except ``value_col``, the page-log fields, and
    ``is_dirty``. A line is dirty only when it is not JSON text or not an
    object (what the original parser rejects); a well-formed object with an
    odd field type is kept. Lines flagged by the typed parse are re-checked
    with ``try_parse_json`` only on that (rare) branch, so clean lines are
    parsed once.
    """
    v = F.col(value_col)
    parsed = F.from_json(v, _PARSE_SCHEMA, {"mode": "PERMISSIVE",
                                            "columnNameOfCorruptRecord": _CORRUPT})
    keep = [c for c in raw.columns if c != value_col]
    # ``inline`` of a one-row array is a plan barrier: predicates on the parse
    # result (the dirty split) stay above it, so each line is parsed once
    # instead of once per filter that Catalyst would push below the parse.
    df = raw.select(*keep, F.inline(F.array(F.struct(v.alias("_line"), parsed.alias("_p")))))
    bad_text = F.expr("try_parse_json(_line)").isNull() | ~F.ltrim("_line").startswith("{")
    dirty = (F.col("_line").isNull()
             | F.when(F.col(f"_p.{_CORRUPT}").isNotNull(), bad_text).otherwise(F.lit(False)))
    return df.select(*keep, "_line", *[F.col(f"_p.{f.name}").alias(f.name)
                                       for f in S.PAGE_LOG.fields],
                     dirty.alias("is_dirty"))


def dirty_lines(parsed: DataFrame) -> DataFrame:
    """Side output of unparsable lines: ``(…, value)``."""
    keep = [c for c in parsed.columns if c not in {f.name for f in S.PAGE_LOG.fields}
            and c not in ("is_dirty", "_line")]
    return parsed.filter("is_dirty").select(*keep, F.col("_line").alias("value"))


def clean_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_dirty")).drop("is_dirty", "_line")


def repair_is_new(logs: DataFrame, key: str = "common.mid", order: tuple = ("ts", "seq"),
                  flag: str = "common.is_new") -> DataFrame:
    """Per visitor, only the first row flagged ``is_new='1'`` keeps it.

    Later ``'1'`` rows of that visitor become ``'0'``; ``'0'`` rows are left
    alone and do not count. Written as an aggregate (first flagged row per
    visitor, partially aggregated before the shuffle, so a hot visitor costs
    one row per map task) joined back on the visitor key; AQE splits a
    skewed side of that join.
    """
    ordering = F.struct(*[F.col(c) for c in order])
    tagged = logs.withColumn("_k", F.col(key)).withColumn("_o", ordering)
    firsts = (tagged.filter(F.col(flag) == "1").groupBy("_k")
              .agg(F.min("_o").alias("_first")))
    joined = tagged.join(firsts, "_k", "left")
    new_flag = (F.when((F.col(flag) == "1") & (F.col("_o") != F.col("_first")), F.lit("0"))
                .otherwise(F.col(flag)))
    out = joined.withColumn("common", F.col("common").withField("is_new", new_flag)) \
        if flag == "common.is_new" else joined.withColumn(flag, new_flag)
    return out.drop("_k", "_o", "_first")


def split_start(logs: DataFrame) -> DataFrame:
    """Start logs: ``start`` is non-empty."""
    return logs.filter(F.coalesce(F.length("start"), F.lit(0)) > 0)


def split_page(logs: DataFrame) -> DataFrame:
    """Page logs: everything that is not a start log (null-safe complement)."""
    return logs.filter(F.coalesce(F.length("start"), F.lit(0)) == 0)


def split_display(page_logs: DataFrame) -> DataFrame:
    """One row per ``displays`` element plus the parent ``page_id``.

    Rows without displays produce nothing (plain ``explode``).
    """
    return page_logs.select(F.explode("displays").alias("d"),
                            F.col("page.page_id").alias("page_id")).select("d.*", "page_id")


def flatten_page(page_logs: DataFrame) -> DataFrame:
    """Flat page-log columns (handy for reports and comparisons)."""
    extra = [c for c in page_logs.columns if c not in {f.name for f in S.PAGE_LOG.fields}]
    return page_logs.select(*extra, "common.*", "page.*", "ts")


def page_table(page_logs: DataFrame) -> DataFrame:
    """The SQL page table: ``common MAP<STRING,STRING>, page MAP<STRING,STRING>, ts``."""
    def as_map(struct_name: str, struct_type: T.StructType) -> Column:
        args = []
        for f in struct_type.fields:
            args += [F.lit(f.name), F.col(f"{struct_name}.{f.name}").cast("string")]
        return F.map_filter(F.create_map(*args), lambda k, v: v.isNotNull())
    return page_logs.select(as_map("common", S.COMMON).alias("common"),
                            as_map("page", S.PAGE).alias("page"), "ts")
