"""Visit-level detail (batch forms): daily unique visits and bounces.

Both key on the visitor id. A visitor may hold a large share of all rows, so
neither operator puts a whole visitor into one task:

* ``unique_visit`` is an aggregate per (visitor, day) with map-side partial
  aggregation;
* ``jump_detail`` needs each event's successors. It looks them up with a
  window over (visitor, time bucket) where each bucket also sees the first
  ``within`` of the next bucket (a copy of those few rows), so a task holds
  at most one visitor-bucket and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberflow.operators.logs import is_entry_page


def event_time(ts_millis: str = "ts"):
    return F.timestamp_millis(F.col(ts_millis))


def unique_visit(page_logs: DataFrame, key: str = "common.mid", ts: str = "ts",
                 seq: str = "seq") -> DataFrame:
    """First entry page of each visitor on each local day.

    The state-based original keeps the last emitted date per visitor (24 h
    TTL) and emits an entry page whose date differs; on ordered input that is
    exactly the first entry page per (visitor, day).
    """
    cols = page_logs.columns
    entries = page_logs.filter(is_entry_page("page.last_page_id"))
    firsts = (entries.groupBy(F.col(key).alias("_k"), F.to_date(event_time(ts)).alias("_d"))
              .agg(F.min_by(F.struct(*cols), F.struct(F.col(ts), F.col(seq))).alias("_r")))
    return firsts.select("_r.*")


def with_successors(df: DataFrame, key: str, ts: str, seq: str, within_ms: int,
                    n: int, cols: dict, bucket_ms: int | None = None) -> DataFrame:
    """Attach the next ``n`` events of the same key (by ``(ts, seq)``).

    For each lookahead ``i`` and each ``name -> expr`` in ``cols`` a column
    ``_nx{i}_{name}`` is added. Successors more than ``within_ms`` after the
    row may be reported as null: callers only look inside that range.
    """
    bucket_ms = bucket_ms or max(within_ms * 16, 60_000)
    if bucket_ms < within_ms:
        raise ValueError("bucket must be at least the lookahead range")
    base = df.withColumn("_key", F.col(key)).withColumn("_b", F.floor(F.col(ts) / bucket_ms))
    for name, expr in cols.items():
        base = base.withColumn(f"_c_{name}", expr)
    # rows in the first ``within`` of a bucket are copied into the bucket before, in the same pass
    own = F.struct(F.col("_b").alias("_b"), F.lit(True).alias("_own"))
    copy = F.struct((F.col("_b") - 1).alias("_b"), F.lit(False).alias("_own"))
    places = F.when(F.col(ts) - F.col("_b") * bucket_ms < within_ms, F.array(own, copy)).otherwise(F.array(own))
    ext = base.withColumn("_p", F.explode(places)).withColumn("_b", F.col("_p._b")).withColumn("_own", F.col("_p._own")).drop("_p")
    w = Window.partitionBy("_key", "_b").orderBy(F.col(ts), F.col(seq))
    for i in range(1, n + 1):
        ext = ext.withColumn(f"_nx{i}_ts", F.lead(F.col(ts), i).over(w))
        for name in cols:
            ext = ext.withColumn(f"_nx{i}_{name}", F.lead(F.col(f"_c_{name}"), i).over(w))
    return ext.filter("_own").drop("_own", "_key", "_b", *[f"_c_{c}" for c in cols])


def jump_detail(page_logs: DataFrame, within_ms: int = 10_000, times: int = 2,
                key: str = "common.mid", ts: str = "ts", seq: str = "seq",
                bucket_ms: int | None = None) -> DataFrame:
    """Bounce detection: an entry page followed by entry pages only.

    Pattern: ``times`` consecutive entry pages of one visitor (strict
    contiguity) inside ``within_ms``. The first row is emitted on a match or
    on timeout (no qualifying successor within range), and dropped when a
    successor inside the range is not an entry page. ``times=2`` is the
    ``begin.next`` form, other values the looped ``times(n).consecutive()``.
    """
    cols = page_logs.columns
    ext, jumped = _jumps(page_logs, within_ms, times, key, ts, seq, bucket_ms)
    return ext.filter(jumped).select(*cols)


def _jumps(page_logs: DataFrame, within_ms: int, times: int, key: str, ts: str, seq: str, bucket_ms: int | None) -> tuple[DataFrame, Column]:
    """Page rows with their successors, and whether a row is a bounce."""
    entry = is_entry_page("page.last_page_id")
    lookahead = times - 1
    ext = with_successors(page_logs.withColumn("_entry", entry), key, ts, seq, within_ms,
                          lookahead, {"entry": F.col("_entry")}, bucket_ms)
    # walk the successors: stop (emit) on the first missing / out-of-range one,
    # drop on the first in-range non-entry page, emit when all are entries.
    keep = F.lit(True)
    for i in range(lookahead, 0, -1):
        nts, nentry = F.col(f"_nx{i}_ts"), F.col(f"_nx{i}_entry")
        in_range = nts.isNotNull() & ((nts - F.col(ts)) < within_ms)
        keep = F.when(~in_range, F.lit(True)).when(~nentry, F.lit(False)).otherwise(keep)
    return ext, F.col("_entry") & keep


def visit_flags(logs: DataFrame, within_ms: int = 10_000, times: int = 2, key: str = "common.mid",
                ts: str = "ts", seq: str = "seq", bucket_ms: int | None = None) -> DataFrame:
    """Page rows of log rows with the repaired ``is_new`` flag, ``uv`` (first entry
    page of the visitor's day) and ``uj`` (bounce), found together.

    The same rows as ``repair_is_new``, ``unique_visit`` and ``jump_detail``
    give one after the other, with one aggregate per (visitor, day), one join
    back on it, and one window over (visitor, time bucket).
    """
    page, entry = F.coalesce(F.length("start"), F.lit(0)) == 0, is_entry_page("page.last_page_id")
    flagged = F.col("common.is_new") == "1"
    rows = logs.withColumns({"_k": F.col(key), "_d": F.to_date(event_time(ts)), "_o": F.struct(F.col(ts), F.col(seq))})
    days = (rows.groupBy("_k", "_d").agg(F.min(F.when(flagged, F.col("_o"))).alias("_flag"), F.min(F.when(page & entry, F.col("_o"))).alias("_visit"))
            .withColumn("_flag", F.min("_flag").over(Window.partitionBy("_k"))).withColumnsRenamed({"_k": "_k2", "_d": "_d2"}))
    rows = rows.where(page).join(days, F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_d") == F.col("_d2")), "left")
    again = flagged & F.col("_k").isNotNull() & (F.col("_o") != F.col("_flag"))
    rows = rows.withColumn("common", F.col("common").withField("is_new", F.when(again, F.lit("0")).otherwise(F.col("common.is_new"))))
    rows = rows.withColumn("uv", F.coalesce(entry & (F.col("_o") == F.col("_visit")), F.lit(False))).drop("_k", "_d", "_o", "_k2", "_d2", "_flag", "_visit")
    ext, jumped = _jumps(rows, within_ms, times, key, ts, seq, bucket_ms)
    return ext.withColumn("uj", F.coalesce(jumped, F.lit(False))).select(*rows.columns, "uj")
