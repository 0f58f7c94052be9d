"""Equality joins with a time band, and dimension enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_ms(ms: int) -> Column:
    """A day-time interval literal (kept literal so streaming joins can use it
    to evict state)."""
    return F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND")


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower_ms: int, upper_ms: int,
                  lower_inclusive: bool = True, upper_inclusive: bool = True,
                  how: str = "inner", bucketed: bool = False) -> DataFrame:
    """``left.key = right.key`` and ``right.time - left.time`` in ``[lower, upper]``.

    Both time columns are timestamps. In batch this is a shuffle (or
    broadcast) equi-join on the key with the band as a join filter; on two
    streams with watermarks Spark uses the band to evict old state.
    Columns of both sides are kept: callers rename clashes first.

    ``bucketed`` (batch, inner) adds a time bucket as wide as the band to the
    key, for keys with long histories: the work of a key grows with its rows in
    a band, not with the square of its history, and a busy key is spread over
    its buckets. The right rows stand in two buckets, each pair meets in one.
    """
    if bucketed:
        width = max(upper_ms - lower_ms, 1)
        place = F.floor((F.unix_micros(F.col(right_time)) / 1000 - lower_ms) / width)
        left = left.withColumn("_bucket", F.floor(F.unix_micros(F.col(left_time)) / 1000 / width))
        right = right.withColumn("_near", F.explode(F.array(place, place - 1)))
    lt, rt = left[left_time], right[right_time]
    lo = lt + interval_ms(lower_ms)
    hi = lt + interval_ms(upper_ms)
    cond = left[left_key] == right[right_key]
    cond = cond & ((rt >= lo) if lower_inclusive else (rt > lo))
    cond = cond & ((rt <= hi) if upper_inclusive else (rt < hi))
    if bucketed:
        return left.join(right, cond & (F.col("_bucket") == F.col("_near")), "inner").drop("_bucket", "_near")
    return left.join(right, cond, how)


def enrich(facts: DataFrame, dim: DataFrame, fact_key: str | Column,
           columns: dict[str, Column | str], dim_key: str = "ID",
           key_type: str | None = None) -> DataFrame:
    """Left-join dimension columns onto facts (missing dim row -> nulls).

    ``columns`` maps output name -> dim column (or expression over dim
    columns). The dim key is cast to ``key_type`` (the fact key's type) so the
    join hashes on a long, not a string. No broadcast hint: dims grow with the
    business, so the planner decides from size statistics and AQE switches to
    a broadcast at run time when the built side is below the threshold.
    """
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    sel = [F.col(dim_key).try_cast(key_type).alias("_dk") if key_type else
           F.col(dim_key).alias("_dk")]
    for name, expr in columns.items():
        sel.append((F.col(expr) if isinstance(expr, str) else expr).alias(f"_dim_{name}"))
    d = dim.select(*sel)
    out = facts.withColumn("_fk", fk).join(d, F.col("_fk") == F.col("_dk"), "left")
    for name in columns:
        out = out.withColumn(name, F.col(f"_dim_{name}"))
    return out.drop("_fk", "_dk", *[f"_dim_{n}" for n in columns])
