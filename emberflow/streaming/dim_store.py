"""Dimension tables that change batches write and lookups read.

A table is a ``SegmentTable`` of cells (key, column, value, number of the
commit): the newest value per key and column stands, so a column that no change
carries keeps its value, and the cost of a write follows the batch. Key and
columns are in the manifest, so a reader knows them without reading data.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflow.streaming.segments import Manifest, SegmentTable

CELLS = "pk string, col string, value string, version long"
BUCKETS = 64


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint; the same after a restart."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def _newest(cells: DataFrame) -> DataFrame:
    latest = cells.groupBy("pk", "col").agg(F.max("version").alias("version"), F.max_by("value", "version").alias("value"))
    return latest.select("pk", "col", "value", "version")


def table(spark: SparkSession, root: str, **options) -> SegmentTable:
    return SegmentTable(spark, root, CELLS, _newest, **options)


def buckets_of(extend: str | None) -> int:
    """Buckets that a table's extra clause asks for (``SALT_BUCKETS = n``)."""
    found = re.search(r"salt_buckets\s*=\s*(\d+)", extend or "", re.I)
    return max(1, int(found[1])) if found else BUCKETS


def create_dim(spark: SparkSession, root: str, columns: list[str], pk: str = "id", extend: str | None = None) -> None:
    """Make an empty table with its columns known, if there is none yet; the key cannot change."""
    t = table(spark, root)
    now = t.current()
    if now is None:
        t.commit(Manifest(buckets=buckets_of(extend), notes={"pk": pk, "columns": sorted({*columns, pk}), "extend": extend or ""}))
    elif now.notes["pk"] != pk:
        raise ValueError(f"{root} has the key {now.notes['pk']}, not {pk}")


def write_segment(spark: SparkSession, changes: DataFrame, root: str, pk: str, run: str, batch: int,
                  order: tuple = ("ts_ms", "partition", "seq"), **options) -> None:
    """Add the ``after`` maps of ``changes`` (already pruned) as one batch of the query ``run``.

    Within the batch the last change that carries a column counts. A batch that
    was committed before is left alone; changes without key are left out.
    """
    t = table(spark, root, **options)
    now = t.current()
    if now is not None and now.notes["pk"] != pk:
        raise ValueError(f"{root} has the key {now.notes['pk']}, not {pk}")
    seq = F.struct(*[F.col(c) for c in order if c in changes.columns])
    cells = (changes.select(F.col("after")[pk].alias("pk"), seq.alias("_seq"), F.explode("after").alias("col", "value")).where("pk is not null")
             .groupBy("pk", "col").agg(F.max_by(F.struct("value"), "_seq")["value"].alias("value")))

    def notes(written: DataFrame, old: dict) -> dict:
        seen = {r["col"] for r in written.select("col").distinct().collect()}  # the batch's columns
        return {"pk": pk, "extend": old.get("extend", ""), "columns": sorted({*old.get("columns", []), *seen, pk})}

    t.write(cells.withColumn("version", F.lit(0).cast("long")), run, batch, notes, buckets=BUCKETS, stamp="version")


def _wide(cells: DataFrame, pk: str, columns: list[str]) -> DataFrame:
    return (cells.groupBy("pk").agg(F.count(F.lit(1)).alias("_n"), *[F.max(F.when(F.col("col") == c, F.col("value"))).alias(c.upper()) for c in columns if c != pk])
            .drop("_n").withColumnRenamed("pk", pk.upper()))


def _shaped(df: DataFrame, columns: list[str] | None) -> DataFrame:
    missing = [c for c in columns or [] if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def _empty(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))


def read_dim(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame | None:
    """The current table: all-string columns with upper-case names.

    ``columns`` (upper-case) are there in any case, null where the table does
    not have them; with them, a table that was never written is an empty one,
    else None.
    """
    t = table(spark, root)
    now = t.current()
    if now is None:
        return None if columns is None else _empty(spark, columns)
    return _shaped(_wide(t.rows(now), now.notes["pk"], now.notes["columns"]), columns)


def lookup(spark: SparkSession, root: str, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``read_dim`` that have one of ``keys`` (one column, compared as text), read by key.

    A table that was never written has none.
    """
    t = table(spark, root)
    now = t.current()
    if now is None:
        return _empty(spark, columns)
    return _shaped(_wide(t.rows_of(now, keys), now.notes["pk"], now.notes["columns"]), columns)
