"""The newest image of every row of changed tables, kept as a table by batches of changes.

Batches may split the change log anywhere and bring records late: of a row's
changes the one with the highest (ts_ms, partition, seq) stands, whichever
batch it was in. A deleted row stays as a mark (an earlier change that comes
later must not bring it back) and is not shown. A table that gets the images as
retract pairs needs no state: ``cdc.retract_rows`` works on the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflow.streaming.segments import Manifest, SegmentTable

ROWS = ("pk string, database string, tableName string, id string, type string, image map<string,string>, "
        "ts_ms long, partition int, seq long")


def _newest(rows: DataFrame) -> DataFrame:
    every = [c for c in rows.columns if c not in ("pk", "database", "tableName", "id")]
    latest = rows.groupBy("pk").agg(*[F.first(c).alias(c) for c in ("database", "tableName", "id")],
                                    F.max_by(F.struct(*every), F.struct("ts_ms", "partition", "seq")).alias("_r"))
    return latest.select("pk", "database", "tableName", "id", *[F.col(f"_r.{c}").alias(c) for c in every])


def table(spark: SparkSession, root: str, **options) -> SegmentTable:
    return SegmentTable(spark, root, ROWS, _newest, **options)


def write_images(spark: SparkSession, envelopes: DataFrame, root: str, run: str, batch: int, pk: str = "id", **options) -> Manifest:
    """Add a batch of change envelopes, once. Rows without key are one row of their table."""
    given = {c: F.col(c) if c in envelopes.columns else F.lit(None) for c in ("ts_ms", "partition", "seq")}
    key = F.coalesce(F.col("after")[pk], F.col("before")[pk])
    rows = envelopes.select(F.to_json(F.array("database", "tableName", key)).alias("pk"), "database", "tableName", key.alias("id"), "type", F.col("after").alias("image"),
                            given["ts_ms"].cast("long").alias("ts_ms"), given["partition"].cast("int").alias("partition"), given["seq"].cast("long").alias("seq"))
    return table(spark, root, **options).write(rows, run, batch)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """``database, tableName, pk, image, last_type, ts_ms, partition, seq`` of the rows that are not deleted."""
    t = table(spark, root)
    rows = t.rows(t.current() or Manifest())
    return rows.where(~F.col("type").eqNullSafe("delete")).select("database", "tableName", F.col("id").alias("pk"), "image", F.col("type").alias("last_type"),
                                                                 "ts_ms", "partition", "seq")
