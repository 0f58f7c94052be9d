"""Topic and table readers.

A topic is read either from Kafka (when its connector is on the classpath)
or from a folder of text / JSON files, batch or streaming. Both give a
``value STRING`` column (plus an offset-like ``seq`` where the source has
one), so the transforms downstream do not care which one it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberflow.functions.scalars import event_time_whole_seconds


def read_topic(spark: SparkSession, topic: str, *, stream: bool = True,
               fmt: str = "kafka", path: str | None = None,
               bootstrap_servers: str | None = None, starting: str = "latest",
               max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Read a topic as ``topic STRING, value STRING``.

    ``fmt='kafka'`` needs the Kafka connector and ``bootstrap_servers``; the
    record's ``partition``, offset (``seq``: a position within its partition)
    and ``timestamp`` come along. ``options`` go to the source as they are (they
    win over ``starting``). ``fmt='text'`` reads one record per line from
    ``path`` (a folder the producer drops files into).
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", topic))
        r = r.options(**{"startingOffsets": starting, **(options or {})})
        df = r.load()
        return df.select("topic", F.col("value").cast("string").alias("value"),
                         F.col("offset").alias("seq"), F.col("partition"), F.col("timestamp"))
    if fmt == "text":
        r = reader.format("text")
        r = r.options(**(options or {}))
        if stream and max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path).select(F.lit(topic).alias("topic"), "value")
    raise ValueError(f"unknown topic format {fmt!r}")


def write_topic(df: DataFrame, topic: str, *, fmt: str = "kafka",
                bootstrap_servers: str | None = None, path: str | None = None,
                checkpoint: str | None = None, trigger: dict | None = None, options: dict | None = None):
    """Write rows as JSON strings to a topic (streaming ``df``); ``options`` go to the sink."""
    payload = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    w = payload.writeStream.options(**(options or {}))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "kafka":
        return (w.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
                .option("topic", topic).start())
    return w.format("text").option("path", path).start()


def topic_table(lines_or_rows: DataFrame, ts_col: str = "ts", delay: str | None = "1 second",
                schema: T.StructType | None = None, value_col: str = "value") -> DataFrame:
    """SQL-style source table: parsed rows + ``rt`` computed from epoch-millis
    ``ts`` (whole seconds) + watermark ``rt - delay`` on streams.

    Pass raw lines with ``schema`` to parse JSON first, or already-parsed rows.
    """
    df = lines_or_rows
    if schema is not None:
        df = df.select(F.from_json(F.col(value_col), schema).alias("_j")).select("_j.*")
    df = df.withColumn("rt", event_time_whole_seconds(ts_col))
    if df.isStreaming and delay is not None:
        df = df.withWatermark("rt", delay)
    return df


def parse_csv_lines(lines: DataFrame, names: list[str], value_col: str = "value") -> DataFrame:
    """``"a,b,c"`` -> named string columns (first ``len(names)`` fields)."""
    parts = F.split(F.col(value_col), ",")
    return lines.select(*[F.trim(parts.getItem(i)).alias(n) for i, n in enumerate(names)])


def read_dim_table(spark: SparkSession, path: str, fmt: str = "parquet",
                   options: dict | None = None) -> DataFrame:
    """A dimension table: Parquet folder (default) or any DataFrame source,
    e.g. ``fmt='jdbc'`` with url/dbtable options."""
    r = spark.read.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()
