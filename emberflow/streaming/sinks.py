"""Sinks. Stream writes go through ``foreachBatch`` into folders named by the
query's id and the batch id. A batch is written into a hidden folder and moved
to its own in one step: readers, streams too, see all of it or nothing, and a
batch that is replayed after its folder is there is not written again. So files
are exactly-once on top of Spark's at-least-once batches, for readers that have
read a batch already as well. A query with a fresh checkpoint writes beside the
earlier one's. (The step is atomic where the file system renames folders
atomically, as HDFS and local disks do.)"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflow.operators import cdc
from emberflow.sources import files
from emberflow.streaming import dim_store, images


def batch_folder(root: str, run: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/run={run}/batch_id={batch_id}"


def commit_batch(spark: SparkSession, root: str, run: str, batch_id: int, write: Callable[[str], None]) -> bool:
    """Let ``write(folder)`` make a batch's folder, once; False if it was there already.

    The hidden folder of an attempt that failed is replaced.
    """
    target = batch_folder(root, run, batch_id)
    if files.exists(spark, target):
        return False
    hidden = batch_folder(f"{root.rstrip('/')}/_attempts", run, batch_id)
    files.delete(spark, hidden)
    write(hidden)
    files.move(spark, hidden, target)
    return True


def write_report(df: DataFrame, path: str | None, columns: list[str], batch_id: int | None = None,
                 fmt: str = "parquet", options: dict | None = None, run: str = "batch",
                 batch_column: str | None = None) -> None:
    """Positional report insert: columns in contract order, accumulator
    (transient) columns left out by the explicit ``select``.

    Files of a batch go to its folder once. A database
    (``fmt='jdbc'``) is appended to, ``batchsize`` rows a statement; it cannot
    undo a replayed batch, so ``batch_column`` names a column that gets
    ``run/batch`` for a key or a clean-up there.
    """
    out = df.select(*columns)
    if fmt == "jdbc":
        if batch_column:
            out = out.withColumn(batch_column, F.lit(f"{run}/{batch_id}"))
        out.write.format(fmt).mode("append").options(**{"batchsize": "1000", **(options or {})}).save()
        return
    writer = out.write.format(fmt).options(**(options or {}))
    if batch_id is None:
        writer.mode("append").save(path)
    else:
        commit_batch(df.sparkSession, path, run, batch_id, writer.save)


def foreach_batch(df: DataFrame, write: Callable[[DataFrame, int, str], None], checkpoint: str,
                  trigger: dict | None = None, output_mode: str = "append"):
    """Start a query that calls ``write(batch, batch id, query id)``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id, dim_store.run_of(batch.sparkSession, checkpoint))
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(run)
    return (w.trigger(**trigger) if trigger else w).start()


def report_stream(df: DataFrame, path: str | None, columns: list[str], checkpoint: str,
                  trigger: dict | None = None, output_mode: str = "append", fmt: str = "parquet",
                  options: dict | None = None, batch_column: str | None = None):
    """Stream a report table into ``path`` (one folder per micro-batch) or a database."""
    return foreach_batch(df, lambda b, i, run: write_report(b, path, columns, i, fmt, options, run, batch_column),
                         checkpoint, trigger, output_mode)


def write_topic_per_row(df: DataFrame, path: str, batch_id: int | None = None, run: str = "batch",
                        fmt: str = "text", options: dict | None = None) -> None:
    """Facts to the topic named by each row's ``sink_table``; payload is the
    pruned ``after`` image. File form: one folder per topic; ``fmt='kafka'``
    sends each row to its topic."""
    payload = F.to_json("after").alias("value")
    if fmt == "kafka":
        df.select(F.col("sink_table").alias("topic"), payload).write.format("kafka").options(**(options or {})).save()
        return
    writer = df.select("sink_table", payload).write.partitionBy("sink_table")
    if batch_id is None:
        writer.mode("overwrite").text(path)
    else:
        commit_batch(df.sparkSession, path, run, batch_id, writer.text)


def route_batch(spark: SparkSession, envelopes: DataFrame, config: DataFrame, out_root: str,
                batch_id: int, run: str = "batch") -> None:
    """One micro-batch of change routing: facts per topic, dims upserted.

    The config is re-read for every batch, so a new route applies from the
    next batch on; a log of its versions (``effective_ms``) is read as of each
    record's time, so a replay or a backfill routes as the first run did. The parsed batch is persisted because the outputs read it.
    Each dimension gets one segment, whatever number of routes feed it.
    """
    batch = envelopes.persist()
    try:
        facts, dims = cdc.route(batch, config)
        write_topic_per_row(facts, f"{out_root}/topics", batch_id, run)
        # config rows are a handful per table
        versions = config if "effective_ms" in config.columns else cdc.current_config(config)
        tables = (versions.filter(F.col("sink_type") == "hbase").groupBy("sink_table")
                  .agg(F.collect_set(F.coalesce("sink_pk", F.lit("id"))).alias("keys"), F.max("sink_extend").alias("extend"),
                       F.collect_set("sink_columns").alias("lists")).collect())
        for row in tables:
            if len(row["keys"]) > 1:
                raise ValueError(f"routes to {row['sink_table']} name different keys: {sorted(row['keys'])}")
            root, pk = f"{out_root}/dims/{row['sink_table']}", row["keys"][0]
            columns = sorted({c for names in row["lists"] for c in names.split(",")})
            dim_store.create_dim(spark, root, columns, pk, row["extend"])
            dim_store.write_segment(spark, dims.filter(F.col("sink_table") == row["sink_table"]), root, pk, run, batch_id)
        unrouted = cdc.route_unmatched(cdc.cdc_drop_deletes(batch), config)
        commit_batch(spark, f"{out_root}/unrouted", run, batch_id, unrouted.write.json)
    finally:
        batch.unpersist()


def route_stream(envelope_stream: DataFrame, config_path: str, out_root: str,
                 checkpoint: str, trigger: dict | None = None):
    """Change routing as a stream (``foreachBatch``)."""
    return foreach_batch(envelope_stream, lambda b, i, run: route_batch(
        b.sparkSession, b, b.sparkSession.read.parquet(config_path), out_root, i, run), checkpoint, trigger)


def config_log_stream(envelope_stream: DataFrame, log_path: str, checkpoint: str, table: str = "table_process",
                      trigger: dict | None = None):
    """Land the change records of the configuration table as the log of its versions, which ``route_stream`` reads."""
    changes = cdc.config_from_changes(envelope_stream, table)
    return foreach_batch(changes, lambda b, i, run: commit_batch(b.sparkSession, log_path, run, i, b.write.parquet), checkpoint, trigger)


def current_image_stream(envelope_stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, pk: str = "id"):
    """``cdc.cdc_current_image`` kept as a table below ``root`` by a stream of envelopes."""
    return foreach_batch(envelope_stream, lambda b, i, run: images.write_images(b.sparkSession, b, root, run, i, pk), checkpoint, trigger)


def console(df: DataFrame, checkpoint: str | None = None):
    w = df.writeStream.format("console").option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()
