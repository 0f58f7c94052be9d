"""Streaming forms of the warehouse stages.

Every stage reuses the batch transforms; only the three per-visitor state
machines use custom state (``processors``). Sources are any streaming
DataFrame (Kafka topic or a file folder read with ``readStream``); sinks go
through ``sinks`` so a replayed micro-batch overwrites its own output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberflow import schemas as S
from emberflow.operators import logs, stats
from emberflow.streaming import sinks
from emberflow.streaming.processors import (COLS, PAYLOAD_ROW, STREAM_PAGE, IsNewRepair,
                                            JumpDetail, UniqueVisit)

#: Begins the keys under which dirty lines pass the keyed state; no visitor id has a control character.
DIRTY_KEY = "\x00dirty-"


def flat_page_rows(page_logs: DataFrame) -> DataFrame:
    """Page-log structs -> the flat row the stateful operators use."""
    return page_logs.select(
        F.col("common.mid").alias("mid"), "seq", "ts", F.col("common.is_new").alias("is_new"),
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"), F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"), F.col("page.item").alias("item"),
        F.col("page.item_type").alias("item_type"),
        F.col("page.during_time").alias("during_time"))


def struct_page_rows(flat: DataFrame) -> DataFrame:
    """Flat rows -> page-log struct shape (``common``, ``page``, ``ts``, ``seq``)."""
    return flat.select(
        "seq",
        F.struct(*[F.col(c) for c in ("ar", "ch", "is_new", "mid", "vc")]).alias("common"),
        F.struct(F.col("during_time"), F.col("item"), F.col("item_type"),
                 F.col("last_page_id"), F.col("page_id")).alias("page"),
        F.lit(None).cast("array<struct<display_type:string,item:string,item_type:string,"
                         "order:int,pos_id:int>>").alias("displays"),
        F.lit(None).cast("string").alias("start"), "ts")


def repair_is_new_stream(flat: DataFrame) -> DataFrame:
    """Stream form of ``logs.repair_is_new`` (state: one flag per visitor)."""
    return flat.select(*COLS).groupBy("mid").transformWithStateInPandas(
        IsNewRepair(), STREAM_PAGE, "append", "None")


def unique_visit_stream(flat_pages: DataFrame, tz: str | None = None, delay: str = "1 second") -> DataFrame:
    """Stream form of ``visits.unique_visit`` (last emitted date, kept until 24 h
    of event time after it was written). Days are local to ``tz`` (default: the
    session time zone); rows later than ``delay`` are dropped."""
    tz = tz or flat_pages.sparkSession.conf.get("spark.sql.session.timeZone")
    src = (flat_pages.select(*COLS).withColumn("rt", F.timestamp_millis("ts"))
           .withWatermark("rt", delay))
    return src.groupBy("mid").transformWithStateInPandas(
        UniqueVisit(tz), STREAM_PAGE, "append", "EventTime")


def jump_detail_stream(flat_pages: DataFrame, within_ms: int = 10_000, times: int = 2,
                       delay: str = "1 second", bucket_ms: int | None = None) -> DataFrame:
    """Stream form of ``visits.jump_detail``: event-time timers at
    ``ts + within``, watermark ``delay`` (1 s bound in the original). State is
    keyed by visitor and time bucket, as the batch form's windows are."""
    bucket_ms = bucket_ms or max(within_ms * 16, 60_000)
    if bucket_ms < within_ms:
        raise ValueError("bucket must be at least the lookahead range")
    src = (flat_pages.select(*COLS).withColumn("rt", F.timestamp_millis("ts"))
           .withWatermark("rt", delay))
    b = F.floor(F.col("ts") / bucket_ms)
    own, copy = F.struct(b.alias("bucket"), F.lit(True).alias("own")), F.struct((b - 1).alias("bucket"), F.lit(False).alias("own"))
    places = F.when(F.col("ts") - b * bucket_ms < within_ms, F.array(own, copy)).otherwise(F.array(own))
    src = src.select("*", F.inline(places))
    return src.groupBy("mid", "bucket").transformWithStateInPandas(
        JumpDetail(within_ms, times), STREAM_PAGE, "append", "EventTime")


def visitor_stats_stream(uv_flat: DataFrame, uj_flat: DataFrame, page_flat: DataFrame,
                         delay: str = "11 seconds") -> DataFrame:
    """Three flat streams -> ten-second visitor stats (append mode)."""
    return stats.visitor_stats(stats.union_visitor(struct_page_rows(uv_flat),
                                                   struct_page_rows(uj_flat),
                                                   struct_page_rows(page_flat)), delay)


def repair_log_rows_stream(clean_rows: DataFrame) -> DataFrame:
    """``is_new`` repair over whole log rows (start rows, displays and all):
    the row travels through the keyed state as JSON text and is rebuilt."""
    payload = clean_rows.select(
        F.col("common.mid").alias("mid"), "seq", "ts", F.col("common.is_new").alias("is_new"),
        F.to_json(F.struct("common", "page", "displays", "start", "ts")).alias("payload"))
    fixed = payload.groupBy("mid").transformWithStateInPandas(
        IsNewRepair([f.name for f in PAYLOAD_ROW.fields]), PAYLOAD_ROW, "append", "None")
    return log_rows(fixed)


def log_rows(fixed: DataFrame) -> DataFrame:
    """Log rows rebuilt from their JSON text and the repaired flag."""
    r = F.from_json("payload", S.PAGE_LOG)
    return fixed.select("seq", "is_new", F.inline(F.array(F.struct(r.alias("r"))))).select(
        "seq", F.col("r.common").withField("is_new", F.col("is_new")).alias("common"),
        "r.page", "r.displays", "r.start", "r.ts")


def write_log_split(batch: DataFrame, out_root: str, batch_id: int, run: str = "batch") -> None:
    """One micro-batch of repaired rows -> start / page / display outputs.
    The batch is persisted because three writes read it."""
    batch.persist()
    try:
        pages = logs.split_page(batch)
        for name, rows in (("dwd_start_log", logs.split_start(batch)), ("dwd_page_log", pages),
                           ("dwd_display_log", logs.split_display(pages))):
            sinks.commit_batch(rows.sparkSession, f"{out_root}/{name}", run, batch_id, rows.write.json)
    finally:
        batch.unpersist()


def tagged_log_stream(raw: DataFrame, salts: int = 64) -> DataFrame:
    """Every line of a stream ``(seq, value)``, parsed once: dirty lines as they
    are (``value``), the others with the repaired flag (``payload``).

    Dirty lines belong to no visitor; they pass under ``salts`` keys of their
    own, which hold no state.
    """
    parsed = logs.parse_log(raw)
    # dirty lines go through the keyed state untouched, spread over some keys
    mid = F.when(F.col("is_dirty"), F.concat(F.lit(DIRTY_KEY), F.pmod(F.xxhash64("seq"), F.lit(salts)).cast("string"))).otherwise(F.col("common.mid"))
    payload = F.when(F.col("is_dirty"), F.col("_line")).otherwise(F.to_json(F.struct("common", "page", "displays", "start", "ts")))
    rows = parsed.select(mid.alias("mid"), "seq", F.when(F.col("is_dirty"), F.lit(0).cast("bigint")).otherwise(F.col("ts")).alias("ts"), F.when(~F.col("is_dirty"), F.col("common.is_new")).alias("is_new"), payload.alias("payload"))
    return rows.groupBy("mid").transformWithStateInPandas(IsNewRepair([f.name for f in PAYLOAD_ROW.fields]), PAYLOAD_ROW, "append", "None")


def write_tagged(batch: DataFrame, out_root: str, batch_id: int, run: str = "batch") -> None:
    """One micro-batch of tagged lines -> dirty / start / page / display outputs."""
    batch.persist()
    try:
        dirty = F.coalesce(F.col("mid").startswith(DIRTY_KEY), F.lit(False))
        lines = batch.where(dirty).select("seq", F.col("payload").alias("value"))
        sinks.commit_batch(batch.sparkSession, f"{out_root}/dirty", run, batch_id, lines.write.json)
        write_log_split(log_rows(batch.where(~dirty)), out_root, batch_id, run)
    finally:
        batch.unpersist()


def log_stage_stream(raw: DataFrame, out_root: str, checkpoint_root: str,
                     trigger: dict | None = None) -> list:
    """The whole log stage on a stream of ``(seq, value)`` lines: dirty lines
    to their own output, the rest repaired (keyed state) and split three ways,
    by one query that reads and parses every line once."""
    return [sinks.foreach_batch(tagged_log_stream(raw), lambda b, i, run: write_tagged(b, out_root, i, run),
                                os.path.join(checkpoint_root, "split"), trigger)]
