"""Stream jobs wired topic to topic, one starter per warehouse job.

A topic is named by a ``Topic``: a folder of JSON files, or a Kafka topic with
its servers. Each job reads its input topics as streams, runs the library
transforms and writes its output topic or report table, with its own checkpoint
under ``checkpoint_root``. Jobs can run in separate applications, as the
original jobs do.

Jobs with dimension lookups take ``stored_dims``, which reads the rows of each
micro-batch's keys, or a function that is called for every micro-batch; either
way a batch sees the dimension tables as they are then.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emberflow import schemas as S
from emberflow.operators import stats, wide
from emberflow.sources import topics
from emberflow.streaming import dim_store, jobs, sinks

Lookups = Callable[[SparkSession], dict[str, DataFrame]]


@dataclass(frozen=True)
class Topic:
    """A topic: a folder (``path``) of JSON lines, or ``name`` at ``servers``.

    ``options`` go to the source and the sink as they are (start offsets, rate
    limits, security). ``record_time`` names a column that gets the record's own
    time (of a folder, its file's), for jobs that fall back on it; ``offsets``
    adds ``topic_partition`` and ``topic_offset`` of a Kafka topic.
    """

    path: str | None = None
    name: str | None = None
    servers: str | None = None
    max_files: int | None = None
    options: dict = field(default_factory=dict)
    record_time: str | None = None
    offsets: bool = False

    @classmethod
    def of(cls, topic: str | "Topic") -> "Topic":
        return topic if isinstance(topic, Topic) else cls(path=topic)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The topic's rows as a stream."""
        if self.path:
            r = spark.readStream.schema(schema).option("recursiveFileLookup", "true").options(**self.options)
            rows = (r.option("maxFilesPerTrigger", self.max_files) if self.max_files else r).json(self.path)
            if self.record_time:
                rows = rows.select(*[F.col(f"`{f.name}`") for f in schema], F.col("_metadata.file_modification_time").alias(self.record_time))
            return rows
        return self.parsed(topics.read_topic(spark, self.name, bootstrap_servers=self.servers, options=self.options), schema)

    def parsed(self, raw: DataFrame, schema: T.StructType) -> DataFrame:
        """Rows of raw records (value, timestamp, partition, seq), each parsed once."""
        extra = [F.col("timestamp").alias(self.record_time)] if self.record_time else []
        if self.offsets:
            extra += [F.col("partition").alias("topic_partition"), F.col("seq").alias("topic_offset")]
        record = F.inline(F.array(F.from_json("value", schema)))
        return raw.select(record, *extra)

    def write_batch(self, rows: DataFrame, batch_id: int, run: str) -> None:
        """One micro-batch: a folder of its own, or records to the servers."""
        if self.path:
            sinks.commit_batch(rows.sparkSession, self.path, run, batch_id, rows.write.json)
        else:
            (rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.format("kafka").options(**self.options)
             .option("kafka.bootstrap.servers", self.servers).option("topic", self.name).save())

    def start(self, rows: DataFrame, checkpoint: str, trigger: dict | None) -> StreamingQuery:
        """Append a stream to the topic (the file sink is exactly-once)."""
        if not self.path:
            return topics.write_topic(rows, self.name, bootstrap_servers=self.servers, checkpoint=checkpoint, trigger=trigger, options=self.options)
        w = (rows.writeStream.format("json").option("path", self.path)
             .option("checkpointLocation", checkpoint).outputMode("append"))
        return (w.trigger(**trigger) if trigger else w).start()


class StoredDims:
    """Lookups of dimension tables kept by ``dim_store``: name -> folder below ``root``.

    ``for_batch`` reads the rows of a batch's keys only. Tables that do not
    exist yet are empty. Names are those of ``wide.order_wide``.
    """

    #: Columns that the lookups read of each dimension.
    COLUMNS = {"user": ["ID", "GENDER", "BIRTHDAY"], "province": ["ID", "NAME", "AREA_CODE", "ISO_CODE", "ISO_3166_2"],
               "sku": ["ID", "SKU_NAME", "PRICE", "SPU_ID", "TM_ID", "CATEGORY3_ID"], "spu": ["ID", "SPU_NAME"], "tm": ["ID", "TM_NAME"],
               "category3": ["ID", "NAME"]}
    #: Which column of a batch, or of the sku rows found, names a dimension's key.
    FACT_KEYS = {"user": "user_id", "province": "province_id", "sku": "sku_id"}
    SKU_KEYS = {"spu": "SPU_ID", "tm": "TM_ID", "category3": "CATEGORY3_ID"}

    def __init__(self, root: str, names: dict[str, str]):
        self.root, self.names = root, names

    def __call__(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {k: dim_store.read_dim(spark, f"{self.root}/{folder}", self.COLUMNS.get(k)) for k, folder in self.names.items()}

    def _rows(self, name: str, keys: DataFrame) -> DataFrame:
        return dim_store.lookup(keys.sparkSession, f"{self.root}/{self.names[name]}", keys, self.COLUMNS[name])

    def for_batch(self, batch: DataFrame) -> dict[str, DataFrame]:
        found = {k: self._rows(k, batch.select(c)) for k, c in self.FACT_KEYS.items() if k in self.names and c in batch.columns}
        if "sku" in found:
            found |= {k: self._rows(k, found["sku"].select(c)) for k, c in self.SKU_KEYS.items() if k in self.names}
        return found


def stored_dims(root: str, names: dict[str, str]) -> StoredDims:
    return StoredDims(root, names)


def _dims_of(lookups: Lookups | StoredDims, batch: DataFrame) -> dict[str, DataFrame]:
    return lookups.for_batch(batch) if isinstance(lookups, StoredDims) else lookups(batch.sparkSession)


def _topic(path: str | Topic, max_files: int | None = None) -> Topic:
    topic = Topic.of(path)
    return replace(topic, max_files=max_files) if max_files else topic


def start_order_wide(spark: SparkSession, order_info_topic: str | Topic, order_detail_topic: str | Topic,
                     order_info_schema: T.StructType, order_detail_schema: T.StructType,
                     dims: dict[str, DataFrame] | Lookups | StoredDims, out_topic: str | Topic, checkpoint_root: str,
                     lower_ms: int = -5_000, upper_ms: int = 5_000,
                     trigger: dict | None = None, as_of=None,
                     max_files_per_trigger: int | None = None, record_time: str | None = None) -> StreamingQuery:
    """dwd_order_info + dwd_order_detail -> dwm_order_wide: interval join with
    monotonous watermarks, then the lookups of each micro-batch."""
    o = _topic(order_info_topic, max_files_per_trigger).read(spark, order_info_schema)
    d = _topic(order_detail_topic, max_files_per_trigger).read(spark, order_detail_schema)
    merged = wide.order_wide_merge(wide.order_detail_join(o, d, lower_ms, upper_ms, "0 seconds", record_time))
    lookups = dims if callable(dims) else (lambda _: dims)

    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        batch.persist()  # the keys are read before the rows
        try:
            rows = wide.order_wide_lookups(batch, _dims_of(lookups, batch), as_of)
            Topic.of(out_topic).write_batch(rows, batch_id, run)
        finally:
            batch.unpersist()

    return sinks.foreach_batch(merged, write, os.path.join(checkpoint_root, "order_wide"), trigger)


def start_payment_wide(spark: SparkSession, payment_topic: str | Topic, order_wide_topic: str | Topic,
                       payment_schema: T.StructType, order_wide_schema: T.StructType, out_topic: str | Topic,
                       checkpoint_root: str, lower_ms: int = -15 * 60_000, upper_ms: int = 5_000,
                       trigger: dict | None = None, record_time: str | None = None) -> StreamingQuery:
    """dwd_payment_info + dwm_order_wide -> dwm_payment_wide."""
    p = Topic.of(payment_topic).read(spark, payment_schema)
    w = Topic.of(order_wide_topic).read(spark, order_wide_schema)
    rows = wide.payment_wide_merge(wide.payment_wide_join(p, w, lower_ms, upper_ms, "0 seconds", record_time))
    return Topic.of(out_topic).start(rows, os.path.join(checkpoint_root, "payment_wide"), trigger)


def start_unique_visit(spark: SparkSession, page_topic: str | Topic, page_schema: T.StructType, out_topic: str | Topic,
                       checkpoint_root: str, trigger: dict | None = None) -> StreamingQuery:
    """dwd_page_log -> dwm_unique_visit."""
    rows = jobs.unique_visit_stream(Topic.of(page_topic).read(spark, page_schema))
    return Topic.of(out_topic).start(rows, os.path.join(checkpoint_root, "unique_visit"), trigger)


def start_jump_detail(spark: SparkSession, page_topic: str | Topic, page_schema: T.StructType, out_topic: str | Topic,
                      checkpoint_root: str, within_ms: int = 10_000, times: int = 2, trigger: dict | None = None) -> StreamingQuery:
    """dwd_page_log -> dwm_user_jump_detail."""
    rows = jobs.jump_detail_stream(Topic.of(page_topic).read(spark, page_schema), within_ms, times)
    return Topic.of(out_topic).start(rows, os.path.join(checkpoint_root, "jump_detail"), trigger)


def start_visitor_stats(spark: SparkSession, unique_topic: str | Topic, jump_topic: str | Topic, page_topic: str | Topic,
                        page_schema: T.StructType, report_path: str | None, checkpoint_root: str,
                        trigger: dict | None = None, **report) -> StreamingQuery:
    """dwm_unique_visit + dwm_user_jump_detail + dwd_page_log -> visitor_stats report."""
    uv, uj, pv = (Topic.of(t).read(spark, page_schema) for t in (unique_topic, jump_topic, page_topic))
    return sinks.report_stream(jobs.visitor_stats_stream(uv, uj, pv), report_path, S.VISITOR_STATS_COLUMNS,
                               os.path.join(checkpoint_root, "visitor_stats"), trigger, **report)


#: The product metric of each input topic.
PRODUCT_METRICS = {"page": stats.page_metrics, "favor": stats.favor_metric, "cart": stats.cart_metric, "order_wide": stats.order_metric,
                   "payment_wide": stats.payment_metric, "refund": stats.refund_metric, "comment": stats.comment_metric}


def product_metric_streams(spark: SparkSession, inputs: dict[str, str | Topic], schemas: dict[str, T.StructType]) -> list[DataFrame]:
    """The metric rows of every input topic (names as in ``PRODUCT_METRICS``), for ``start_product_stats``."""
    unknown = set(inputs) - set(PRODUCT_METRICS)
    if unknown:
        raise ValueError(f"no product metric for {sorted(unknown)}")
    return [PRODUCT_METRICS[name](Topic.of(topic).read(spark, schemas[name])) for name, topic in inputs.items()]


def start_product_stats(spark: SparkSession, metric_streams: list[DataFrame], lookups: Lookups | StoredDims, report_path: str | None,
                        checkpoint_root: str, trigger: dict | None = None, **report) -> StreamingQuery:
    """The product metric streams -> product_stats report; lookups of each micro-batch."""
    core = stats.product_stats_core(stats.union_product(*metric_streams))

    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        batch.persist()
        try:
            sinks.write_report(stats.product_dims(batch, _dims_of(lookups, batch)), report_path, S.PRODUCT_STATS_COLUMNS,
                               batch_id, run=run, **report)
        finally:
            batch.unpersist()

    return sinks.foreach_batch(core, write, os.path.join(checkpoint_root, "product_stats"), trigger)


def start_province_stats(spark: SparkSession, order_wide_topic: str | Topic,
                         order_wide_schema: T.StructType, report_path: str | None,
                         checkpoint_root: str, trigger: dict | None = None, stamp: str = "wall",
                         max_files_per_trigger: int | None = None, **report) -> StreamingQuery:
    """dwm_order_wide -> province_stats report (10 s windows, 1 s watermark)."""
    src = _topic(order_wide_topic, max_files_per_trigger).read(spark, order_wide_schema)
    return sinks.report_stream(stats.province_stats(src, "1 second", stamp), report_path, S.PROVINCE_STATS_COLUMNS,
                               os.path.join(checkpoint_root, "province_stats"), trigger, **report)


def start_keyword_stats(spark: SparkSession, page_topic: str | Topic, page_schema: T.StructType,
                        report_path: str | None, checkpoint_root: str, trigger: dict | None = None,
                        stamp: str = "wall", max_files_per_trigger: int | None = None, **report) -> StreamingQuery:
    """dwd_page_log (SQL page table shape) -> keyword_stats report."""
    src = _topic(page_topic, max_files_per_trigger).read(spark, page_schema)
    return sinks.report_stream(stats.keyword_stats(src, "1 second", stamp), report_path, S.KEYWORD_STATS_COLUMNS,
                               os.path.join(checkpoint_root, "keyword_stats"), trigger, **report)
