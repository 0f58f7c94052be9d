"""Exact dedup by an extendible-hash index on shared files (operator 5). DataFrame functions only.

Texts are equal when their bytes are. A text's key is a 64-bit hash; the
directory maps the key's leading bits (its slot) to buckets. It starts with one
bit string of the depth that the number of keys asks for, and doubles (one more
bit) while a bucket holds more than ``bucket_keys`` distinct keys and can be
split; a bucket keeps the smallest depth at which it fits. Every row finds its
bucket through the directory, to be put into the index and to be looked up in it.

Rows are first added up by bucket, key and content, which compares bytes and
does most of its work before the shuffle; the different texts of a key are then
chained by the owner of their range of (bucket, key), one task for each range,
and written to the shared folder: the directory, and the links (bucket, key,
link, digest, largest doc_id, copies). A lookup goes from slot to bucket, key
and digest. Two texts of a chain with one SHA-256 raise an error.

Defined cases: null text = empty; of equal texts the row with the largest
doc_id stays, null being smaller than all; of repeated rows with that doc_id
one stays; an empty table gives an empty result; further columns, whatever their
names, play no part.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common

#: Bits of the key that the directory can use.
KEY_BITS = 63
#: A directory of at most this many slots (24 bytes each) is sent to the tasks; a larger one is joined by shuffle.
SENT_SLOTS = 1 << 20


def _key(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftright(key, KEY_BITS - depth)


def directory(keys: DataFrame, bucket_keys: int) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) of every used slot, and the global depth; ``keys`` has the distinct keys."""
    n = keys.count()
    depth = max(1, (max(1, n) * 2 // bucket_keys).bit_length())
    while True:
        loads = cut_lineage(keys.groupBy(_prefix(F.col("key"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("load")))
        most = loads.agg(F.max("load")).first()[0] or 0
        if most <= bucket_keys or depth >= KEY_BITS - 1:
            break
        depth += 1  # the directory doubles
    levels = loads.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    node = F.expr(f"shiftright(slot, {depth} - level)")
    sums = levels.groupBy("level", node.alias("node")).agg(F.sum("load").alias("keys")).where((F.col("keys") <= bucket_keys) | (F.col("level") == depth))
    local = levels.withColumn("node", node).join(sums, ["level", "node"]).groupBy("slot").agg(F.min("level").alias("depth"))
    bucket = F.expr(f"shiftleft(shiftright(slot, {depth} - depth), {depth} - depth)")
    return local.select("slot", bucket.alias("bucket"), "depth"), depth


@dataclass(frozen=True)
class Index:
    """The written ``links``, and the directory of ``slots`` by which a key finds its bucket."""

    slots: DataFrame
    depth: int
    links: DataFrame | None = None

    def routed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with a ``key``) and the ``bucket`` that the directory names."""
        slots = self.slots.select("slot", "bucket")
        slots = F.broadcast(slots) if slots.count() <= SENT_SLOTS else slots
        return rows.withColumn("slot", _prefix(F.col("key"), self.depth)).join(slots, "slot").drop("slot")


def build_index(docs: DataFrame, column: str = "text", bucket_keys: int = 65536) -> Index:
    """Write directory and links of ``docs`` to the shared folder; the index reads from there."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exact-index-{uuid.uuid4().hex}"
    text = common.text_or_empty(column)
    keys = cut_lineage(docs.select(_key(text).alias("key")).distinct())
    slots, depth = directory(keys, bucket_keys)
    slots.write.parquet(f"{folder}/directory")
    index = Index(spark.read.parquet(f"{folder}/directory"), depth)
    rows = docs.select(_key(text).alias("key"), text.alias("content"), F.col("doc_id").cast("long").alias("doc_id"))
    texts = (index.routed(rows).groupBy("bucket", "key", "content").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .select("bucket", "key", F.sha2("content", 256).alias("digest"), "keep_id", "group_size"))
    chain = Window.partitionBy("bucket", "key").orderBy("digest")
    same = F.lag("digest").over(chain).eqNullSafe(F.col("digest"))
    links = (texts.repartitionByRange("bucket", "key").withColumn("same", same).withColumn("link", F.row_number().over(chain))
             .withColumn("digest", F.when(~F.col("same"), F.col("digest")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")))).drop("same"))
    links.write.parquet(f"{folder}/links")
    return Index(index.slots, depth, spark.read.parquet(f"{folder}/links"))


def look_up(rows: DataFrame, index: Index) -> DataFrame:
    """``rows`` (with ``key`` and ``digest``) that have a link, with keep_id and group_size."""
    return index.routed(rows).join(index.links.drop("link"), ["bucket", "key", "digest"])


def exact_duplicates(docs: DataFrame, column: str = "text", bucket_keys: int = 65536) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    index = build_index(docs, column, bucket_keys)
    text = common.text_or_empty(column)
    found = look_up(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(text).alias("key"), F.sha2(text, 256).alias("digest")), index)
    repeat = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("key"))
    return found.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (repeat == 1)).alias("kept"), F.col("digest").alias("text_sha256"))
