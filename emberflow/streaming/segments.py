"""Keyed tables that micro-batches write, as a few sorted Parquet segments named by a manifest.

``root/_manifest/<n>.json`` lists what the table consists of after commit n:
segments with their levels, the last batch of every query, what else the owner
notes. The highest n is the table; a segment that no manifest names does not
exist for readers. So a commit is one new file, and a crash before it leaves
the table as it was.

A batch becomes a segment of level 0. ``ratio`` segments of a level are merged
into one of the next, keeping the newest row of each key, so n batches leave
less than ``ratio`` segments on each of log(n) levels, and a row is rewritten
once a level. Segments from level 1 on are cut into ``buckets`` folders by a
hash of the key and sorted by key: a lookup opens the folders of its keys, and
in these the row groups whose smallest and largest key, or bloom filter, allow
them. Segments that a merge has replaced, and manifests, stay for ``keep``
commits for readers that have begun.

A table has one writer at a time. A batch that was committed is not written
again: its first result stands.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflow.sources import files

#: Most keys that a lookup hands to the Parquet reader as a list.
POINT_KEYS = 1000


@dataclass
class Manifest:
    """What a table consists of after commit ``version``."""

    version: int = 0
    buckets: int = 64
    segments: list[dict] = field(default_factory=list)  # path, level
    committed: dict[str, int] = field(default_factory=dict)  # query -> its last batch
    dropped: list[dict] = field(default_factory=list)  # path, at (the commit that replaced it)
    notes: dict = field(default_factory=dict)

    def next(self, **changes) -> "Manifest":
        return Manifest(**{**self.__dict__, **changes, "version": self.version + 1})


class SegmentTable:
    """A table of rows with a string column ``key``; ``newest`` reduces rows of equal keys to those that stand."""

    def __init__(self, spark: SparkSession, root: str, shape: str, newest: Callable[[DataFrame], DataFrame],
                 key: str = "pk", ratio: int = 8, keep: int = 4):
        self.spark, self.root, self.shape, self.newest = spark, root.rstrip("/"), shape, newest
        self.key, self.ratio, self.keep = key, ratio, keep

    # manifest

    def current(self) -> Manifest | None:
        """The newest manifest, or None if the table was never written."""
        found = [n for n in files.names(self.spark, f"{self.root}/_manifest") if n.endswith(".json") and not n.startswith(".")]
        return Manifest(**json.loads(files.read_text(self.spark, f"{self.root}/_manifest/{found[-1]}"))) if found else None

    def commit(self, manifest: Manifest) -> Manifest:
        """Make ``manifest`` the table; then remove what no reader can be using any more."""
        gone = [d for d in manifest.dropped if d["at"] <= manifest.version - self.keep]
        manifest.dropped = [d for d in manifest.dropped if d not in gone]
        files.write_new(self.spark, self._manifest_path(manifest.version), json.dumps(manifest.__dict__))
        for d in gone:
            files.delete(self.spark, f"{self.root}/{d['path']}")
        if manifest.version >= self.keep:
            files.delete(self.spark, self._manifest_path(manifest.version - self.keep))
        return manifest

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/_manifest/{version:012d}.json"

    # writing

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def write(self, rows: DataFrame, run: str, batch: int, notes: Callable[[DataFrame, dict], dict] | None = None,
              buckets: int = 64, stamp: str | None = None) -> Manifest:
        """Add a batch of a query, once; ``stamp`` names a column that gets the commit's number."""
        now = self.current() or Manifest(version=-1, buckets=buckets)
        if batch <= now.committed.get(run, -1):
            return now
        after = now.next(committed={**now.committed, run: batch})
        path = f"segments/seg=b-{run}-{batch}"
        if stamp:
            rows = rows.withColumn(stamp, F.lit(after.version).cast("long"))
        (self.newest(rows).withColumn("bucket", self.bucket(now.buckets)).sortWithinPartitions(self.key)
         .write.mode("overwrite").parquet(f"{self.root}/{path}"))
        written = self.spark.read.schema(f"{self.shape}, bucket int").parquet(f"{self.root}/{path}")
        if notes:
            after.notes = notes(written, now.notes)
        if written.limit(1).count():
            after.segments = [*now.segments, {"path": path, "level": 0}]
        return self.merge(self.commit(after))

    def merge(self, now: Manifest) -> Manifest:
        """Merge levels that have ``ratio`` segments, from the lowest on."""
        level = 0
        while True:
            full = [s for s in now.segments if s["level"] == level]
            if len(full) < self.ratio:
                if not any(s["level"] > level for s in now.segments):
                    return now
                level += 1
                continue
            path = f"segments/seg=m-{now.version + 1}"
            merged = self.newest(self._read(full)).withColumn("bucket", self.bucket(now.buckets))
            (merged.repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite")
             .option(f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy("bucket").parquet(f"{self.root}/{path}"))
            rest = [s for s in now.segments if s not in full]
            now = self.commit(now.next(segments=[*rest, {"path": path, "level": level + 1}],
                                       dropped=[*now.dropped, *({"path": s["path"], "at": now.version + 1} for s in full)]))

    # reading

    def _read(self, segments: list[dict]) -> DataFrame:
        read = self.spark.read.schema(f"{self.shape}, bucket int").option("basePath", f"{self.root}/segments")
        parts = []
        for some in ([s for s in segments if not s["level"]], [s for s in segments if s["level"]]):
            if some:
                parts.append(read.parquet(*(f"{self.root}/{s['path']}" for s in some)).select(*self._columns(), "bucket"))
        if not parts:
            return self.spark.createDataFrame([], f"{self.shape}, bucket int")
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]

    def _columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.shape).columns

    def rows(self, now: Manifest) -> DataFrame:
        """The rows that stand."""
        return self.newest(self._read(now.segments).drop("bucket"))

    def rows_of(self, now: Manifest, keys: DataFrame) -> DataFrame:
        """The rows that stand of ``keys`` (one column): their buckets only, and there by key.

        Up to ``POINT_KEYS`` keys come to the driver and go to the reader as a
        list; of more, the numbers of their buckets, and the keys are joined.
        """
        keys = keys.select(F.col(f"`{keys.columns[0]}`").cast("string").alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        few = keys.select(self.key, self.bucket(now.buckets).alias("bucket")).limit(POINT_KEYS + 1).collect()
        found = self._read(now.segments)
        if len(few) <= POINT_KEYS:
            found = found.where(F.col("bucket").isin(sorted({r["bucket"] for r in few})) & F.col(self.key).isin(sorted(r[self.key] for r in few)))
        else:
            buckets = [r[0] for r in keys.select(self.bucket(now.buckets)).distinct().collect()]
            found = found.where(F.col("bucket").isin(buckets)).join(keys, self.key, "left_semi")
        return self.newest(found.drop("bucket"))
