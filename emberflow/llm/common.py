"""Helpers shared by the operators of this subpackage.

What is sent to every task is bounded by construction: a bitmap of a fixed
number of bits, a table of a fixed number of slots. Everything that grows with
the corpus stays in Spark tables.
"""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import release_shuffles

#: Bits of a bitmap sent to tasks (4 MB); further keys only weaken its pruning.
BITMAP_BITS = 1 << 25
_PAGE_BITS = 32768


#: Rows of an Arrow batch at most.
BATCH_ROWS = 2000
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (what --py-files does), once for each application.

    Also bounds the Arrow batches of the session: texts are long rows, and a
    task holds a batch on both sides of the pipe.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    package = Path(__file__).resolve().parents[1]
    target = Path(SparkFiles.getRootDirectory()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(given: DataFrame, needs: Sequence[str], adds: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``given``, the columns it does not need going through under neutral names.

    So no input column can meet a name that the operator uses inside, whatever
    it is called. Afterwards the columns have their own names again, followed by
    those that the operator ``adds``. An input column called like one of these
    (case ignored) comes back with ``_in`` behind its name, repeated until free.
    Columns that ``work`` does not return are left out.
    """
    names = given.columns
    inner = [n if n in needs else f"given_{i}" for i, n in enumerate(names)]
    out = work(given.toDF(*inner))
    added, taken = {c.lower() for c in adds}, {c.lower() for c in (*names, *adds)}
    columns = []
    for name, i in zip(names, inner):
        if i not in out.columns:
            continue
        label = name
        if name.lower() in added:
            while label.lower() in taken:
                label += "_in"
            taken.add(label.lower())
        columns.append(F.col(i).alias(label))
    return out.select(*columns, *adds)


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bytes of a bitmap with bit (key mod ``bits``) set for every long key.

    A lossless pre-filter: a key that is in ``keys`` always finds its bit set.
    The driver gets ``bits`` / 8 bytes at most, whatever the size of ``keys``.
    """
    slot = F.pmod(F.col(column), F.lit(bits))
    pages = (keys.select(slot.alias("slot"))
             .groupBy(F.floor(F.col("slot") / _PAGE_BITS).alias("page"))
             .agg(F.bitmap_construct_agg((F.col("slot") % _PAGE_BITS)).alias("bytes")).collect())
    out = np.zeros(bits // 8, np.uint8)
    release_shuffles(keys.sparkSession)
    for row in pages:
        at = row["page"] * _PAGE_BITS // 8
        out[at:at + _PAGE_BITS // 8] = np.frombuffer(row["bytes"], np.uint8)
    return out


def in_bitmap(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = keys.view(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def passes(bits: np.ndarray) -> Callable[[Column], Column]:
    """Column function: is the bit of a long key set?"""
    @pandas_udf("boolean")
    def check(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(h.to_numpy(), bits))
    return check


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of one key, from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            col = batch.column(batch.schema.get_field_index(k))
            change[1:] |= np.asarray(pc.not_equal(col[1:], col[:-1]).fill_null(True).to_numpy(zero_copy_only=False), dtype=bool)
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            if held and a == 0 and all(held[-1].column(k)[0] == part.column(k)[0] for k in keys):
                held.append(part)
                continue
            if held:
                yield pa.Table.from_batches(held)
            held = [part]
    if held:
        yield pa.Table.from_batches(held)


def sum_slots(docs: DataFrame, count: Callable[[pa.RecordBatch], np.ndarray], slots: int) -> np.ndarray:
    """Sum, over all batches of ``docs``, of the count vectors of length ``slots``.

    Each task adds up its own vector; pages of the vectors are added in a
    second stage. The driver gets the one vector.
    """
    page = 4096

    def partial(batches):
        total = np.zeros(slots, np.int64)
        for batch in batches:
            total += count(batch)
        pages = total.reshape(-1, page)
        use = np.flatnonzero(pages.any(axis=1))
        if len(use):
            yield pa.RecordBatch.from_arrays(
                [pa.array(use, pa.int64()), pa.array([pages[i].tobytes() for i in use], pa.binary())], names=["page", "sums"])

    def combine(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.frombuffer(raw, np.int64)
                sums[i] = sums[i] + v if i in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["page", "sums"])

    rows = (docs.mapInArrow(partial, "page long, sums binary").repartition("page")
            .mapInArrow(combine, "page long, sums binary").collect())
    out = np.zeros(slots, np.int64)
    for row in rows:
        out[row["page"] * page:(row["page"] + 1) * page] = np.frombuffer(row["sums"], np.int64)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_hash() -> Column:
    """Hash of a row's doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())
