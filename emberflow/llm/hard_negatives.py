"""Hard negatives from Hilbert-ordered blocks with zone maps (operator 12).

Components x become floor(``scale`` * x); a row's score is its integer inner
product with the anchor, larger ones first, ties to the smaller vec_id. An
anchor's positives are its first ``positives`` other rows of its label. For an
anchor and a positive with score p, the negatives are the first ``negatives``
rows of other labels with low * p <= 100 * score <= high * p.

Candidates are ordered by label and by their place on a Hilbert curve through
the ``CURVE`` dimensions of the largest variance (``CURVE_BITS`` bits each), cut
into blocks of about ``block_rows`` rows, and written to the shared folder as
Parquet, each block's rows together, with a zone map: rows, labels and, for
every dimension, the smallest and largest component. By interval arithmetic a
block's scores with an anchor a lie within

    [sum min(a * least, a * largest), sum max(a * least, a * largest)]

which decides the blocks to read, in two rounds for each search. First the
blocks with the highest upper bounds that hold enough rows are read, which
gives every window the score t of its last place so far (or its lower end);
then all others whose bounds reach into the window at t or above. Nothing else
can hold a result, so the search is exact, whatever the data; where bounds do
not tell blocks apart, all are read.

Bounds are evaluated in chunks of anchors against chunks of zone maps, and only
the pairs that must be read leave the tasks. A block's anchors are dealt out in
pieces of ``PIECE``; a task holds one block and a batch of anchors.

Defined cases: rows with a null vec_id, label or vector, or any null or
non-finite component take no part, nor those of another than the most common
length (the larger of equally common ones); equal rows count once, and of
different rows with one vec_id the one with the smallest label and then vector
takes part; without positives, or with an empty window (a negative p), an
anchor has no rows; components so large that an inner product may reach 2^53,
where doubles are not exact, raise an error; empty tables give an empty result; further columns, whatever their
names, play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common

CURVE, CURVE_BITS = 8, 7
#: Zone maps, and anchors, of a chunk.
CHUNK = 512
#: Anchors that meet a block at once.
PIECE = 4096
SHAPE = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) of unsigned coordinates below 2**bits."""
    axes = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        below = np.uint64((1 << level) - 1)
        for i, axis in enumerate(axes):
            upper = (axis & bit) != 0
            swap = (axes[0] ^ axis) & below
            axes[0] = np.where(upper, axes[0] ^ below, axes[0] ^ swap)
            if i:
                axes[i] = np.where(upper, axis, axis ^ swap)
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(points), np.uint64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] >> np.uint64(level)) & one > 0, turn ^ np.uint64((1 << level) - 1), turn)
    place = np.zeros(len(points), np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << one) | (((axis ^ turn) >> np.uint64(level)) & one)
    return place.view(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def bounds(anchors: np.ndarray, least: np.ndarray, largest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of anchors (rows) with vectors within zone maps (columns)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ least.T + down @ largest.T, up @ largest.T + down @ least.T


def _dimensions(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variance, smallest and largest component of every dimension; ``width`` rows come to the driver."""
    def partial(batches):
        for batch in batches:
            v = _matrix(batch.column(0), width).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(width), np.full(width, len(v)), v.sum(axis=0), (v * v).sum(axis=0), v.min(axis=0), v.max(axis=0))],
                                             names=["d", "n", "s", "ss", "low", "high"])
    found = (rows.select("v").mapInArrow(partial, "d long, n long, s double, ss double, low double, high double")
             .groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("low").alias("low"), F.max("high").alias("high"))
             .orderBy("d").collect())
    return (np.array([r.ss / r.n - (r.s / r.n) ** 2 for r in found]), np.array([r.low for r in found]), np.array([r.high for r in found]))


def _curve(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with ``place``, the place on the Hilbert curve."""
    variance, low, high = _dimensions(rows, width)
    if (np.maximum(np.abs(low), np.abs(high)) ** 2).sum() >= 2.0**53:
        raise ArithmeticError("components are too large for exact inner products")
    use = np.argsort(-variance, kind="stable")[:CURVE]
    scale = (1 << CURVE_BITS) / (high - low + 1)[use]

    def emit(batches):
        for batch in batches:
            cells = np.floor((_matrix(batch.column(2), width)[:, use] - low[use]) * scale).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_index(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS))],
                                             names=["vec_id", "label", "v", "place"])

    return rows.select("vec_id", "label", "v").mapInArrow(emit, "vec_id long, label long, v array<long>, place long")


def write_blocks(rows: DataFrame, width: int, n: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Blocks (block, vec_id, label, v) read from the shared folder, and their zone maps.

    A block is a range of (label, place, vec_id) within a file; its number says file and place there.
    """
    spark = rows.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hilbert-blocks-{uuid.uuid4().hex}"
    files = max(1, -(-n // (8 * block_rows)))
    ordered = _curve(rows, width).repartitionByRange(files, "label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id")
    number = F.monotonically_increasing_id()  # file * 2^33 + row
    block = (F.shiftright(number, 33) * F.lit(1 << 20) + F.floor(number.bitwiseAND((1 << 33) - 1) / block_rows)).alias("block")
    ordered.select(block, "vec_id", "label", "v").write.parquet(folder)
    blocks = spark.read.parquet(folder)

    def zones(batches):
        for batch in batches:
            for t in common.key_runs([batch], ["block"]):
                v = _matrix(t["v"].combine_chunks(), width)
                label = t["label"].to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [t["block"][:1].combine_chunks(), pa.array([len(v)]), pa.array([label.min()]), pa.array([label.max()]),
                     pa.array([v.min(axis=0).tolist()]), pa.array([v.max(axis=0).tolist()])], names=["block", "n", "label_low", "label_high", "low", "high"])

    part = blocks.mapInArrow(zones, "block long, n long, label_low long, label_high long, low array<long>, high array<long>")
    narrow = lambda f, c: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: f(F.transform(F.collect_list(c), lambda x: x[i])))
    # a block's rows are in one file: a few batches of it give a row each
    zone = part.groupBy("block").agg(F.sum("n").alias("n"), F.min("label_low").alias("label_low"), F.max("label_high").alias("label_high"),
                                     narrow(F.array_min, "low").alias("low"), narrow(F.array_max, "high").alias("high"))
    return blocks, cut_lineage(zone)


#: Columns that say what an anchor looks for: rows of its own label (same) or of others, scores from
#: ``least`` to ``most`` (null: no limit), ``k`` rows and, per block bound, whether it was read before.
_ASK = "anchor_id long, label long, v array<long>, same boolean, windows array<struct<low:long,high:long,last:long>>, k int, seen array<long>"


def blocks_to_read(asks: DataFrame, zones: DataFrame, width: int, first: bool) -> DataFrame:
    """(anchor_id, block) that must be read: the first round's, or all the others.

    ``first``: for every anchor the blocks with the highest upper bounds whose
    rows make up its ``k``, of those that can hold a result. Else: the blocks
    not in ``seen`` whose bounds reach one of the anchor's windows at the score
    of its last place.
    """
    n_zones, n_asks = max(1, -(-zones.count() // CHUNK)), max(1, -(-asks.count() // CHUNK))
    side_z = zones.select(F.pmod(F.xxhash64("block"), F.lit(n_zones)).alias("zi"), F.explode(F.sequence(F.lit(0), F.lit(n_asks - 1))).alias("ai"), F.lit(0).alias("side"),
                          F.struct(*zones.columns).alias("zone"), F.lit(None).cast(f"struct<{_ask_struct()}>").alias("ask"))
    side_a = asks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_zones - 1).cast("long"))).alias("zi"), F.pmod(F.xxhash64("anchor_id"), F.lit(n_asks)).cast("int").alias("ai"),
                         F.lit(1).alias("side"), F.lit(None).cast(zones.select(F.struct(*zones.columns)).schema[0].dataType).alias("zone"),
                         F.struct(*asks.columns).alias("ask"))

    def emit(batches):
        for t in common.key_runs(batches, ["zi", "ai"]):
            side = t["side"].to_numpy()
            zone, ask = t["zone"].filter(pa.array(side == 0)).to_pylist(), t["ask"].filter(pa.array(side == 1)).to_pylist()
            if not zone or not ask:
                continue
            names = np.array([z["block"] for z in zone])
            size, first_label, last_label = (np.array([z[c] for z in zone]) for c in ("n", "label_low", "label_high"))
            down, up = bounds(np.array([a["v"] for a in ask], np.float64), np.array([z["low"] for z in zone], np.float64), np.array([z["high"] for z in zone], np.float64))
            who, which, bound, rows = [], [], [], []
            for i, a in enumerate(ask):
                label = a["label"]
                fits = (first_label <= label) & (label <= last_label) if a["same"] else (first_label != label) | (last_label != label)
                reach = np.zeros(len(zone), bool)
                for w in a["windows"]:
                    reach |= (up[i] >= w["last"]) & (down[i] <= w["high"])
                use = np.flatnonzero(fits & reach & ~np.isin(names, a["seen"]))
                if first and len(use):
                    use = use[np.lexsort((names[use], -up[i][use]))]
                    use = use[:1 + int(np.searchsorted(np.cumsum(size[use]), a["k"]))]
                who += [a["anchor_id"]] * len(use)
                which.append(names[use])
                bound.append(up[i][use])
                rows.append(size[use])
            which = np.concatenate([*which, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(which, pa.int64()), pa.array(np.concatenate([*bound, np.zeros(0)]), pa.float64()),
                                              pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]), pa.int64())], names=["anchor_id", "block", "bound", "n"])

    found = (side_z.unionByName(side_a).repartition("zi", "ai").sortWithinPartitions("zi", "ai")
             .mapInArrow(emit, "anchor_id long, block long, bound double, n long"))
    if first:
        before = F.sum("n").over(Window.partitionBy("anchor_id").orderBy(F.desc("bound"), "block").rowsBetween(Window.unboundedPreceding, -1))
        found = (found.withColumn("before", F.coalesce(before, F.lit(0))).join(asks.select("anchor_id", "k"), "anchor_id").where("before < k"))
    return cut_lineage(found.select("anchor_id", "block"))


def _ask_struct() -> str:
    parts = _ASK.split(", ")
    return ", ".join(p.replace(" ", ":", 1) for p in parts)


def read_blocks(asks: DataFrame, pairs: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """(anchor_id, window, found, score): every window's best ``k`` of each block that is read for its anchor."""
    sizes = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    wanted = asks.join(pairs, "anchor_id").join(sizes, "block")
    nothing = F.lit(None).cast(f"struct<{_ask_struct()}>")
    side_a = wanted.select("block", F.pmod(F.xxhash64("anchor_id"), F.col("pieces")).cast("int").alias("piece"), F.lit(1).alias("side"),
                           F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("of"), F.col("v"), F.struct(*[c for c in asks.columns]).alias("ask"))
    side_b = (blocks.join(sizes, "block").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
              .select("block", "piece", F.lit(0).alias("side"), "vec_id", F.col("label").alias("of"), "v", nothing.alias("ask")))

    def emit(batches):
        key, held, block = None, [], None
        for batch in batches:
            for t in common.key_runs([batch], ["block", "piece", "side"]):
                mine, side = (t["block"][0].as_py(), t["piece"][0].as_py()), t["side"][0].as_py()
                if mine != key:
                    key, held, block = mine, [], None
                if side == 0:
                    held.append((t["vec_id"].to_numpy(), t["of"].to_numpy(), _matrix(t["v"].combine_chunks(), width)))
                    continue
                if block is None:
                    block = [np.concatenate(x) for x in zip(*held)] if held else []
                    held = []
                if not block:
                    continue
                yield from _matches(block, t["ask"].to_pylist())

    return (side_b.unionByName(side_a).repartition("block", "piece").sortWithinPartitions("block", "piece", "side")
            .mapInArrow(emit, "anchor_id long, window int, found long, score long"))


def _matches(block: list[np.ndarray], asks: list[dict]) -> Iterator[pa.RecordBatch]:
    """What the anchors find in one block."""
    ids, labels, vectors = block
    scores = np.array([a["v"] for a in asks], np.float64) @ vectors.astype(np.float64).T
    out = []
    for a, score in zip(asks, scores.astype(np.int64)):
        fits = (labels == a["label"]) & (ids != a["anchor_id"]) if a["same"] else labels != a["label"]
        least = min(w["last"] for w in a["windows"])
        use = np.flatnonzero(fits & (score >= least) & (score <= max(w["high"] for w in a["windows"])))
        use = use[np.lexsort((ids[use], -score[use]))]
        ordered = -score[use]
        for x, w in enumerate(a["windows"]):
            start, end = np.searchsorted(ordered, -w["high"], side="left"), np.searchsorted(ordered, -w["last"], side="right")
            take = use[start:min(end, start + a["k"])]
            if len(take):
                out.append((np.full(len(take), a["anchor_id"]), np.full(len(take), x), ids[take], score[take]))
    if out:
        anchor, window, found, score = (np.concatenate(c) for c in zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(window.astype(np.int32)), pa.array(found), pa.array(score)], names=["anchor_id", "window", "found", "score"])


def _search(asks: DataFrame, blocks: DataFrame, zones: DataFrame, width: int) -> DataFrame:
    """(anchor_id, window, found, score, rank): the best ``k`` of every window, in two rounds."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "found")

    def best(found: DataFrame) -> DataFrame:
        ranked = found.withColumn("rank", F.row_number().over(order)).join(asks.select("anchor_id", "k"), "anchor_id")
        return ranked.where("rank <= k").drop("k")

    asks = cut_lineage(asks)
    pairs = blocks_to_read(asks, zones, width, True)
    seen = cut_lineage(best(read_blocks(asks, pairs, blocks, width)))
    last = (seen.join(asks.select("anchor_id", "k"), "anchor_id").where("rank = k").groupBy("anchor_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("lasts")))  # a window's entry each
    read = pairs.groupBy("anchor_id").agg(F.collect_list("block").alias("read"))  # blocks of k rows together
    more = asks.join(last, "anchor_id", "left").join(read, "anchor_id", "left")
    none = F.create_map().cast("map<int,long>")
    windows = F.transform("windows", lambda w, i: F.struct(w["low"].alias("low"), w["high"].alias("high"),
                                                           F.greatest(w["low"], F.coalesce(F.coalesce("lasts", none)[i], w["low"])).alias("last")))
    more = cut_lineage(more.select("anchor_id", "label", "v", "same", windows.alias("windows"), "k", F.coalesce("read", F.array().cast("array<long>")).alias("seen")))
    rest = blocks_to_read(more, zones, width, False)
    found = read_blocks(more, rest, blocks, width)
    return cut_lineage(best(seen.drop("rank").unionByName(found)))


def mine(vectors: DataFrame, is_anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         block_rows: int = 2048, column: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the negatives of all rows that are ``is_anchor``."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    common.ship_package(spark)
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = (vectors.where(F.col(column).isNotNull() & fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
             .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                     F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"), is_anchor.alias("asks")))
    sizes = given.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if sizes is None or not sizes["width"]:
        return spark.createDataFrame([], SHAPE)
    width = sizes["width"]
    rows = cut_lineage(given.where(F.size("v") == width).groupBy("vec_id").agg(F.min(F.struct("label", "v", "asks")).alias("r")).select("vec_id", "r.*"))
    blocks, zones = write_blocks(rows, width, rows.count(), block_rows)
    everything = F.struct(F.lit(-(2**53)).cast("long").alias("low"), F.lit(2**53).cast("long").alias("high"), F.lit(-(2**53)).cast("long").alias("last"))
    none = F.array().cast("array<long>").alias("seen")
    anchors = rows.where("asks").select(F.col("vec_id").alias("anchor_id"), "label", "v")
    near = _search(anchors.select("*", F.lit(True).alias("same"), F.array(everything).alias("windows"), F.lit(positives).alias("k"), none), blocks, zones, width)
    # scores s with low * p <= 100 * s <= high * p
    window = F.struct(F.expr(f"cast(ceil(cast({low} * score as decimal(30, 0)) / 100) as long)").alias("low"),
                      F.expr(f"cast(floor(cast({high} * score as decimal(30, 0)) / 100) as long)").alias("high"))
    listed = (near.withColumn("w", window).where("w.low <= w.high")
              .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "found", "score", "w"))).alias("near")))  # ``positives`` at most
    asks = (anchors.join(listed, "anchor_id")
            .select("anchor_id", "label", "v", F.lit(False).alias("same"),
                    F.transform("near", lambda x: F.struct(x["w"]["low"].alias("low"), x["w"]["high"].alias("high"), x["w"]["low"].alias("last"))).alias("windows"),
                    F.lit(negatives).alias("k"), none))
    hard = _search(asks, blocks, zones, width)
    of = listed.select("anchor_id", F.posexplode("near").alias("window", "p"))
    return (hard.join(of, ["anchor_id", "window"])
            .select("anchor_id", F.col("p.found").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
                    F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")))
