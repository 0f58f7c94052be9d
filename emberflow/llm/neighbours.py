"""Nearest neighbours by multi-index hashing over learned binary codes (operator 3).

Nearness is the inner product. Vectors get one more component that brings all
to the length of the longest, queries a zero there: the largest product is then
the smallest angle. Rotations learned on at most ``fit_rows`` vectors (those
with the smallest hash of vec_id; principal directions, then rotated towards
the corners of the cube) turn a vector into ``bits`` signs. A code is split
into 16-bit substrings, and each block of the index keeps a table of buckets
for every substring. By the pigeonhole principle a code within radius r of the
query's agrees with it up to r / (number of substrings) in some substring: the
buckets that near are probed, so every code within r is found; those are
reranked by their products in double precision.

A query with fewer than ``rerank`` codes within the radius is asked again with
the next larger one, at last with all codes, so nothing is capped. Index and
queries are dealt out in blocks; a task holds one block of each. Equal vectors
are one entry with their k + 1 smallest vec_ids, all that k results can show.

Defined cases: vectors that are null, zero, or hold a null or non-finite
component take no part, nor those of another than the most common length (the
larger of equally common ones); null vec_ids take no part; equal repeated rows
count once; a query's own vec_id is never its result; ties go to the smaller
vec_id; fewer candidates than k give all; empty tables give an empty result; further
columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common

SUB = 16
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << SUB)], np.uint8)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def learn_rotations(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions): code bits are the signs of (x - mean) @ directions."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:min(len(axes), bits)]
    points = centred @ axes.T
    rng = np.random.Generator(np.random.PCG64(seed))
    found, width = [], axes.shape[0]
    while width * len(found) < bits:
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(points @ turn).T @ points)
            turn = (u @ v).T
        found.append(axes.T @ turn)
    return mean, np.concatenate(found, axis=1)[:, :bits]


def _lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(1 - (vectors**2).sum(axis=1) / longest**2, 0))
    return np.concatenate([vectors / longest, rest[:, None]], axis=1)


def _codes(points: np.ndarray, mean: np.ndarray, directions: np.ndarray) -> np.ndarray:
    signs = (points - mean) @ directions > 0
    return np.packbits(signs, axis=1).view(np.uint16)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


class BlockIndex:
    """The buckets of one block: for every substring, codes sorted by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.buckets = []
        for s in range(codes.shape[1]):
            self.buckets.append(np.unique(codes[self.order[:, s], s], return_index=True))

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes within ``radius`` of ``query``."""
        near = radius // len(query)
        hit = np.zeros(len(self.codes), bool)
        for s, (values, starts) in enumerate(self.buckets):
            probe = _POPCOUNT[values ^ query[s]] <= near
            hit[self.order[np.repeat(probe, np.diff(np.append(starts, len(hit)))), s]] = True
        places = np.flatnonzero(hit)
        return places[_POPCOUNT[self.codes[places] ^ query].sum(axis=1, dtype=np.int64) <= radius]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, column: str = "embedding", bits: int = 256, radius: int = 104,
            rerank: int = 1000, fit_rows: int = 8192, block: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row that ``is_query``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = cut_lineage(rows.where(F.col("vec_id").isNotNull() & _usable(F.col("v"))).distinct())
    spark = rows.sparkSession
    sizes = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    shape = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], shape)
    width = sizes["width"]
    rows = rows.where(F.size("v") == width)
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    members = rows.select("v", "vec_id").withColumn("nth", nth).where(F.col("nth") <= k + 1)
    entries = cut_lineage(members.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))).withColumn("cid", F.monotonically_increasing_id())
    asks = cut_lineage(rows.where("asks").select("vec_id", "v").join(entries.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), "cid"))
    n, longest = entries.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    longest = float(np.sqrt(longest))
    sample = entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(fit_rows).select("v", F.col("ids")[0].alias("i")).toArrow().sort_by("i")
    mean, directions = learn_rotations(_lengthened(_matrix(sample["v"].combine_chunks(), width), longest), bits)

    def coded(batches):
        for batch in batches:
            v = _matrix(batch.column(1), width)
            as_entry, as_query = _lengthened(v, longest), np.concatenate([v / np.sqrt((v**2).sum(axis=1))[:, None], np.zeros((len(v), 1))], axis=1)
            out = [pa.array([row.tobytes() for row in _codes(p, mean, directions)], pa.binary()) for p in (as_entry, as_query)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in v], pa.binary()), batch.column(2), *out],
                                             names=["cid", "v", "first", "code", "ask"])

    known = cut_lineage(entries.select("cid", "v", F.col("ids")[0].alias("first"))
                        .mapInArrow(coded, "cid long, v binary, first long, code binary, ask binary"))
    left = cut_lineage(known.join(asks.select("cid").distinct(), "cid", "left_semi"))
    blocks = max(1, -(-n // block))
    index = known.select(F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int").alias("bi"), F.lit(0).alias("side"), "cid", "v", "first", "code")

    def search(reach: int):
        def emit(batches):
            for t in common.key_runs(batches, ["bi", "bj"]):
                side = t["side"].to_numpy()
                m = int((side == 0).sum())
                if m in (0, len(side)):
                    continue
                cid, first = t["cid"].to_numpy(), t["first"].to_numpy()
                v = np.frombuffer(b"".join(t["v"].to_pylist()), np.float64).reshape(-1, width)
                codes = np.frombuffer(b"".join(t["code"].to_pylist()), np.uint16).reshape(len(side), -1)
                table = BlockIndex(codes[:m])
                out = []
                for q in range(m, len(side)):
                    places = table.within(codes[q], reach)
                    score = np.einsum("ij,j->i", v[places], v[q])
                    best = np.lexsort((first[places], -score))[:k + 1]
                    out.append((np.full(len(best), cid[q]), cid[places[best]], score[best], np.full(len(best), len(places))))
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns[:3], columns[3].astype(np.int64), np.full(len(columns[0]), t["bi"][0].as_py(), np.int32))],
                                                 names=["ask", "cid", "score", "near", "bi"])
        return emit

    found = None
    for reach in dict.fromkeys(min(r, bits) for r in (radius, radius + bits // 20, radius + bits // 10, bits)):
        asking = left.count()
        if not asking:
            break
        parts = max(1, -(-asking // 1024))
        pieces = index.withColumn("bj", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("bi", "bj", "side", "cid", "v", "first", "code").unionByName(
            left.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("bi"), F.pmod(F.xxhash64("cid"), F.lit(parts)).cast("int").alias("bj"),
                        F.lit(1).alias("side"), "cid", "v", "first", F.col("ask").alias("code")))
        hits = cut_lineage(pieces.repartition("bi", "bj").sortWithinPartitions("bi", "bj", "side", "cid")
                           .mapInArrow(search(reach), "ask long, cid long, score double, near long, bi int"))
        enough = F.lit(True) if reach == bits else F.col("near") >= rerank
        done = (hits.groupBy("ask", "bi").agg(F.max("near").alias("near")).groupBy("ask").agg(F.sum("near").alias("near")).where(enough).select("ask"))
        hits = cut_lineage(hits.select("ask", "cid", "score").join(done, "ask"))
        found = hits if found is None else found.unionByName(hits)
        left = cut_lineage(left.join(done, left.cid == done.ask, "left_anti"))
    if found is None:
        return spark.createDataFrame([], shape)
    order = Window.partitionBy("ask").orderBy(F.desc("score"), F.col("vec_id"))
    listed = (found.join(entries.select("cid", "ids"), "cid").select("ask", "score", F.explode("ids").alias("vec_id"))
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1))
    of_query = listed.join(asks.withColumnRenamed("cid", "asker"), F.col("ask") == F.col("asker")).where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id")))
    return of_query.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
