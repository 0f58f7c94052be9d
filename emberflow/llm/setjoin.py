"""Parts common to the two exact set joins: token order, prefixes, candidate groups.

A token is a k-word shingle as a 64-bit number: its rarity in the upper 16 bits,
its hash below, so numbers in ascending order are tokens in the global order,
rarest first. The rarity is the logarithmic count of the shingle's rarest word
(no shingle is more frequent than that), then of all its words, by a fixed table
of word counts over the whole corpus. Any order gives right results; this one
keeps frequent tokens out of the prefixes. With similarity >= t, two sets share
a token in the first n - ceil(t n) + 1 tokens of each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common, textbytes

#: Slots of the table of word counts (one byte each when sent to tasks).
COUNT_SLOTS = 1 << 20
#: Members of a candidate group that one task holds; larger groups are dealt out as pairs of chunks.
CHUNK_MEMBERS = 1024


def slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(COUNT_SLOTS - 1)).astype(np.int64)


def word_levels(docs: DataFrame) -> np.ndarray:
    """Level (0-255, logarithmic) of every slot's word count over all texts of ``docs``."""

    def count(batch):
        data, offs = textbytes.text_buffer(batch.column(0))
        found = [slots(textbytes.word_hashes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])[0]).astype(np.int32) for i, j in textbytes.chunks(offs)]
        return np.bincount(np.concatenate([*found, np.zeros(0, np.int32)]), minlength=COUNT_SLOTS)

    total = common.sum_slots(docs.select("text"), count, COUNT_SLOTS)
    return np.minimum(255, np.floor(6 * np.log2(1 + total))).astype(np.uint8)


def tokens(words: np.ndarray, offsets: np.ndarray, k: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of every owner's words, and the owners' token offsets."""
    hashes, out = textbytes.shingle_hashes(words, offsets, k)
    first, _, _ = textbytes.shingle_places(offsets, k)
    if not len(first):
        return hashes, out
    level = levels[slots(words)]
    low, total = np.full(len(words), 255, np.uint8), np.zeros(len(words), np.uint16)
    if len(words) >= k:
        last = len(words) - k + 1
        for j in range(k):
            np.minimum(low[:last], level[j:last + j], out=low[:last])
            total[:last] += level[j:last + j]
        total //= k
    short = np.flatnonzero((np.diff(offsets) < k) & (np.diff(out) > 0))
    for x in range(k - 1):  # texts of fewer than k words
        at = offsets[short] + x
        here = at < offsets[short + 1]
        low[offsets[short[here]]] = np.minimum(low[offsets[short[here]]], level[at[here]]) if x else level[at[here]]
        total[offsets[short[here]]] = level[offsets[short[here]]]
    return low[first].astype(np.uint64) << np.uint64(56) | total[first].astype(np.uint64) << np.uint64(48) | hashes >> np.uint64(16), out


def distinct_tokens(found: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of every owner in the global order, and the owners' offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = (owner.astype(np.uint64) << np.uint64(44)) | (found >> np.uint64(20))
    order = np.argsort(key)
    key, ordered = key[order], found[order]
    if len(offsets) > 1 << 20 or np.any((key[1:] == key[:-1]) & (ordered[1:] != ordered[:-1])):
        order = np.lexsort((found, owner))  # the short keys do not tell all tokens apart
        ordered = found[order]
    owner = owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])
    return ordered[new], np.searchsorted(owner[new], np.arange(len(offsets)), side="left")


def class_keys(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 bits (two words) naming every owner's set of distinct tokens."""
    sums = np.zeros((len(offsets) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        sums[full, 0] = np.add.reduceat(textbytes.mix(found), offsets[full])
        sums[full, 1] = np.add.reduceat(textbytes.mix(found * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)), offsets[full])
    return textbytes.mix(sums * np.uint64(0x9E3779B97F4A7C15) + np.diff(offsets).astype(np.uint64)[:, None])


def in_prefix(offsets: np.ndarray, percent: int) -> np.ndarray:
    """Which tokens are in their owner's prefix."""
    n = np.diff(offsets)
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
    return place < np.repeat(n - (-(-percent * n // 100)) + 1, n)


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def repeated(docs: DataFrame, prefixes: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """Tokens (token) that ``prefixes`` gives twice or more over all batches of ``docs``.

    Tokens are dealt out by hash in arrays, one for each batch and part, with as
    many parts as the session has shuffle partitions; a part sorts its own. A
    token comes once from each batch, however frequent it is there.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches):
        for batch in batches:
            found, n = np.unique(prefixes(batch), return_counts=True)
            part = (textbytes.mix(found) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            found, n = found[order], n[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            use = np.flatnonzero(np.diff(cuts))
            pieces = [found[cuts[p]:cuts[p + 1]] for p in use]
            more = [found[cuts[p]:cuts[p + 1]][n[cuts[p]:cuts[p + 1]] > 1] for p in use]
            yield pa.RecordBatch.from_arrays([pa.array(use, pa.int64()), pa.array([x.tobytes() for x in pieces], pa.binary()),
                                              pa.array([x.tobytes() for x in more], pa.binary())], names=["part", "once", "more"])

    def gather(batches):
        for t in common.key_runs(batches, ["part"]):
            once = np.sort(np.frombuffer(b"".join(t["once"].to_pylist()), np.uint64))
            more = np.frombuffer(b"".join(t["more"].to_pylist()), np.uint64)
            found = np.unique(np.concatenate([once[1:][once[1:] == once[:-1]], more]))
            yield pa.RecordBatch.from_arrays([common.long_array(found)], names=["token"])

    return (docs.mapInArrow(deal, "part long, once binary, more binary").repartition("part").sortWithinPartitions("part")
            .mapInArrow(gather, "token long"))


def groups(members: DataFrame) -> DataFrame:
    """Candidate groups (pivot, cls) from rows (token, cls).

    The pivot of a token is its smallest class. Two classes that share a token
    are both members of that token's pivot, so all candidate pairs meet in a
    group; a class comes once into each group.
    """
    first = members.groupBy("token").agg(F.min("cls").alias("pivot"), F.max("cls").alias("last"))
    first = first.where("pivot != last").select("token", "pivot")
    return cut_lineage(members.join(first, "token").select("pivot", "cls").distinct())


def dealt(grouped: DataFrame, chunk: int = CHUNK_MEMBERS) -> DataFrame:
    """Rows (pivot, bi, bj, side, cls): each pair of chunks of a group is a task's work.

    Groups of up to ``chunk`` members are one piece; of a larger group, every
    pair of chunks bi <= bj is a piece of its own, so no task holds more than
    about two chunks and every pair of members meets in one piece.
    """
    sizes = grouped.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))
    b = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    small = F.array(F.struct(F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.lit(0).alias("side")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(
        F.least(x, F.col("b")).cast("int").alias("bi"), F.greatest(x, F.col("b")).cast("int").alias("bj"),
        (x < F.col("b")).cast("int").alias("side")))
    return (grouped.join(sizes, "pivot").withColumn("b", b)
            .select("pivot", "cls", F.explode(F.when(F.col("parts") == 1, small).otherwise(pairs)).alias("piece"))
            .select("pivot", "piece.bi", "piece.bj", "piece.side", "cls"))
