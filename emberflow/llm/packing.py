"""Best-fit packing with certified bin counts (operator 6).

A document is its token ids and one closing id. Longer ones are cut into pieces
of ``length`` tokens, of which the first may be shorter. Pieces are dealt out
to parts of about ``part_rows``; a part is known by how many pieces it has of
each length, at most ``length`` numbers, so best-fit decreasing runs on counts:
one step puts all pieces of a length into the fullest bins that fit. Lower
bounds from dual feasible functions (rounding to k-ths, cutting off small
items, and both) certify a part's bin count. Parts with a gap between count and
bound exchange documents: they are pooled four by four, packed anew as one, and
the pool stands if it needs fewer bins; this repeats for ``rounds`` rounds or
until no gap is left. Only the number of parts with gaps comes to the driver.

Defined cases: null and empty texts are the closing id alone; repeated rows are
packed each; null doc_id is an ordinary row; an empty table gives an empty
result; further columns of pieces stay (called sequence_id or offset, with ``_in``
behind the name). Numbers of sequences have gaps.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common


@lru_cache(maxsize=4)
def encoder(path: str):
    """Function text -> ids of a byte-level BPE vocabulary file of the tokenizers library.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``.
    Where merges are listed by ascending id, tiktoken gives the same ids about
    five times as fast and is used; else the file's own library.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if plain and not spec["normalizer"] and ids == sorted(ids):
        # the byte of every character of the byte-level alphabet
        byte_of = {pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0][-1]: b for b in range(128)}
        rest = sorted(set(pre_tokenizers.ByteLevel.alphabet()) - set(byte_of))
        shown = [c for c in rest if ord(c) < 256]  # a visible byte stands for itself
        byte_of |= {c: ord(c) for c in shown}
        byte_of |= dict(zip([c for c in rest if ord(c) >= 256], [b for b in range(128, 256) if b not in {ord(c) for c in shown}]))
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: fast.encode_to_numpy(text, allowed_special="all")
    slow = Tokenizer.from_file(path)
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def token_pieces(docs: DataFrame, path: str, length: int = 1024, closing: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every piece; ids are little-endian unsigned 32-bit."""
    def emit(batches):
        encode = encoder(path)
        for batch in batches:
            columns = doc, piece, start, size, ids = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                tokens = np.append(encode(text.as_py() or ""), closing).astype("<u4")
                first = len(tokens) % length or length
                cuts = [0, *range(first, len(tokens) + 1, length)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for column, value in zip(columns, (row, p, a, b - a, tokens[a:b].tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(size, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(emit, "doc_id long, piece int, start long, length long, ids binary"))


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs; counts[x] pieces of length x, bins of len(counts) - 1."""
    size = len(counts) - 1
    x = np.arange(size + 1)
    best = -(-int(counts @ x) // size)
    cuts = [0, *np.flatnonzero(counts[:size // 2 + 1])]
    for e in cuts:
        cut = np.where(x > size - e, size, np.where(x < e, 0, x))  # small ones off, large ones whole
        best = max(best, -(-int(counts @ cut) // size))
        for k in range(1, 7):
            exact = (k + 1) * cut % size == 0
            rounded = np.where(exact, cut * k, (k + 1) * cut // size * size)
            best = max(best, -(-int(counts @ rounded) // (k * size)))
    return best


def best_fit(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Best-fit decreasing over counts of lengths: (lengths of a bin, number of such bins)."""
    size = len(counts) - 1
    free: list[list] = [[] for _ in range(size + 1)]  # by room left: [lengths as a linked list, bins]
    have = np.zeros(size + 1, bool)
    for x in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[x])
        if x == 0:
            continue
        while left:
            fits = np.flatnonzero(have[x:])
            room = x + int(fits[0]) if len(fits) else size
            fresh = not len(fits)
            held, bins = (None, left) if fresh else free[room].pop()
            each = room // x
            full = min(bins, left // each)
            if full:
                for_full = held
                for _ in range(each):
                    for_full = (for_full, x)
                free[room - each * x].append([for_full, full])
                have[room - each * x] = True
                left -= full * each
                bins -= full
            if left and left < each and bins:
                partly = held
                for _ in range(left):
                    partly = (partly, x)
                free[room - left * x].append([partly, 1])
                have[room - left * x] = True
                bins -= 1
                left = 0
            if bins and not fresh:
                free[room].append([held, bins])
            if not fresh:
                have[room] = bool(free[room])
    out = []
    for classes in free:
        for held, bins in classes:
            lengths = []
            while held:
                held, x = held
                lengths.append(x)
            out.append((lengths[::-1], bins))
    return out


def _pack_counts(counts: DataFrame, length: int, slots: bool) -> DataFrame:
    """Pack every group of rows (grp, length, n): (grp, bins, bound), or its slots.

    A slot row (grp, length, place, bins, bin, at) puts the pieces number
    ``place`` .. of that length into the bins from number ``bin`` on.
    """
    def emit(batches):
        for t in common.key_runs(batches, ["grp"]):
            have = np.zeros(length + 1, np.int64)
            np.add.at(have, t["length"].to_numpy(), t["n"].to_numpy())
            packed = best_fit(have)
            grp = t["grp"][0].as_py()
            if not slots:
                yield pa.RecordBatch.from_arrays([pa.array([grp]), pa.array([sum(b for _, b in packed)]), pa.array([lower_bound(have)])], names=["grp", "bins", "bound"])
                continue
            rows, bin_, place = [], 0, np.zeros(length + 1, np.int64)
            for lengths, bins in packed:
                at = 0
                for x in lengths:
                    rows.append((grp, x, int(place[x]), bins, bin_, at))
                    place[x] += bins
                    at += x
                bin_ += bins
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["grp", "length", "place", "bins", "bin", "at"])

    shape = "grp long, length long, place long, bins long, bin long, at long" if slots else "grp long, bins long, bound long"
    return counts.select("grp", "length", "n").repartition("grp").sortWithinPartitions("grp").mapInArrow(emit, shape)


def pack(pieces: DataFrame, length: int = 1024, part_rows: int = 32768, rounds: int = 4) -> DataFrame:
    """``pieces`` (column ``length`` of 1 .. ``length``) with sequence_id and offset added."""
    return common.shielded(pieces, ("length",), ("sequence_id", "offset"), lambda p: _pack(p, length, part_rows, rounds))


def _pack(pieces: DataFrame, length: int, part_rows: int, rounds: int) -> DataFrame:
    if not 0 <= rounds <= 7:
        raise ValueError("rounds must be 0 to 7")
    keyed = cut_lineage(pieces).withColumn("__uid", F.monotonically_increasing_id())
    parts = max(1, -(-keyed.count() // part_rows))
    keyed = keyed.withColumn("__part", F.pmod(F.xxhash64("__uid"), F.lit(parts)))
    counts = cut_lineage(keyed.groupBy(F.col("__part").alias("part"), "length").agg(F.count(F.lit(1)).alias("n")))
    state = counts.select("part").distinct().withColumn("grp", F.col("part"))  # grp: the pool a part is packed in
    result = cut_lineage(_pack_counts(counts.withColumn("grp", F.col("part")), length, False))
    for r in range(1, rounds + 1):
        gaps = result.where("bins > bound")
        n = gaps.count()
        if n < 2:
            break
        pooled = gaps.select("grp", "bins", (F.lit(r * 2**36) + F.pmod(F.xxhash64("grp", F.lit(r)), F.lit(-(-n // 4)))).alias("pool"))
        pool_of = state.join(pooled, "grp").select("part", F.col("pool").alias("grp"))
        again = _pack_counts(counts.join(pool_of, "part"), length, False)
        before = pooled.groupBy("pool").agg(F.sum("bins").alias("before"))
        better = cut_lineage(again.join(before, F.col("grp") == F.col("pool")).where("bins < before").select("grp", "bins", "bound"))
        moved = pooled.join(better.select(F.col("grp").alias("pool")), "pool").select("grp", "pool")
        state = cut_lineage(state.join(moved, "grp", "left").select("part", F.coalesce("pool", "grp").alias("grp")))
        result = cut_lineage(result.join(moved.select("grp"), "grp", "left_anti").unionByName(better))
    counts = counts.join(state, "part")
    # a number of its own for each (grp, bin): grp is below 2**39, its bins follow in the lower 24 bits
    slots = (_pack_counts(counts, length, True)
             .withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1)))
             .select(F.col("grp").alias("__grp"), "length", (F.col("place") + F.col("step")).alias("__place"),
                     (F.shiftleft(F.col("grp"), 24) + F.col("bin") + F.col("step")).alias("__sequence"), F.col("at").alias("__at")))
    first = counts.select(F.col("part").alias("__part"), "length", F.col("grp").alias("__grp"),
                          (F.sum("n").over(Window.partitionBy("grp", "length").orderBy("part")) - F.col("n")).alias("__first"))
    nth = F.row_number().over(Window.partitionBy("__part", "length").orderBy("__uid")) - 1
    placed = (keyed.withColumn("__nth", nth).join(first, ["__part", "length"])
              .withColumn("__place", F.col("__first") + F.col("__nth")))
    return (placed.join(slots, ["__grp", "length", "__place"])
            .select(*[F.col(f"`{c}`") for c in pieces.columns], F.col("__sequence").alias("sequence_id"), F.col("__at").alias("offset")))
