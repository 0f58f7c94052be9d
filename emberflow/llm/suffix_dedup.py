"""Repeated byte strings by sampled prefix doubling (operator 10).

A text is its UTF-8 bytes. Every byte covered by a ``length``-byte string that
also starts at any other place (the same text included, overlaps count) is
removed; strings are judged on the input and never cross texts.

Ranking every position at offsets 1, 2, 4 .. would write each byte of the corpus
as a row several times over. Here the positions enter in runs: all consecutive
strings that have the same smallest ``seed``-byte gram (place of its hash:
leftmost minimum) form one run, and equal strings always stand at the same
offset of equal grams. Each round then ranks runs by the pair (rank of the
shorter string, hash of the longer one around it):

1. equal grams: a run whose gram starts nowhere else is unique and goes;
2. equal whole runs (first to last string): past the threshold at once, all
   their strings are repeats; one run of each class goes on as a witness where
   its gram has other classes;
3. the rest is cut into steps of ``STEPS[0]`` offsets, then ``STEPS[1]`` ..: the
   bytes common to a step's strings are ranked (unique: gone), then the whole
   step (equal: repeats); the last step is one string at its full length.

Copies of a text stand for one text: all their bytes repeat if it is long
enough. Ranks are 64-bit hashes within the rank of the round before, texts are
named by 78 bits of two hashes. Equal keys are found by Spark aggregates; no
list of equal strings is ever gathered, only lists within one text.

The same rounds find repeated strings of words (``words``): the units are then
the 64-bit hashes of words between white space instead of byte values, and what
is removed reaches from the first byte of the first word to the last of the last.

Defined cases: null text = empty; texts shorter than ``length`` are kept whole;
repeated rows are copies of a text; null doc_id is an ordinary row; an empty
table gives an empty result; further columns stay as they are, one called like an
added column gets ``_in`` behind its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common, textbytes

#: Offsets looked at together, round by round.
STEPS = (48, 8, 1)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _units(column: pa.Array, words: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Ranges of texts: the first one's index, the values of their units, the texts' offsets in units."""
    data, offs = textbytes.text_buffer(column)
    for i, j in textbytes.chunks(offs):
        part, own = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        if words:
            values, own, _ = textbytes.word_hashes(part, own, lower=False)
        else:
            values = textbytes.byte_values(part)
        yield i, values, own


def _sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n = len(values)
    if n < w:
        return values[:0]
    rows = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    rows[:n] = values
    rows = rows.reshape(-1, w)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - w + 1], forward[w - 1:n])


def _runs(values: np.ndarray, offs: np.ndarray, length: int, seed: int):
    """Runs of a range of texts: text index, first and last string, gram place, gram hash; and hash sums."""
    total = textbytes.prefix_sums(values)
    grams = textbytes.mix((total[seed:] - total[:-seed]) * textbytes.powers(textbytes._BASE_INV, len(values))[:max(0, len(values) - seed + 1)]) if len(values) >= seed else total[:0]
    place = np.arange(len(grams), dtype=np.uint64)
    low = _sliding_min((grams >> np.uint64(32) << np.uint64(32)) | place, length - seed + 1)
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offs)
    fit = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), fit)
    start = np.arange(fit.sum()) - np.repeat(np.cumsum(fit) - fit, fit) + np.repeat(offs[:-1], fit)
    if not len(start):
        return text, start, start, start, grams[:0], total
    anchor = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return text[first], start[first], start[last], anchor[first], grams[anchor[first]], total


def _text_key() -> list[Column]:
    text = common.text_or_empty()
    return [F.xxhash64(text).alias("t"), F.pmod(F.xxhash64(F.lit(7), text), F.lit(1 << 14)).alias("m")]


def _name(keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    return textbytes.mix(keys ^ textbytes.mix(place.astype(np.uint64) + np.uint64(1)))


# A run's place in one long: first string (31 bits and sign), m (14), strings after the first (9), gram after the first (9).

def _packed(a: np.ndarray, b: np.ndarray, at: np.ndarray, m: np.ndarray) -> pa.Array:
    return pa.array(a << 32 | m << 18 | (b - a) << 9 | (at - a))


def _unpacked(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    a = packed >> 32
    return a, a + (packed >> 9 & 511), a + (packed & 511), packed >> 18 & 16383


def _gram_rows(texts: DataFrame, length: int, seed: int, words: bool) -> DataFrame:
    def emit(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            for i, values, offs in _units(batch.column(2), words):
                text, _, _, at, gram, _ = _runs(values, offs, length, seed)
                if len(at):
                    yield pa.RecordBatch.from_arrays([common.long_array(gram), common.long_array(_name(keys[i + text], at - offs[text]))], names=["gram", "place"])
    return texts.mapInArrow(emit, "gram long, place long")


def _run_rows(texts: DataFrame, length: int, seed: int, live: np.ndarray, words: bool) -> DataFrame:
    def emit(batches):
        for batch in batches:
            keys, more = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, values, offs in _units(batch.column(2), words):
                text, a, b, at, gram, total = _runs(values, offs, length, seed)
                pick = common.in_bitmap(gram, live)
                if not pick.any():
                    continue
                text, a, b, at, gram = text[pick], a[pick], b[pick], at[pick], gram[pick]
                whole = textbytes.span_hashes(total, a, b + length) + (at - a).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
                own = offs[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i + text]), _packed(a - own, b - own, at - own, more[i + text]), common.long_array(gram), common.long_array(whole)],
                    names=["t", "packed", "rank", "whole"])
    return texts.mapInArrow(emit, "t long, packed long, rank long, whole long")


def _split(rows: DataFrame) -> DataFrame:
    """One round: (t, m, spans, closer) of every text with repeats or runs to look at more closely.

    ``rank`` is the round's rank of the common part, ``whole`` the hash of the
    row's strings together. ``spans`` lists (s, e): the strings from s to e are
    repeats; ``closer`` lists (packed, rank). Rows of copies of a text are equal.
    """
    place = F.xxhash64("t", "packed")
    classes = (rows.groupBy("rank", "whole").agg(F.min(place).alias("witness"), F.max(place).alias("other")))
    ranks = (classes.groupBy("rank").agg((F.min("whole") != F.max("whole")).alias("more"), F.max(F.col("witness") != F.col("other")).alias("some"))
             .where("more or some").select("rank", "more"))
    seen = rows.join(classes.join(ranks, "rank"), ["rank", "whole"])
    repeat = F.col("witness") != F.col("other")
    span = F.struct(F.shiftright("packed", 32).alias("s"), (F.shiftright("packed", 32) + F.expr("shiftright(packed, 9) & 511")).alias("e"))
    return (seen.groupBy("t", F.expr("shiftright(packed, 18) & 16383").alias("m"))
            .agg(F.collect_set(F.when(repeat, span)).alias("spans"),
                 F.collect_set(F.when(F.col("more") & (~repeat | (place == F.col("witness"))), F.struct("packed", "rank"))).alias("closer")))


def _closer_rows(held: DataFrame, length: int, step: int, words: bool) -> DataFrame:
    """The next round's rows, from rows (t, text, list of runs); ``step`` offsets at a time."""
    def emit(batches):
        for batch in batches:
            lists = batch.column(2)
            data, offs = textbytes.text_buffer(batch.column(1))
            flat, cuts = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            packed, ranks = flat.field("packed").to_numpy(), flat.field("rank").to_numpy().view(np.uint64)
            for i in range(batch.num_rows):
                first, last, gram, m = _unpacked(packed[cuts[i]:cuts[i + 1]])
                raw = data[offs[i]:offs[i + 1]]
                total = textbytes.prefix_sums(textbytes.word_hashes(raw, np.array([0, len(raw)]), lower=False)[0] if words else textbytes.byte_values(raw))
                low, high = (gram - last) // step, (gram - first) // step  # steps of offsets gram - start
                count = high - low + 1
                row = np.repeat(np.arange(len(count)), count)
                g = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[row]
                at = gram[row]
                a, b = np.maximum(first[row], at - g * step - step + 1), np.minimum(last[row], at - g * step)
                core = textbytes.span_hashes(total, at - g * step, at - g * step - step + 1 + length)
                rank = textbytes.mix(ranks[cuts[i]:cuts[i + 1]][row] + textbytes.mix(g.astype(np.uint64) + np.uint64(7)) + core)
                whole = textbytes.span_hashes(total, a, b + length) + textbytes.mix((at - a).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), batch.column(0)[i].as_py())), _packed(a, b, at, m[row]), common.long_array(rank), common.long_array(whole)],
                    names=["t", "packed", "rank", "whole"])
    return held.mapInArrow(emit, "t long, packed long, rank long, whole long")


def text_copies(docs: DataFrame) -> DataFrame:
    """(t, m, holder, copies, size) of every text."""
    ensure_checkpoint_dir(docs.sparkSession)
    return cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_key(), F.octet_length(common.text_or_empty()).alias("size"))
                       .groupBy("t", "m").agg(F.min("doc_id").alias("holder"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size")))


def repeated_spans(docs: DataFrame, copies: DataFrame, length: int = 400, seed: int = 128, words: bool = False) -> DataFrame:
    """(t, m, spans) of the texts with repeated strings of ``length`` bytes (words).

    ``spans`` lists lists of (s, e): the strings that start at s .. e occur elsewhere.
    """
    if not 0 <= length - seed < 512:
        raise ValueError("length may exceed seed by 0 to 511")
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    texts = docs.select(*_text_key(), common.text_or_empty().alias("text"))
    grams = _gram_rows(texts, length, seed, words).groupBy("gram").agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low < high")
    live = common.bitmap(grams, "gram")
    rows = cut_lineage(_run_rows(texts, length, seed, live, words))
    found = []
    steps = [s for s in STEPS if s == 1 or 4 * s <= length]  # a step's strings must overlap
    for step in (*steps, None):
        round_ = cut_lineage(_split(rows))
        found.append(round_.where("size(spans) > 0").select("t", "m", "spans"))
        if step is None:
            break
        lists = round_.where("size(closer) > 0").join(copies.select("t", "m", "holder"), ["t", "m"]).select("t", "m", "closer", "holder")
        asked = common.bitmap(lists.select(F.xxhash64("t", "m", "holder").alias("h")), "h")
        holders = docs.select(F.struct(*_text_key()).alias("k"), doc_id, common.text_or_empty().alias("text"))
        holders = holders.where(common.passes(asked)(F.xxhash64("k.t", "k.m", "doc_id")))
        held = (holders.join(lists, (F.col("k.t") == F.col("t")) & (F.col("k.m") == F.col("m")) & holders.doc_id.eqNullSafe(lists.holder))
                .select("t", "text", "closer"))
        rows = cut_lineage(_closer_rows(held, length, step, words))
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans.groupBy("t", "m").agg(F.collect_list("spans").alias("spans"))


def _cut(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Merged byte ranges of one text."""
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


#: Columns that ``remove_repeats`` adds.
ADDED = ("__kept", "__kept_text", "__n_bytes", "__n_removed", "__n_spans")


def remove_repeats(docs: DataFrame, length: int = 400, seed: int = 128, words: int | None = None) -> DataFrame:
    """``docs`` with __kept (remaining bytes), __kept_text, __n_bytes, __n_removed and __n_spans added.

    __kept_text has the remaining bytes without the characters of which a byte
    was removed; the counts are those of the bytes. With ``words``, strings of
    so many words that start more than once go as well, whatever their bytes; a
    copy of a text of as many words goes whole.
    """
    return common.shielded(docs, ("doc_id", "text"), ADDED, lambda d: _remove_repeats(d, length, seed, words))


def _remove_repeats(docs: DataFrame, length: int, seed: int, words: int | None) -> DataFrame:
    copies = text_copies(docs)
    spans = repeated_spans(docs, copies, length, seed).withColumnRenamed("spans", "__spans")
    if words:
        spans = spans.join(repeated_spans(docs, copies, words, -(-words // 3), words=True).withColumnRenamed("spans", "__words"), ["t", "m"], "full")
    else:
        spans = spans.withColumn("__words", F.lit(None).cast(spans.schema["__spans"].dataType))
    wide = F.col("copies").cast("long") > 1
    least = min(length, 2 * words - 1) if words else length
    marked = (copies.where(f"size >= {least}").join(spans, ["t", "m"], "left")
              .where(wide | F.col("__spans").isNotNull() | F.col("__words").isNotNull())
              .select(F.col("t").alias("__t"), F.col("m").alias("__m"), wide.alias("__all"),
                      *(F.when(~wide, F.col(c)).alias(c) for c in ("__spans", "__words"))))
    marked = cut_lineage(marked)
    touched = common.passes(common.bitmap(marked, "__t"))
    t, m = _text_key()
    based = docs.withColumn("__touched", touched(t))
    size = F.octet_length(common.text_or_empty()).cast("long")
    columns = docs.columns
    shape = [F.col(f"`{c}`") for c in columns]

    def whole(df: DataFrame) -> DataFrame:
        return df.select(*shape, common.text_or_empty().cast("binary").alias("__kept"), common.text_or_empty().alias("__kept_text"), size.alias("__n_bytes"),
                         F.lit(0).cast("long").alias("__n_removed"), F.lit(0).cast("long").alias("__n_spans"))

    joined = based.where("__touched").join(marked, (t == F.col("__t")) & (m == F.col("__m")), "left")

    def cut(batches):
        for batch in batches:
            names = batch.schema.names
            texts, bytes_, worded, alls = (batch.column(names.index(c)) for c in ("text", "__spans", "__words", "__all"))
            kept, shown, sizes, gone, runs = [], [], [], [], []
            for text, some, named, full in zip(texts, bytes_, worded, alls):
                raw = (text.as_py() or "").encode()
                at = [w.span() for w in _WORD.finditer(raw)] if words and (named.is_valid or full.as_py()) else []
                if full.as_py():
                    cuts = [(0, len(raw))] if len(raw) >= length or words and len(at) >= words else []
                else:
                    ranges = [(x["s"], x["e"] + length) for group in some.as_py() or [] for x in group]
                    cuts = _cut(ranges + [(at[x["s"]][0], at[x["e"] + words - 1][1]) for group in named.as_py() or [] for x in group])
                edges = [0, *(x for cut_ in cuts for x in cut_), len(raw)]
                parts = [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]
                sizes.append(len(raw))
                gone.append(len(raw) - sum(map(len, parts)))
                kept.append(b"".join(parts))
                shown.append("".join(p.decode("utf-8", "ignore") for p in parts))
                runs.append(len(cuts))
            keep = [names.index(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(kept, pa.binary()), pa.array(shown, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64())],
                names=[*columns, *ADDED])

    out = whole(based.where("not __touched"))
    return out.unionByName(joined.drop("__t", "__m", "__touched").mapInArrow(cut, out.schema))
