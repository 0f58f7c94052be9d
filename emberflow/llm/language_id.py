"""Language identification by language-bitmask n-gram filters (operator 11).

A text is lower-cased, every run of characters that are no letters becomes one
space, and so do its two ends; its n-grams are the strings of ``n`` characters
of that. A language's n-grams are those in at least ``share`` of its training
documents (and in two), where that is ``part`` of the largest share that they
have in any language. They stand in one bit-sliced Bloom filter: an array of
slots, each a mask with one bit for every language. An n-gram's languages are
the bits common to its ``HASHES`` slots, so one lookup answers for all
languages. A text's hits in a language are the sum of that bit over its n-grams
(repeats count). A language whose bits fill a share f of the slots is found
where it is not in f ** HASHES of the lookups; hits are corrected for that:

    (hits - n * f ** HASHES) / (1 - f ** HASHES)

The language with most corrected hits, plus its share of the training documents
(which decides ties and texts without a hit), is predicted; the score is its
part of the sum over languages.

Counts cover all training documents. The filter has a power of two of slots, at
most ``MOST_SLOTS``: more n-grams only make it fuller, and the correction larger.
The languages (their names and numbers of documents) come to the driver.

Training uses text and lang of documents whose crc32 of doc_id (as text) mod 4
is not 2, nothing else; lang, source and doc_id are no inputs of a prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0;
null lang or null doc_id is not learned from, and a null doc_id is not held out;
repeated rows each count; without a training document every text is ``und``
with score 0; equal sums go to the language with more training documents, then
to the smaller name; an empty table gives an empty result; further columns stay
as they are, one called like an added column gets ``_in`` behind its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common, textbytes

HASHES = 3
MOST_SLOTS = 1 << 22
UNKNOWN = "und"
#: Characters of a range of texts that are worked on together.
_CHUNK = 1 << 17
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the texts' offsets among them, and whether each text has a letter."""
    shown = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(shown).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(shown)), [len(t) for t in shown])
    letter = _is_letter()[codes]
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = letter | first
    keep[1:] |= letter[:-1] & ~first[1:]
    some = np.bincount(owner[letter], minlength=len(texts)) > 0
    codes, owner = np.where(letter, codes, 32)[keep].astype(np.uint64), owner[keep]
    count = max(0, len(codes) - n + 1)
    found = np.zeros(count, np.uint64)
    for j in range(n):
        found = found * np.uint64(0x9E3779B97F4A7C15) + codes[j:count + j]
    whole = owner[:count] == owner[n - 1:]
    return textbytes.mix(found[whole]), np.searchsorted(owner[:count][whole], np.arange(len(texts) + 1)), some


def _chunks(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of texts (a longer one by itself): the first one's index and what ``_grams`` gives."""
    _, offs = textbytes.text_buffer(column)
    for i, j in textbytes.chunks(offs, _CHUNK):
        yield i, *_grams([t or "" for t in column.slice(i, j - i).to_pylist()], n)


def _slots(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    """The slots of every n-gram, one array for each hash."""
    step = textbytes.mix(grams ^ np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    return [((grams + np.uint64(h) * step) & np.uint64(slots - 1)).astype(np.int64) for h in range(HASHES)]


@dataclass(frozen=True)
class Filters:
    """Masks by slot (words of 64 languages, or narrower ones), and the languages with their shares and fill."""

    masks: np.ndarray
    languages: list[str]
    prior: np.ndarray
    wrong: np.ndarray
    n: int

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """Masks of the languages that contain each n-gram."""
        slots = _slots(grams, len(self.masks))
        out = self.masks[slots[0]]
        for s in slots[1:]:
            out &= self.masks[s]
        return out

    def hits(self, grams: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Corrected hits of every text (rows) in every language."""
        found = self.containing(grams)
        width = 8 * self.masks.dtype.itemsize
        n = np.diff(cuts).astype(np.float64)
        out = np.empty((len(n), len(self.languages)))
        for x in range(len(self.languages)):
            bit = (found[:, x // width] >> self.masks.dtype.type(x % width)) & self.masks.dtype.type(1)
            total = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
            out[:, x] = total[cuts[1:]] - total[cuts[:-1]]
        return np.maximum((out - n[:, None] * self.wrong) / (1 - self.wrong), 0)

    def predict(self, grams: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language, and score, of every text."""
        weight = self.hits(grams, cuts) + self.prior
        best = weight.argmax(axis=1)
        return best, weight[np.arange(len(best)), best] / weight.sum(axis=1)


def language_grams(docs: DataFrame, n: int) -> DataFrame:
    """(lang, gram, docs): in how many documents of each language every n-gram stands."""
    def emit(batches):
        for batch in batches:
            langs = batch.column(1).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs], np.int64)
            found = []
            for i, grams, cuts, _ in _chunks(batch.column(0), n):
                owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
                order = np.lexsort((grams, owner))
                grams, owner = grams[order], owner[order]
                new = np.ones(len(order), bool)
                new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
                found.append((number[i + owner[new]], grams[new]))
            if not found:
                continue
            own, grams = (np.concatenate(x) for x in zip(*found))
            for x, name in enumerate(names):
                values, count = np.unique(grams[own == x], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), common.long_array(values), pa.array(count.astype(np.int64))],
                                                 names=["lang", "gram", "docs"])
    return (docs.select("text", "lang").mapInArrow(emit, "lang string, gram long, docs long")
            .groupBy("lang", "gram").agg(F.sum("docs").alias("docs")))


def train(docs: DataFrame, n: int = 4, share: float = 0.03, part: float = 0.1, most_slots: int = MOST_SLOTS) -> Filters:
    """Fill the filter from the documents that are not held out."""
    ensure_checkpoint_dir(docs.sparkSession)
    common.ship_package(docs.sparkSession)
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out()).select("text", "lang")
    sizes = sorted(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: (-r["n"], r["lang"]))
    names, number = [r["lang"] for r in sizes], np.array([r["n"] for r in sizes], np.float64)
    if not names:
        return Filters(np.zeros((1, 1), np.uint8), [], number, number, n)
    spark = docs.sparkSession
    # as many rows as there are languages
    least = spark.createDataFrame([(r["lang"], x, max(2, int(np.ceil(share * r["n"]))), float(r["n"])) for x, r in enumerate(sizes)],
                                  "lang string, number int, least long, all double")
    frequent = language_grams(known, n).join(F.broadcast(least), "lang").where("docs >= least").withColumn("rate", F.col("docs") / F.col("all"))
    top = F.max("rate").over(Window.partitionBy("gram"))  # a row for each language at most
    grams = frequent.withColumn("top", top).where(F.col("rate") >= part * F.col("top")).select("number", "gram")
    grams = cut_lineage(grams)
    most = grams.groupBy("number").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    slots = min(most_slots, max(1 << 15, 1 << int(np.ceil(np.log2(8 * most)))))

    def place(batches):
        for batch in batches:
            numbers = batch.column(0).to_numpy().astype(np.int64) * slots
            for s in _slots(batch.column(1).to_numpy().view(np.uint64), slots):
                yield pa.RecordBatch.from_arrays([pa.array(numbers + s)], names=["slot"])

    bits = common.bitmap(grams.mapInArrow(place, "slot long"), "slot", slots * len(names))
    sliced = np.unpackbits(bits, bitorder="little").reshape(len(names), slots)
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(names) <= 8 * np.dtype(t).itemsize or t is np.uint64)
    width = 8 * np.dtype(kind).itemsize
    masks = np.zeros((slots, -(-len(names) // width)), kind)
    for x in range(len(names)):
        masks[:, x // width] |= sliced[x].astype(kind) << kind(x % width)
    return Filters(masks, names, number / number.sum(), np.minimum(sliced.mean(axis=1) ** HASHES, 0.999), n)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with __lang (the predicted language) and __lang_score added."""
    return common.shielded(docs, ("text",), ("__lang", "__lang_score"), lambda d: _identify(d, filters))


def _identify(docs: DataFrame, filters: Filters) -> DataFrame:
    columns = docs.columns
    at = columns.index("text")

    def emit(batches):
        for batch in batches:
            names, scores = [], []
            for _, grams, cuts, some in _chunks(batch.column(at), filters.n):
                if not filters.languages:
                    some = np.zeros(len(some), bool)
                    best, score = np.zeros(len(some), np.int64), np.zeros(len(some))
                else:
                    best, score = filters.predict(grams, cuts)
                names += [filters.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
                scores.append(np.where(some, score, 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))],
                                             names=[*columns, "__lang", "__lang_score"])

    return docs.mapInArrow(emit, docs.withColumn("__lang", F.lit("").cast("string")).withColumn("__lang_score", F.lit(0.0)).schema)
