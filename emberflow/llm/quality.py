"""Quality classifier: naive Bayes support vectors (operator 7).

Features are indicators: byte n-grams of one, two and three bytes (hashed), and
graded indicators of repeated words (share of word pairs that repeat a word,
share of distinct words, each in halving steps). Every indicator is scaled by
the log-count ratio of the two classes, counted over all training rows; vectors
have unit length. A linear model with hinge loss is then fitted by dual
coordinate descent on at most ``fit_rows`` training rows (those with the
smallest hash of doc_id), and a logistic curve over its margins, fitted on the
next ``fit_rows`` / 2 rows, gives the score. Model and curve have a fixed size;
scoring reads every whole text once.

Labels train, and nothing else: rows whose crc32 of doc_id (as text) mod 3 is 1
are held out. Labels, lang, source and doc_id are no inputs of the score.

Defined cases: null text = empty; an empty text has the score of its graded
indicators; null doc_id is scored, never trained on, not held out; of several
labels for one doc_id the highest counts; without training rows of both classes
every score is the share of label 1 (0.5 without labels); an empty table gives
an empty result; further columns stay as they are, one called __score or
__predicted gets ``_in`` behind its name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common, textbytes

SLOTS = 1 << 18
_TWO, _THREE, _GRADED = 256, 256 + 65536, SLOTS - 64
_THREE_SLOTS = 1 << 17
#: Parts in which the sample comes to the driver.
SAMPLE_PARTS = 16


@dataclass(frozen=True)
class Model:
    """Weights by slot (already times the log-count ratio), the ratios, intercept and curve."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        margins = _sums(self.weights[codes], cuts) / np.maximum(_norms(self.ratios, codes, cuts), 1e-12) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[cuts[1:]] - total[cuts[:-1]]


def _norms(ratios: np.ndarray, codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(_sums(ratios[codes].astype(np.float64) ** 2, cuts), 0))


def _graded(share: np.ndarray, base: int) -> np.ndarray:
    """One slot for each halving step of a share between 0 and 1."""
    step = np.minimum(np.floor(-np.log2(np.maximum(share, 2.0**-8))), 8).astype(np.int64)
    return base + step


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of every text, and the texts' offsets among them."""
    n_texts, n = len(offs) - 1, len(data)
    text = np.repeat(np.arange(n_texts), np.diff(offs)).astype(np.uint64) << np.uint64(20)
    one = data.astype(np.uint64)
    keys = [text | one]
    if n > 1:
        pair = one[:-1] << np.uint64(8) | one[1:]
        keys.append((text[:-1] | (pair + np.uint64(_TWO)))[text[:-1] == text[1:]])
    if n > 2:
        three = textbytes.mix(pair[:-1] << np.uint64(8) | one[2:]) % np.uint64(_THREE_SLOTS)
        keys.append((text[:-2] | (three + np.uint64(_THREE)))[text[:-2] == text[2:]])
    words, at, _ = textbytes.word_hashes(data, offs)
    count = np.diff(at)
    owner = np.repeat(np.arange(n_texts), count)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    key = np.unique((owner.astype(np.uint64) << np.uint64(44)) | (words >> np.uint64(20)))
    distinct = np.bincount((key >> np.uint64(44)).astype(np.int64), minlength=n_texts)
    some = np.maximum(count, 1)
    graded = (np.bincount(owner[again], minlength=n_texts) / some, np.where(count > 0, distinct / some, 1))
    for i, share in enumerate(graded):
        keys.append(np.arange(n_texts, dtype=np.uint64) << np.uint64(20) | _graded(share, _GRADED + 16 * i).astype(np.uint64))
    key = np.unique(np.concatenate(keys))
    return (key & np.uint64((1 << 20) - 1)).astype(np.int64), np.searchsorted(key >> np.uint64(20), np.arange(n_texts + 1), side="left")


def _feature_chunks(column: pa.Array):
    data, offs = textbytes.text_buffer(column)
    for i, j in textbytes.chunks(offs):
        yield i, j, *features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def _hinge(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for a linear hinge-loss model with an intercept."""
    w, bias = np.zeros(SLOTS), 0.0
    alpha = np.zeros(len(rows))
    ratios = ratios.astype(np.float64)
    norms = [max(np.sqrt(ratios[codes] @ ratios[codes]), 1e-12) for codes in rows]
    sign = np.where(labels > 0, 1.0, -1.0)
    weight = cost * len(rows) / (2 * np.maximum(np.where(labels > 0, labels.sum(), (labels == 0).sum()), 1))
    rng = np.random.Generator(np.random.PCG64(7))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            codes = rows[i]
            x = ratios[codes] / norms[i]  # made anew each time: the rows' values together would take more than the rows
            gradient = sign[i] * (w[codes] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), weight[i])  # |x|^2 + 1 = 2
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[codes] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    target = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ [a, b], -30, 30)))
        grad = x.T @ (p - target) + [1e-3 * a, 0]
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 6000, cost: float = 1.0, epochs: int = 12) -> Model:
    """Fit the model on the labelled rows of ``docs`` that are not held out."""
    known = (labels.where("doc_id is not null and quality is not null").select("doc_id", "quality").where(~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("quality").cast("int")).alias("label")))
    bits = common.bitmap(known.select(F.xxhash64("id").alias("h")), "h")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    # the labels' side is hashed partition by partition, however small it is: one plan at every size
    rows = (texts.where(common.passes(bits)(F.xxhash64("doc_id"))).join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("id"))
            .select("text", "label"))

    def count(batch):
        out = np.zeros(2 * SLOTS + 4096, np.int64)
        label = batch.column(1).to_numpy()
        for i, _, codes, cuts in _feature_chunks(batch.column(0)):
            own = np.repeat(label[i:i + len(cuts) - 1], np.diff(cuts))
            out[:2 * SLOTS] += np.bincount(codes + SLOTS * (own > 0), minlength=2 * SLOTS)
        out[2 * SLOTS:2 * SLOTS + 2] += np.bincount((label > 0).astype(np.int64), minlength=2)
        return out

    def codes_of(batches):
        for batch in batches:
            lists = [codes[cuts[x]:cuts[x + 1]].astype(np.int32).tobytes() for _, _, codes, cuts in _feature_chunks(batch.column(0)) for x in range(len(cuts) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array(lists, pa.binary())], names=["order", "label", "codes"])

    counts = common.sum_slots(rows.select("text", "label"), count, 2 * SLOTS + 4096)
    classes = counts[2 * SLOTS:2 * SLOTS + 2]
    if not classes.all():
        share = float(np.clip(classes[1] / classes.sum(), 1e-6, 1 - 1e-6)) if classes.sum() else 0.5
        flat = np.zeros(SLOTS, np.float32)
        return Model(flat, flat, 0.0, 1.0, float(np.log(share / (1 - share))))
    low, high = (counts[:SLOTS] + 1) / (classes[0] + 2), (counts[SLOTS:2 * SLOTS] + 1) / (classes[1] + 2)
    ratios = np.log(high / low).astype(np.float32)
    most = fit_rows + fit_rows // 2
    order = F.xxhash64("id", F.lit(11)).alias("order")
    chosen = cut_lineage(texts.select("doc_id").join(known, F.col("doc_id") == F.col("id")).select("id", "label", order).distinct().orderBy("order", "id").limit(most))
    chosen_bits = common.bitmap(chosen.select(F.xxhash64("id").alias("h")), "h")
    sample = (texts.where(common.passes(chosen_bits)(F.xxhash64("doc_id"))).join(chosen, F.col("doc_id") == F.col("id"))
              .select("text", "label", "order").orderBy("order", F.xxhash64("text")).limit(most)
              .mapInArrow(codes_of, "order long, label int, codes binary").repartition(SAMPLE_PARTS))
    # part by part: the driver's JVM holds one of them, not the whole sample in each of its forms
    sample = list(sample.toLocalIterator())
    sample.sort(key=lambda r: (r["order"], r["label"], bytes(r["codes"])))
    lists = [np.frombuffer(r["codes"], np.int32) for r in sample]
    y = np.array([r["label"] > 0 for r in sample], dtype=np.int64)
    fit = min(fit_rows, max(1, 2 * len(sample) // 3))
    w, bias = _hinge(lists[:fit], y[:fit], ratios, cost, epochs)
    weights = (w * ratios).astype(np.float32)
    rest = slice(fit, None) if len(sample) > fit else slice(None)
    margins = np.array([weights[c].astype(np.float64).sum() / max(np.sqrt((ratios[c].astype(np.float64) ** 2).sum()), 1e-12) + bias for c in lists[rest]])
    return Model(weights, ratios, bias, *_curve(margins, y[rest]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with __score (0 to 1) and __predicted (1 if the score is 0.5 or more) added."""
    return common.shielded(docs, ("text",), ("__score", "__predicted"), lambda d: _score(d, model))


def _score(docs: DataFrame, model: Model) -> DataFrame:
    columns = docs.columns
    at = columns.index("text")

    def emit(batches):
        for batch in batches:
            found = [model.scores(codes, cuts) for _, _, codes, cuts in _feature_chunks(batch.column(at))]
            s = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*columns, "__score", "__predicted"])

    shape = docs.withColumn("__score", F.lit(0.0)).withColumn("__predicted", F.lit(0)).schema
    return docs.mapInArrow(emit, shape)
