"""Near-duplicate lines removed by an exact set-similarity join (operator 9).

A line's tokens are its distinct k-word shingles (words as in the n-gram join;
a line of fewer words has its whole sequence as one token). Lines are ordered
by (doc_id, line number). A line goes when an earlier line, removed or not,
has 100 * |A & B| >= percent * |A | B|; the first of similar lines stays.

Steps: count tokens in a fixed table, order them by rarity; find the prefix
tokens that two lines share; collapse equal token sets to classes; gather the
classes of a shared token around the smallest one; within a group apply the
prefix, length and positional filters and verify Jaccard, looking for one
earlier partner; take the removed lines out of the texts.

Defined cases: null text = empty; lines without words stay; null doc_id comes
before every other; lines of the same doc_id and number (repeated rows) do not
remove each other and share their fate if they are equal; ``min_words`` leaves
shorter lines alone (1: all lines take part); an empty table gives an empty
result; further columns stay as they are, one called __n_lines or __n_removed gets
``_in`` behind its name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common, setjoin, textbytes


def _lines(data: np.ndarray, offs: np.ndarray):
    """Line offsets of a range of texts, with each line's text and number there."""
    breaks = np.flatnonzero(data == 10)
    owner = np.concatenate([np.arange(len(offs) - 1), np.searchsorted(offs, breaks, side="right") - 1])
    start = np.concatenate([offs[:-1], breaks + 1])
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    number = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
    return np.append(start, offs[-1]), owner, number


def _line_sets(data: np.ndarray, offs: np.ndarray, k: int, min_words: int, levels: np.ndarray):
    """Tokens of every line (distinct, in the global order), line offsets, and each line's text and number."""
    lines, owner, number = _lines(data, offs)
    words, at, _ = textbytes.word_hashes(data, lines)
    found, cuts = setjoin.tokens(words, at, k, levels)
    if min_words > 1:
        long = np.diff(at) >= min_words
        found = found[np.repeat(long, np.diff(cuts))]
        cuts = np.concatenate([[0], np.cumsum(np.where(long, np.diff(cuts), 0))])
    return *setjoin.distinct_tokens(found, cuts), owner, number


def _prefix_tokens(k: int, percent: int, min_words: int, levels: np.ndarray):
    def prefixes(batch):
        data, offs = textbytes.text_buffer(batch.column(0))
        out = [np.zeros(0, np.uint64)]
        for i, j in textbytes.chunks(offs):
            tokens, cuts, _, _ = _line_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], k, min_words, levels)
            out.append(tokens[setjoin.in_prefix(cuts, percent)])
        return np.concatenate(out)
    return prefixes


def _line_rows(docs: DataFrame, k: int, percent: int, min_words: int, levels: np.ndarray, live: np.ndarray) -> DataFrame:
    """(doc_id, row, line, cls, its first word c, live prefix tokens) of the lines that share a prefix token."""
    def emit(batches):
        for batch in batches:
            data, offs = textbytes.text_buffer(batch.column(0))
            for i, j in textbytes.chunks(offs):
                tokens, cuts, owner, number = _line_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], k, min_words, levels)
                alive = setjoin.in_prefix(cuts, percent) & common.in_bitmap(tokens, live)
                line_of = np.repeat(np.arange(len(owner)), np.diff(cuts))[alive]
                use, first = np.unique(line_of, return_index=True)
                if not len(use):
                    continue
                keys = setjoin.class_keys(tokens, cuts)[use]
                take = pa.array(i + owner[use])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(take), batch.column(2).take(take), pa.array(number[use], pa.int64()),
                     pa.array([x.tobytes() for x in keys], pa.binary()), common.long_array(keys[:, 0]),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(line_of)), pa.int32()), common.long_array(tokens[alive]))],
                    names=["doc_id", "row", "line", "cls", "c", "tokens"])
    return docs.select("text", "doc_id", "row").mapInArrow(emit, "doc_id long, row long, line long, cls binary, c long, tokens array<long>")


def _line_blobs(docs: DataFrame, k: int, min_words: int, levels: np.ndarray, wanted: np.ndarray, classes: np.ndarray) -> DataFrame:
    """(cls, tokens in global order) of the lines of wanted rows that are of wanted classes."""
    def emit(batches):
        for batch in batches:
            rows = batch.column(1).to_numpy().view(np.uint64)
            some = np.flatnonzero(common.in_bitmap(rows, wanted))
            if not len(some):
                continue
            data, offs = textbytes.text_buffer(batch.column(0).take(pa.array(some)))
            for i, j in textbytes.chunks(offs):
                tokens, cuts, _, _ = _line_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], k, min_words, levels)
                keys = setjoin.class_keys(tokens, cuts)
                use = np.flatnonzero((np.diff(cuts) > 0) & common.in_bitmap(keys[:, 0], classes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[x].tobytes() for x in use], pa.binary()),
                     pa.array([tokens[cuts[x]:cuts[x + 1]].tobytes() for x in use], pa.binary())], names=["cls", "tokens"])
    return docs.select("text", "row").mapInArrow(emit, "cls binary, tokens binary")


def _later_matches(sets: list[np.ndarray], side: np.ndarray, alone: bool, percent: int, docs: np.ndarray, lines: np.ndarray):
    """Places of the sets (given in their order of first lines) that match an earlier one.

    ``docs`` and ``lines`` are doc_id and number of the first lines; sets whose first lines agree in both do not match.
    """
    index = defaultdict(list)  # prefix token -> (set, position)
    for x, tokens in enumerate(sets):
        n = len(tokens)
        prefix = tokens[:setjoin.prefix_length(n, percent)].tolist()
        tried = set()
        matched = False
        for i, token in enumerate(prefix):
            for y, j in index[token]:
                m = len(sets[y])
                if y in tried or not (alone or side[x] != side[y]) or 100 * min(n, m) < percent * max(n, m):
                    continue
                tried.add(y)
                if docs[x] == docs[y] and lines[x] == lines[y]:
                    continue
                # the first common token: no more than the rest of either set can follow
                if (100 + percent) * min(n - i, m - j) < percent * (n + m):
                    continue
                shared = len(np.intersect1d(tokens, sets[y], assume_unique=True))
                if (100 + percent) * shared >= percent * (n + m):
                    matched = True
                    break
            if matched:
                break
        if matched:
            yield x
        for i, token in enumerate(prefix):
            index[token].append((x, i))


def removed_lines(docs: DataFrame, shingle: int = 5, percent: int = 80, min_words: int = 1) -> DataFrame:
    """(doc_id, row, line): the lines to remove; ``row`` is a hash of doc_id and text."""
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", common.row_hash())

    levels = setjoin.word_levels(docs)
    live = common.bitmap(setjoin.repeated(docs.select("text"), _prefix_tokens(shingle, percent, min_words, levels)), "token")
    lines = cut_lineage(_line_rows(docs, shingle, percent, min_words, levels, live))
    lowest = F.coalesce("doc_id", F.lit(-(2**63)))  # null first
    classes = cut_lineage(lines.groupBy("cls").agg(
        F.min(F.struct(lowest.alias("d"), F.col("line").alias("l"), F.col("row").alias("r"))).alias("first"),
        F.min("c").alias("c"), F.first("tokens").alias("tokens")))
    members = classes.select(F.explode("tokens").alias("token"), "cls")
    pieces = setjoin.dealt(setjoin.groups(members))
    piece_key = ["pivot", "bi", "bj"]
    placed = cut_lineage(pieces.join(classes.select("cls", "first", "c"), "cls"))
    wanted, of_class = common.bitmap(placed.select(F.col("first.r").alias("h")), "h"), common.bitmap(placed, "c")
    stored = (_line_blobs(docs, shingle, min_words, levels, wanted, of_class)
              .join(placed.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("tokens").alias("tokens")))

    def search(batches):
        for t in common.key_runs(batches, piece_key):
            if t.num_rows < 2:
                continue
            keys = t["cls"].to_pylist()
            found = [keys[x] for x in _later_matches([np.frombuffer(b, np.uint64) for b in t["tokens"].to_pylist()],
                                                    t["side"].to_numpy(), t["bi"][0] == t["bj"][0], percent, t["d"].to_numpy(), t["l"].to_numpy())]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["cls"])

    matched = (placed.join(stored, "cls").select(*piece_key, "side", "first", "cls", "tokens")
               .repartition(*piece_key).sortWithinPartitions(*piece_key, "first", "cls")
               .select(*piece_key, "side", "cls", "tokens", F.col("first.d").alias("d"), F.col("first.l").cast("long").alias("l"))
               .mapInArrow(search, "cls binary").distinct().withColumn("matched", F.lit(True)))
    fate = classes.select("cls", "first").join(matched, "cls", "left")
    later = F.struct(lowest.alias("d"), F.col("line").alias("l")) > F.struct("first.d", "first.l")
    return (lines.select("doc_id", "row", "line", "cls").join(fate, "cls")
            .where(F.col("matched") | later).select("doc_id", "row", "line"))


def remove_lines(docs: DataFrame, shingle: int = 5, percent: int = 80, min_words: int = 1) -> DataFrame:
    """``docs`` with the later lines taken out of ``text``; __n_lines and __n_removed are added.

    The remaining lines are joined by one \\n as before.
    """
    return common.shielded(docs, ("doc_id", "text"), ("__n_lines", "__n_removed"), lambda d: _remove_lines(d, shingle, percent, min_words))


def _remove_lines(docs: DataFrame, shingle: int, percent: int, min_words: int) -> DataFrame:
    gone = (removed_lines(docs, shingle, percent, min_words).groupBy("doc_id", "row")
            .agg(F.collect_set("line").alias("__lines")).withColumnsRenamed({"doc_id": "__doc", "row": "__row"}))
    gone = cut_lineage(gone)
    touched = common.passes(common.bitmap(gone, "__row"))
    columns = docs.columns
    based = docs.withColumn("__r", common.row_hash()).withColumn("__touched", touched(F.col("__r")))
    text = common.text_or_empty()
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    still = based.where("not __touched").select(*[F.col(f"`{c}`") for c in columns], n_lines.alias("__n_lines"), F.lit(0).cast("long").alias("__n_removed"))
    joined = (based.where("__touched")
              .join(gone, (F.col("__r") == F.col("__row")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")), "left"))
    kept = F.filter(F.split(common.text_or_empty(), "\n", -1), lambda x, i: ~F.array_contains(F.col("__lines"), i.cast("long")))
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    cut = joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns],
                        n_lines.alias("__n_lines"), F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("__n_removed"))
    return still.unionByName(cut)
