"""N-gram Jaccard join by prefix trees (operator 1).

A document's set holds its distinct k-word shingles (words are runs of bytes
other than ASCII white space, A-Z lower-cased); a text of fewer words has its
whole sequence as one shingle, a text without words has the empty set and links
with nothing. Two documents link when 100 * |A & B| >= percent * |A | B|.

Steps, all over the whole table:

1. count words in a fixed table of slots: the global token order, rarest first;
2. find the prefix tokens that two documents share; collapse equal sets to classes;
3. gather the classes that share a token around the token's first class; a
   class stays in a group only if some partner there is within the allowed
   difference of sizes and of a 128-slot count sketch (both bounds are lossless);
4. store each group's ordered sets in a prefix tree and search it with every
   member: the overlap with a shared prefix is counted once, and a subtree goes
   when the tokens left on both sides cannot reach the needed overlap;
5. smallest-label components of the links.

Defined cases: null text = empty; empty sets form no class; repeated rows are
copies of a class; null doc_id takes part as a row but names no component;
empty tables give empty results; further columns of ``docs`` are not touched,
whatever their names.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common, setjoin, textbytes
from .components import connected

#: Slots of the sketch of a set: counts (up to 255) of its tokens by slot.
SKETCH = 128


def _sets(column: pa.Array, k: int, levels: np.ndarray):
    """Ranges of a batch with the tokens of their texts (distinct, in the global order) and text offsets."""
    data, offs = textbytes.text_buffer(column)
    for i, j in textbytes.chunks(offs):
        words, at, _ = textbytes.word_hashes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        yield i, *setjoin.distinct_tokens(*setjoin.tokens(words, at, k, levels))


def _prefix_tokens(k: int, percent: int, levels: np.ndarray):
    def prefixes(batch):
        out = [np.zeros(0, np.uint64)]
        for _, found, cuts in _sets(batch.column(0), k, levels):
            out.append(found[setjoin.in_prefix(cuts, percent)])
        return np.concatenate(out)
    return prefixes


def _sketches(found: np.ndarray, cuts: np.ndarray, use: np.ndarray) -> list[bytes]:
    slot = (textbytes.mix(found) >> np.uint64(40)).astype(np.int64) % SKETCH
    return [np.minimum(np.bincount(slot[cuts[x]:cuts[x + 1]], minlength=SKETCH), 255).astype(np.uint8).tobytes() for x in use]


def _document_rows(docs: DataFrame, k: int, percent: int, levels: np.ndarray, live: np.ndarray) -> DataFrame:
    """(doc_id, row, n, cls, live prefix tokens, sketch) of every document; row is a hash of doc_id and text."""
    def emit(batches):
        for batch in batches:
            ids, rows = batch.column(1), batch.column(2)
            for i, found, cuts in _sets(batch.column(0), k, levels):
                n = np.diff(cuts)
                alive = setjoin.in_prefix(cuts, percent) & common.in_bitmap(found, live)
                lists = np.concatenate([[0], np.cumsum(alive)])[cuts]
                use = np.flatnonzero(np.diff(lists))
                sketch = dict(zip(use.tolist(), _sketches(found, cuts, use)))
                keys = setjoin.class_keys(found, cuts)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, len(n)), rows.slice(i, len(n)), pa.array(n, pa.int64()),
                     pa.array([keys[x].tobytes() if n[x] else None for x in range(len(n))], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(lists, pa.int32()), common.long_array(found[alive])),
                     pa.array([sketch.get(x) for x in range(len(n))], pa.binary())],
                    names=["doc_id", "row", "n", "cls", "tokens", "sketch"])
    return (docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), common.row_hash().alias("row"))
            .mapInArrow(emit, "doc_id long, row long, n long, cls binary, tokens array<long>, sketch binary"))


def _near(n: np.ndarray, sketch: np.ndarray, side: np.ndarray, bj_is_bi: bool, percent: int) -> np.ndarray:
    """Which members have a partner within the size and sketch bounds."""
    keep = np.zeros(len(n), bool)
    left = np.arange(len(n)) if bj_is_bi else np.flatnonzero(side == 0)
    right = left if bj_is_bi else np.flatnonzero(side == 1)
    right = right[np.argsort(n[right], kind="stable")]
    nr, sr = n[right], sketch[right].astype(np.int16)
    for i in left:
        a, b = np.searchsorted(nr, [-(-percent * n[i] // 100), n[i] * 100 // percent + 1])
        if a == b:
            continue
        apart = np.abs(sr[a:b] - sketch[i].astype(np.int16)).sum(axis=1, dtype=np.int64)
        ok = (100 + percent) * apart <= (100 - percent) * (n[i] + nr[a:b])
        if bj_is_bi:
            ok &= right[a:b] != i
        if ok.any():
            keep[i] = True
            keep[right[a:b][ok]] = True
    return keep


class PrefixTree:
    """Ordered integer sets, shared prefixes stored once.

    A node is (set whose tokens it shows, from, to, smallest and largest set
    size below, children, sets that end here).
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * len(sets) + 1000))
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.root = self._node(order, 0)

    def _node(self, ids: list[int], start: int):
        first, last = self.sets[ids[0]], self.sets[ids[-1]]
        most = min(len(first), len(last))
        differ = np.flatnonzero(first[start:most] != last[start:most])
        end = start + int(differ[0]) if len(differ) else most
        sizes = [len(self.sets[i]) for i in ids]
        here = [i for i in ids if len(self.sets[i]) == end]
        rest = [i for i in ids if len(self.sets[i]) > end]
        children, at = [], 0
        while at < len(rest):
            token, to = self.sets[rest[at]][end], at + 1
            while to < len(rest) and self.sets[rest[to]][end] == token:
                to += 1
            children.append(self._node(rest[at:to], end))
            at = to
        return ids[0], start, end, min(sizes), max(sizes), children, here

    def search(self, q: np.ndarray, marks: np.ndarray, percent: int, skip):
        """Ids of the stored sets similar to ``q`` (``marks``: q's tokens); ``skip`` leaves some out."""
        stack, n = [(self.root, 0)], len(q)
        while stack:
            (owner, start, end, low, high, children, here), shared = stack.pop()
            if not children and all(skip(i) for i in here):
                continue
            run = self.sets[owner][start:end]
            shared += int(np.count_nonzero(marks[run])) if len(run) else 0
            left = n - int(np.searchsorted(q, run[-1], side="right")) if len(run) else n
            best = min(max(left + end, low), high)  # the size that leaves most room
            if (100 + percent) * (shared + min(left, best - end)) < percent * (n + best):
                continue
            for i in here:
                if not skip(i) and (100 + percent) * shared >= percent * (n + len(self.sets[i])):
                    yield i
            stack.extend((c, shared) for c in children)


def _tree_links(sets: list[np.ndarray], side: np.ndarray, alone: bool, percent: int):
    """Links that connect all similar members of a piece (no more than a forest)."""
    distinct, rank = np.unique(np.concatenate(sets), return_inverse=True)
    ranked = np.split(rank, np.cumsum([len(s) for s in sets])[:-1])
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    stored = list(range(len(sets))) if alone else np.flatnonzero(side == 1).tolist()
    asking = stored if alone else np.flatnonzero(side == 0).tolist()
    if not stored or not asking:
        return
    tree = PrefixTree([ranked[i] for i in stored])
    marks = np.zeros(len(distinct), bool)
    for q in asking:
        marks[ranked[q]] = True
        for i in tree.search(ranked[q], marks, percent, lambda i: root(stored[i]) == root(q)):
            parent[root(stored[i])] = root(q)
            yield q, stored[i]
        marks[ranked[q]] = False


def jaccard_links(docs: DataFrame, shingle: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(documents as rows (doc_id, row, n, cls), links between classes as rows (a, b)).

    The links connect exactly the classes that chains of similar pairs connect;
    pairs already connected inside one piece are not listed again.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    levels = setjoin.word_levels(docs)
    live = common.bitmap(setjoin.repeated(docs.select("text"), _prefix_tokens(shingle, percent, levels)), "token")
    rows = cut_lineage(_document_rows(docs, shingle, percent, levels, live))
    found = cut_lineage(rows.where("sketch is not null").groupBy("cls")
             .agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")))
    members = found.select(F.explode("tokens").alias("token"), "cls")
    pieces = setjoin.dealt(setjoin.groups(members))
    piece_key = ["pivot", "bi", "bj"]

    def prune(batches):
        for t in common.key_runs(batches, piece_key):
            if t.num_rows < 2:
                continue
            n = t["n"].to_numpy()
            sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(n), SKETCH)
            keep = _near(n, sketch, t["side"].to_numpy(), t["bi"][0] == t["bj"][0], percent)
            if keep.any():
                yield from t.select([*piece_key, "side", "cls"]).filter(pa.array(keep)).combine_chunks().to_batches()

    shape = "pivot binary, bi int, bj int, side int, cls binary"
    close = cut_lineage(pieces.join(found.select("cls", "n", "sketch"), "cls")
                        .select(*piece_key, "side", "cls", "n", "sketch")
                        .repartition(*piece_key).sortWithinPartitions(*piece_key).mapInArrow(prune, shape))
    wanted = close.select("cls").distinct()
    holders = rows.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    owners = common.bitmap(holders.select(F.xxhash64("rep").alias("h")), "h")

    def sets(batches):
        for batch in batches:
            pick = common.in_bitmap(batch.column(1).to_numpy(), owners)
            batch = batch.filter(pa.array(pick))
            if not batch.num_rows:
                continue
            keys, blobs = [], []
            for _, found, cuts in _sets(batch.column(0), shingle, levels):
                names = setjoin.class_keys(found, cuts)
                for x in np.flatnonzero(np.diff(cuts)):
                    keys.append(names[x].tobytes())
                    blobs.append(found[cuts[x]:cuts[x + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], names=["cls", "tokens"])

    stored = (docs.select("text", F.xxhash64(F.col("doc_id").cast("long")).alias("h"))
              .mapInArrow(sets, "cls binary, tokens binary").join(wanted, "cls", "left_semi")
              .groupBy("cls").agg(F.first("tokens").alias("tokens")))

    def search(batches):
        for t in common.key_runs(batches, piece_key):
            if t.num_rows < 2:
                continue
            keys = t["cls"].to_pylist()
            found = list(_tree_links([np.frombuffer(b, np.uint64) for b in t["tokens"].to_pylist()], t["side"].to_numpy(),
                                     t["bi"][0] == t["bj"][0], percent))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i, _ in found], pa.binary()), pa.array([keys[j] for _, j in found], pa.binary())], names=["a", "b"])

    links = cut_lineage(close.join(stored, "cls").select(*piece_key, "side", "cls", "tokens")
                        .repartition(*piece_key).sortWithinPartitions(*piece_key)
                        .mapInArrow(search, "a binary, b binary").distinct())
    return rows.select("doc_id", "row", "n", "cls"), links


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, row, n_shingles, component_id (smallest doc_id reachable) of every document."""
    rows, links = jaccard_links(docs, shingle, percent)
    names = connected(links)
    classes = (rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
               .join(names.select(F.col("v").alias("cls"), "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls")))
    smallest = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = classes.join(smallest, "label").select(F.col("cls").alias("of"), "component_id")
    return (rows.join(of_class, F.col("cls") == F.col("of"), "left")
            .select("doc_id", "row", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, once.

    A row without doc_id goes if its component has a doc_id, else it stays.
    """
    return common.shielded(docs, ("doc_id", "text"), (), lambda d: _drop_near_duplicates(d, shingle, percent))


def _drop_near_duplicates(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    found = jaccard_components(docs, shingle, percent)
    found = cut_lineage(found.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("copies"), F.min("component_id").alias("component"), F.max("n_shingles").alias("n"))
                        .withColumn("gone", F.col("component").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component")))
                        .where("gone or (copies > 1 and n > 0)").select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), "gone"))
    touched = common.passes(common.bitmap(found, "__row"))
    based = docs.withColumn("__r", common.row_hash()).withColumn("__touched", touched(F.col("__r")))
    same = (F.col("__r") == F.col("__row")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__doc"))
    some = based.where("__touched").join(found.withColumnRenamed("gone", "__gone"), same, "left").where("__gone is null or not __gone")
    once = some.where("__gone is not null").dropDuplicates(["doc_id", "__r"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (based.where("not __touched").select(*columns)
            .unionByName(some.where("__gone is null").select(*columns)).unionByName(once.select(*columns)))
