"""Conversation structure repair by a square-root checkpointed DP (operator 13).

A conversation's rows are taken by turn (nulls first; equal turns by role, then
text). Each has one fault at most: blank (nothing but white space), duplicate
(role and text stand earlier) or truncated (its last character that is no white
space is none of ``.!?``). Edits make the initials of the roles read
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (1), Delete (2; blank and
duplicate rows must go), Insert an empty text of user or assistant (5); a
truncated row that stays costs 5 more. Of the cheapest edits the ASCII-least
string of initials is the audit.

What the initials so far allow next is one of four states, so costs to the end
are vectors of four. Copies of a row are one row with a number. Rows are sorted
by ranges, so a long conversation is spread over partitions; there, it is cut
into blocks of ``FIRST``, ``FIRST`` + 1, .. rows: with n rows about sqrt(2 n)
blocks of at most about so many rows. Then

1. every block gives the 4 x 4 costs of passing it (smallest sums),
2. from those, the backward cost vectors at the ends of the blocks, the
   checkpoints, are found for each conversation,
3. every block is computed again from its checkpoint, the vectors of its rows
   are held, and it is walked forward from each of the four states,
4. the states in which the blocks are entered are read off in order, which
   picks one of the four walks of each.

A task of 1 and 3 holds one block, of 2 and 4 the block ends of one
conversation. The rows then pass in order through one task for each
conversation, which takes their digest row by row (a SHA-256 cannot be split).

Defined cases: a null role or text is one space; a null turn is an ordinary
turn before all others; null conv_ids are one conversation; equal rows are
copies; a role without initial, or with another than s, u and a, cannot be kept
as it is; an empty table gives an empty result; further columns, whatever their
names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from . import common

#: Rows of a conversation's first block in a partition; the next ones have one more each.
FIRST = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_FAR = 1 << 60
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. What is rerolled or inserted next, and the state then.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
# The state after keeping a row with initial s, u, a or another (None: not allowed).
_KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
_END = (0, 3)
CLEAN, CUT, FORCED = 0, 1, 2
_INITIALS = "sua"
_LEGAL = frozenset(("su", "ua", "au"))
_BLANK, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that the crc32 of ``conv_id:turn`` says."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return turns.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
                                         F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _close(v: list[int]) -> list[int]:
    """Costs when rows may be inserted first."""
    user, assistant = min(v[2], v[3] + INSERT), min(v[3], v[2] + INSERT)
    return [min(v[0], user + INSERT), min(v[1], user + INSERT), user, assistant]


def _before(kind: int, initial: int, after: list[int]) -> list[int]:
    """Costs before a row, from those behind it."""
    out = []
    for q in range(4):
        best = after[q] + DELETE
        if kind != FORCED:
            extra = TRUNCATED if kind == CUT else 0
            best = min(best, after[_NEXT[q]] + REROLE + extra)
            if _KEPT[q][initial] is not None:
                best = min(best, after[_KEPT[q][initial]] + KEEP + extra)
        out.append(best)
    return _close(out)


def _elements(codes: bytes, copies: np.ndarray | None) -> Iterator[tuple[int, int, int]]:
    """(kind, initial, copies) of a block's rows; copies after the first must go and follow as an element of their own."""
    for i, code in enumerate(codes):
        kind, initial = divmod(code, 4)
        n = 1 if copies is None else int(copies[i])
        if kind == FORCED or n == 1:
            yield kind, initial, n
        else:
            yield kind, initial, 1
            yield FORCED, initial, n - 1


def _passing(elements: list[tuple[int, int, int]]) -> list[int]:
    """4 x 4 costs of passing a block: from the state before it to the one behind."""
    columns = []
    for target in range(4):
        v = [0 if q == target else _FAR for q in range(4)]
        for kind, initial, n in reversed(elements):
            v = [min(x + DELETE * n, _FAR) for x in v] if kind == FORCED else [min(x, _FAR) for x in _before(kind, initial, v)]
        columns.append(v)
    return [columns[t][q] for q in range(4) for t in range(4)]


def _vectors(elements: list[tuple[int, int, int]], end: list[int]) -> list[list[int]]:
    """Costs before every element, and behind the last."""
    out = [end]
    for kind, initial, n in reversed(elements):
        out.append([x + DELETE * n for x in out[-1]] if kind == FORCED else _before(kind, initial, out[-1]))
    return out[::-1]


def _walk(elements: list[tuple[int, int, int]], vectors: list[list[int]], q: int, last: bool) -> tuple[str, int]:
    """The cheapest, then ASCII-least edits from state ``q`` on, and the state behind; ``last``: to the end of the conversation."""
    letters = []
    for i, (kind, initial, n) in enumerate(elements):
        after = vectors[i + 1]
        extra = TRUNCATED if kind == CUT else 0
        while True:  # D before I before K before R
            cost = vectors[i][q]
            if after[q] + DELETE * (n if kind == FORCED else 1) == cost:
                letters.append("D" * (n if kind == FORCED else 1))
                break
            if vectors[i][_NEXT[q]] + INSERT == cost:
                letters.append("I")
                q = _NEXT[q]
                continue
            if _KEPT[q][initial] is not None and after[_KEPT[q][initial]] + KEEP + extra == cost:
                letters.append("K")
                q = _KEPT[q][initial]
            else:
                letters.append("R")
                q = _NEXT[q]
            break
    while last and vectors[-1][q]:
        letters.append("I")
        q = _NEXT[q]
    return "".join(letters), q


def _faults(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, blank, duplicate, truncated, kind, initial) of every different row; conv names the conversation."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1).cast("long")
    rows = (turns.select(space("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), copies.alias("n"))
            .groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("digest", F.sha2("text", 256)))
    rows = cut_lineage(rows)
    place = F.coalesce("turn", F.lit(-(2**63)))  # null first
    again = (rows.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
             .select("conv", "role", "digest", "first"))
    rows = rows.join(again, ["conv", "role", "digest"], "left")
    blank = ~F.col("text").rlike(_BLANK)
    later = F.coalesce(place > F.col("first"), F.lit(False))
    rows = rows.withColumn("__blank", blank).withColumn("__later", later).withColumn("__cut", ~F.col("__blank") & ~F.col("__later") & ~F.col("text").rlike(_ENDED))
    none = F.lit(0).cast("long")
    kind = F.when(F.col("__blank") | F.col("__later"), FORCED).when(F.col("__cut"), CUT).otherwise(CLEAN)
    initial = F.substring("role", 1, 1)
    return rows.select("conv", "turn", "role", "text", "n", F.when(F.col("__blank"), F.col("n")).otherwise(none).alias("blank"),
                       F.when(F.col("__blank"), none).when(F.col("__later"), F.col("n")).otherwise(F.col("n") - 1).alias("duplicate"),
                       F.col("__cut").cast("long").alias("truncated"), kind.cast("int").alias("kind"),
                       F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"))


def _block_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of a partition (conv, id first, in order), with the id of the first row of each row's block."""
    conv, size, left, start = None, 0, 0, 0
    for batch in batches:
        ids = batch.column(1).to_numpy()
        found = np.empty(len(ids), np.int64)
        for i, name in enumerate(batch.column(0).to_pylist()):
            if name != conv:
                conv, size, left = name, FIRST - 1, 0
            if not left:
                size += 1
                left, start = size, ids[i]
            found[i] = start
            left -= 1
        yield batch, found


def _blocks(ordered: DataFrame) -> DataFrame:
    """Blocks (conv, block, codes, copies, passing, first, last, illegal) of rows in order."""
    def emit(batches):
        def out(conv, block, codes, copies):
            n = np.array(copies, np.int64)
            many = None if (n == 1).all() else n
            names = [_INITIALS[c % 4] if c % 4 < 3 else "?" for c in codes]
            illegal = int((n - 1).sum()) + sum(a + b not in _LEGAL for a, b in zip(names, names[1:]))
            return pa.RecordBatch.from_arrays(
                [pa.array([conv]), pa.array([block]), pa.array([bytes(codes)], pa.binary()), pa.array([None if many is None else many.tobytes()], pa.binary()),
                 pa.array([_passing(list(_elements(bytes(codes), many)))], pa.list_(pa.int64())), pa.array([names[0]]), pa.array([names[-1]]), pa.array([illegal])],
                names=["conv", "block", "codes", "copies", "passing", "first", "last", "illegal"])

        held = None
        for batch, starts in _block_starts(batches):
            kinds, initials, copies = batch.column(2).to_numpy(), batch.column(3).to_numpy(), batch.column(4).to_numpy()
            names = batch.column(0)
            for i, start in enumerate(starts.tolist()):
                if held is None or held[1] != start:
                    if held:
                        yield out(*held)
                    held = (names[i].as_py(), start, bytearray(), [])
                held[2].append(4 * int(kinds[i]) + int(initials[i]))
                held[3].append(int(copies[i]))
        if held:
            yield out(*held)

    shape = "conv string, block long, codes binary, copies binary, passing array<long>, first string, last string, illegal long"
    return ordered.select("conv", "id", "kind", "initial", "n").mapInArrow(emit, shape)


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """(conv, block, costs behind it, whether it is the last, and in the first: cost and illegal pairs of the conversation)."""
    def emit(batches):
        for t in common.key_runs(batches, ["conv"]):
            passing, first, last, illegal = (t[c].to_pylist() for c in ("passing", "first", "last", "illegal"))
            n = t.num_rows
            end = _close([0 if q in _END else _FAR for q in range(4)])
            behind = [end] * n
            for i in range(n - 1, -1, -1):
                behind[i] = end
                end = [min(min(passing[i][4 * q + x] + end[x] for x in range(4)), _FAR) for q in range(4)]
            pairs = sum(illegal) + sum(a + b not in _LEGAL for a, b in zip(last, first[1:]))
            yield pa.RecordBatch.from_arrays(
                [t["conv"].combine_chunks(), t["block"].combine_chunks(), pa.array(behind, pa.list_(pa.int64())), pa.array([i == n - 1 for i in range(n)]),
                 pa.array([end[0] if not i else None for i in range(n)], pa.int64()), pa.array([pairs if not i else None for i in range(n)], pa.int64())],
                names=["conv", "block", "behind", "is_last", "cost", "illegal"])

    return (blocks.select("conv", "block", "passing", "first", "last", "illegal").repartition("conv").sortWithinPartitions("conv", "block")
            .mapInArrow(emit, "conv string, block long, behind array<long>, is_last boolean, cost long, illegal long"))


def _walks(blocks: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(conv, block, edits and state behind for each state before the block)."""
    def emit(batches):
        for batch in batches:
            edits, states = [], []
            for codes, copies, behind, last in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                elements = list(_elements(codes, None if copies is None else np.frombuffer(copies, np.int64)))
                vectors = _vectors(elements, behind)
                found = [_walk(elements, vectors, q, last) for q in range(4)]
                edits.append([w for w, _ in found])
                states.append([q for _, q in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(edits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32()))],
                                             names=["conv", "block", "edits", "states"])

    both = blocks.select("block", "codes", "copies").join(checkpoints.select("conv", "block", "behind", "is_last"), "block")
    return both.select("conv", "block", "codes", "copies", "behind", "is_last").mapInArrow(emit, "conv string, block long, edits array<string>, states array<int>")


def _entered(walks: DataFrame) -> DataFrame:
    """(block, state in which it is entered)."""
    def emit(batches):
        for t in common.key_runs(batches, ["conv"]):
            q, found = 0, []
            for states in t["states"].to_pylist():
                found.append(q)
                q = states[q]
            yield pa.RecordBatch.from_arrays([t["block"].combine_chunks(), pa.array(found, pa.int32())], names=["block", "state"])

    return (walks.select("conv", "block", "states").repartition("conv").sortWithinPartitions("conv", "block")
            .mapInArrow(emit, "block long, state int"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str | None, str | None]]:
    """(conv, edit, role, text) of every edit in order; role and text of what stays.

    Rows are (conv, edits, state, role, text, n): a block's edits first, then its rows.
    """
    conv, edits, at, q = None, "", 0, 0

    def inserts():
        nonlocal at, q
        while at < len(edits) and edits[at] == "I":
            yield conv, "I", _ROLE[q], ""
            at, q = at + 1, _NEXT[q]

    for batch in batches:
        for name, more, state, role, text, n in zip(*(c.to_pylist() for c in batch.columns)):
            if more is not None:
                yield from inserts()  # at the end of the conversation before
                conv, edits, at, q = name, more, 0, state
                continue
            for _ in range(n):
                yield from inserts()
                edit, at = edits[at], at + 1
                if edit == "K":
                    yield conv, edit, role, text
                    q = _KEPT[q][_INITIALS.index(role[0])]
                elif edit == "R":
                    yield conv, edit, _ROLE[q], text
                    q = _NEXT[q]
                else:
                    yield conv, edit, None, None
    yield from inserts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out():
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=["conv", "audit", "repaired_sha256"])

    conv, audit, digest, some = None, [], hashlib.sha256(), False
    for name, edit, role, text in _edited(batches):
        if name != conv:
            if conv is not None:
                yield out()
            conv, audit, digest, some = name, [], hashlib.sha256(), False
        audit.append(edit)
        if role is not None:
            digest.update((("\n" if some else "") + f"{role}:{text}").encode())
            some = True
    if conv is not None:
        yield out()


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, place, held = None, 0, []
    for name, edit, role, text in _edited(batches):
        if name != conv:
            conv, place = name, 0
        if role is not None:
            held.append((conv, place, role, text, edit))
            place += 1
        if len(held) == common.BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=["conv", "place", "role", "text", "edit"])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=["conv", "place", "role", "text", "edit"])


def _solve(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The different rows in order, the checkpoints, and the rows that ``_edited`` takes."""
    ensure_checkpoint_dir(turns.sparkSession)
    common.ship_package(turns.sparkSession)
    rows = _faults(turns)
    key = ["conv", "turn", "role"]
    ordered = cut_lineage(rows.repartitionByRange(*key, F.substring("text", 1, 64)).sortWithinPartitions(*key, "text"))
    ordered = ordered.withColumn("id", F.monotonically_increasing_id())  # follows the order, without gaps within a partition
    blocks = cut_lineage(_blocks(ordered))
    checkpoints = cut_lineage(_checkpoints(blocks))
    walks = cut_lineage(_walks(blocks, checkpoints))
    chosen = walks.join(_entered(walks), "block").select("conv", "block", F.lit(-1).cast("long").alias("id"), F.col("edits")[F.col("state")].alias("edits"), "state",
                                                         *(F.lit(None).cast(k).alias(c) for c, k in (("role", "string"), ("text", "string"), ("n", "long"))))

    def placed(batches):
        for batch, starts in _block_starts(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts), *batch.columns[1:]], names=["conv", "block", "id", "role", "text", "n"])

    based = (ordered.select("conv", "id", "role", "text", "n").mapInArrow(placed, "conv string, block long, id long, role string, text string, n long")
             .select("conv", "block", "id", F.lit(None).cast("string").alias("edits"), F.lit(None).cast("int").alias("state"), "role", "text", "n"))
    mixed = (chosen.unionByName(based).repartition("conv").sortWithinPartitions("conv", "block", "id")
             .select("conv", "edits", "state", "role", "text", "n"))
    return ordered, checkpoints, mixed


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id as text, place, role, text, edit) of what the repaired conversations consist of."""
    _, _, mixed = _solve(turns)
    return mixed.mapInArrow(_rows_out, "conv string, place long, role string, text string, edit string").withColumnRenamed("conv", "conv_id")


def repair(turns: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    ``turns`` has conv_id, turn, role, text and, if rows stand for several,
    ``copies``. With ``of`` (a table with conv_id), its conversations are
    listed; those without rows have zeros, an empty audit and the digest of nothing.
    """
    listed = turns if of is None else of
    listed = listed.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    ordered, checkpoints, mixed = _solve(turns)
    distinct = F.count_distinct("turn")
    counts = ordered.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - distinct, F.lit(0)).alias("gaps"), F.sum("blank").alias("blank"),
                                         F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"))
    costs = checkpoints.where("cost is not null").select("conv", "illegal", "cost")
    digests = mixed.mapInArrow(_digests, "conv string, audit string, repaired_sha256 string")
    out = listed.join(counts, "conv", "left").join(costs, "conv", "left").join(digests, "conv", "left")
    zero: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
