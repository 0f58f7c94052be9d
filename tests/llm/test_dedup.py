"""Near-duplicate, line, exact and repeated-string operators against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from emberflow.llm import chat_format, common, components, exact_dedup, line_dedup, ngram_join, setjoin, suffix_dedup, textbytes  # noqa: E402

SHAPE = "doc_id long, text string, token string, t string, bin long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


def corpus(seed=1, n=60):
    """Documents with near copies, shared lines and passages, nulls, empties, repeated rows, a long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 7))) for _ in range(300)]

    def prose(m):
        return " ".join(rng.choice(vocabulary) for _ in range(m))

    passage = prose(30)
    rows = []
    for _ in range(n):
        kind = rng.randrange(6)
        text = "\n".join(prose(rng.randrange(0, 25)) for _ in range(rng.randrange(1, 6)))
        if kind == 0 and rows:  # a near copy
            w = (rng.choice(rows)[1] or "x").split(" ")
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            text = " ".join(w)
        elif kind == 1 and rows:
            text = rng.choice(rows)[1]
        elif kind == 2:
            text = f"{text}\n{passage}\n{prose(5)}"
        rows.append((len(rows), text))
    base = len(rows)
    rows += [(base, None), (base + 1, ""), (base + 2, " \t\n "), (base + 3, "One."), (base + 4, "one."), (base + 5, prose(4000)),
             (base + 6, "ab" * 900), (None, rows[0][1]), (None, prose(20)), rows[3], rows[3]]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", 7) for d, t in rows], SHAPE).repartition(3)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_ngram_components(spark, k, percent):
    rows = corpus()
    got = ngram_join.jaccard_components(frame(spark, rows), k, percent)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=key) == sorted(brute.components(rows, k, percent), key=key)


def test_ngram_hot_group_in_chunks(spark, monkeypatch):
    """A group larger than a piece: all links are found over pairs of chunks."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        w = list(base)
        w[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, f"a{i} b c{i} d e") for i in range(10)]
    dealt = setjoin.dealt
    monkeypatch.setattr(setjoin, "dealt", lambda grouped: dealt(grouped, 7))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(frame(spark, rows), 3, 80).collect()}
    assert got == {d: c for d, _, c in brute.components(rows, 3, 80)}
    monkeypatch.undo()
    pieces = dealt(spark.createDataFrame([(b"p", bytes([i])) for i in range(20)], "pivot binary, cls binary"), 6).collect()
    met = {}
    for p in pieces:
        met.setdefault((p.bi, p.bj), []).append((bytes(p.cls), p.side))
    pairs = set()
    for (bi, bj), m in met.items():
        pairs |= {frozenset((a, b)) for a, s in m for b, u in m if a != b and (bi == bj or s != u)}
    assert len(pairs) == 190


def test_drop_near_duplicates_keeps_one(spark):
    rows = corpus(3)
    docs = frame(spark, rows)
    out = ngram_join.drop_near_duplicates(docs, 5, 80)
    assert out.columns == docs.columns
    expected = {(d, t) for (d, t), (_, n, c) in zip(rows, brute.components(rows, 5, 80)) if c == d or c is None}
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert set(got) == expected
    assert len([g for g in got if g == rows[3] and brute.words(g[1])]) <= 1


def test_lines(spark):
    rows = corpus(2, 45)
    out = line_dedup.remove_lines(frame(spark, rows))
    assert sorted(((r.doc_id or -1, r.text or "") for r in out.collect())) == sorted((d or -1, t or "") for d, t in brute.kept_lines(rows))
    assert {"token", "t", "bin", "__n_lines", "__n_removed"} <= set(out.columns)


def test_similar_lines_at_one_place_stay(spark):
    """Lines of one doc_id (or null) and number do not remove each other, similar or equal; others do."""
    line = " ".join(f"w{i}" for i in range(40))
    near, other = line + " x", line + " y z"
    rows = [(None, f"{line}\nsomething of its own"), (None, f"{near}\nnothing of the kind"), (4, f"a b c\n{line} q"), (4, f"d e f\n{near} r"), (5, other)]
    got = sorted((r.doc_id or -1, r.text) for r in line_dedup.remove_lines(frame(spark, rows)).collect())
    assert got == sorted((d or -1, t) for d, t in brute.kept_lines(rows))
    assert (-1, rows[0][1]) in got and (-1, rows[1][1]) in got and (5, "") in got
    rows = [(7, line), (7, near)]
    assert sorted(r.text for r in line_dedup.remove_lines(frame(spark, rows)).collect()) == sorted((line, near))


def test_lines_min_words(spark):
    rows = [(1, "a b\nthe quick brown fox jumps over it"), (2, "a b\nthe quick brown fox jumps over it\nnew words in this line here")]
    out = {r.doc_id: r.text for r in line_dedup.remove_lines(frame(spark, rows), min_words=5).collect()}
    assert out == dict(brute.kept_lines(rows, min_words=5)) == {1: rows[0][1], 2: "a b\nnew words in this line here"}


@pytest.mark.parametrize("length,seed", [(40, 12), (400, 128)])
def test_repeated_strings(spark, length, seed):
    rows = corpus(4)
    out = suffix_dedup.remove_repeats(frame(spark, rows), length, seed).collect()
    expected = {}
    for (d, t), e in zip(rows, brute.cut_repeats([t for _, t in rows], length)):
        expected.setdefault((d, t), e)
    assert len(out) == len(rows)
    for r in out:
        kept, removed, spans = expected[r.doc_id, r.text]
        assert (bytes(r["__kept"]), r["__n_removed"], r["__n_spans"], r["__n_bytes"]) == (kept, removed, spans, len((r.text or "").encode()))


def test_repeated_strings_whole_characters(spark):
    rows = [(1, "é" * 10 + "x" + "aé" * 30), (2, "ü" + "aé" * 30 + "z")]
    for r in suffix_dedup.remove_repeats(frame(spark, rows), 21, 9).collect():
        assert r["__kept_text"] == bytes(r["__kept"]).decode("utf-8", "ignore")


def test_repeated_passages_of_words(spark):
    """Strings of words are found as brute force finds them, beside strings of bytes."""
    rows = corpus(8)
    for words in (3, 9):
        texts = [t or "" for _, t in rows]
        split = [[m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for t in texts]
        seen = {}
        for t, at in zip(texts, split):
            for i in range(len(at) - words + 1):
                name = tuple(t[a:b] for a, b in at[i:i + words])
                seen[name] = seen.get(name, 0) + 1
        expected = {}
        copies = {t: texts.count(t) for t in texts}
        for (d, _), t, at in zip(rows, texts, split):
            gone = [copies[t] > 1 and len(at) >= words] * len(t)
            for i in range(len(at) - words + 1):
                if seen[tuple(t[a:b] for a, b in at[i:i + words])] > 1:
                    gone[at[i][0]:at[i + words - 1][1]] = [True] * (at[i + words - 1][1] - at[i][0])
            expected[d, t] = "".join(c for c, g in zip(t, gone) if not g)
        out = suffix_dedup.remove_repeats(frame(spark, rows), 100000, seed=99900, words=words).collect()
        assert len(out) == len(rows)
        for r in out:
            assert bytes(r["__kept"]).decode() == expected[r.doc_id, r.text or ""]


def test_stage_removes_passages_of_over_fifty_words(spark):
    """A planted passage of 51 words goes from inside longer lines; clean documents stay as they are."""
    import corpus_pipeline

    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(2000)]
    prose = lambda m: " ".join(rng.choice(vocabulary) for _ in range(m))
    passage, short, unspaced = prose(51), prose(50), "".join(rng.choice("xyz") for _ in range(450))
    assert len(passage) < 400
    rows = [(i, f"start{i} {prose(40)} {passage} {prose(40)} end{i}") for i in range(3)]
    rows += [(10 + i, f"{prose(30)}\n{prose(60)}") for i in range(3)]
    rows += [(20 + i, f"begin{i} {prose(9)} {short} stop{i} {prose(9)}") for i in range(2)]
    rows += [(30 + i, f"{prose(9)} {unspaced} {prose(9)}") for i in range(2)]
    rows += [(40, f"once {passage[:len(passage) // 2]}"), (41, None), (42, "")]
    out = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, frame(spark, rows).withColumn("n_chars", F.lit(0)), "").collect()}
    for d, t in rows:
        if d < 10:
            assert out[d] == t.replace(passage, "")
        elif 30 <= d < 40:
            assert unspaced not in out[d] and len(out[d]) < 200
        else:
            assert out[d] == t


def test_exact(spark):
    rows = corpus(6)
    out = exact_dedup.exact_duplicates(frame(spark, rows), bucket_keys=4).collect()
    assert len(out) == len(rows)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    groups = {}
    for d, t in rows:
        groups.setdefault(digest(t), []).append(d)
    for r in out:
        ids = [d for d in groups[r.text_sha256] if d is not None]
        assert (r.keep_id, r.group_size) == (max(ids) if ids else None, len(groups[r.text_sha256]))
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in out) == len(groups)


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(1000).select((F.col("id") * F.lit((1 << 63) // 4000)).alias("key"))  # a quarter of the key space
    slots, depth = exact_dedup.directory(keys, 100)
    rows = slots.collect()
    loads = {}
    for r in keys.collect():
        slot = r.key >> (63 - depth)
        bucket = next(s.bucket for s in rows if s.slot == slot)
        loads[bucket] = loads.get(bucket, 0) + 1
    assert max(loads.values()) <= 100 and sum(loads.values()) == 1000
    assert all(r.depth <= depth for r in rows)


def test_rows_find_their_text_through_the_directory(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 200).cast("string")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = exact_dedup.build_index(docs, bucket_keys=8)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    links = index.links.select("*", F.input_file_name().alias("file")).collect()
    buckets, files = {}, {}
    for r in links:
        buckets.setdefault(r.bucket, set()).add(r.key)
        files.setdefault(r.file, []).append((r.bucket, r.key))
    assert len(links) == 200 and len(buckets) > 20 and max(map(len, buckets.values())) <= 8
    ranges = sorted((min(v), max(v)) for v in files.values())  # every owner has a range of its own
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))

    asks = docs.select("doc_id", exact_dedup._key(F.col("text")).alias("key"), F.sha2("text", 256).alias("digest"))
    assert exact_dedup.look_up(asks, index).where("group_size = 3 and keep_id >= 400 and keep_id % 200 = doc_id % 200").count() == 600
    gone = index.slots.orderBy("slot").first()
    without = exact_dedup.Index(index.slots.where(F.col("slot") != gone.slot), index.depth, index.links)
    lost = {r.key for r in links if r.key >> (63 - index.depth) == gone.slot}
    assert lost and {r.key for r in asks.join(exact_dedup.look_up(asks, without), "key", "left_anti").collect()} == lost


def test_large_directory_is_joined_by_shuffle(spark, monkeypatch):
    rows = corpus(6)
    want = sorted(map(str, exact_dedup.exact_duplicates(frame(spark, rows), bucket_keys=4).collect()))
    monkeypatch.setattr(exact_dedup, "SENT_SLOTS", 0)
    assert sorted(map(str, exact_dedup.exact_duplicates(frame(spark, rows), bucket_keys=4).collect())) == want


def test_components_of_a_path_and_a_star(spark):
    links = [(i + 1, i) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(50, 50)]
    got = {r.v: r.label for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SHAPE)
    assert ngram_join.jaccard_components(docs).count() == 0
    assert ngram_join.drop_near_duplicates(docs).count() == 0
    assert line_dedup.remove_lines(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert exact_dedup.exact_duplicates(docs).count() == 0


def test_hashes_do_not_depend_on_the_batch():
    import numpy as np
    import pyarrow as pa

    texts = ["one two  three", None, "", "two\tthree four", "one two three"]
    data, offs = textbytes.text_buffer(pa.array(texts))
    words, at, _ = textbytes.word_hashes(data, offs)
    for i, t in enumerate(texts):
        d, o = textbytes.text_buffer(pa.array([t], pa.string()))
        alone, _, _ = textbytes.word_hashes(d, o)
        assert np.array_equal(alone, words[at[i]:at[i + 1]]) and len(alone) == len(brute.words(t))
    grams = textbytes.rolling_hashes(np.frombuffer(b"abcabcabd", np.uint8), 3)
    assert grams[0] == grams[3] and len(set(grams.tolist())) == 4


def test_tool_calls(spark):
    field = chat_format.Field
    schemas = {"add": [field("a", "integer", least=0), field("b", "number", required=False, most=10), field("s", "string", required=False, most=3)]}
    calls = [
        (1, 0, "c0", "add", '{"b": 1.5, "a": 1}', None),
        (1, 2, "c1", "add", '{"a": -1, "s": "long text"}', "c0"),
        (1, 4, "c2", "add", '{"a": "1"}', "c1"),
        (1, 6, "c2", "add", '{"a": 2}', "c1"),  # the identifier again
        (1, 8, None, "add", '{"a": 2}', None),
        (1, 9, "x1", "add", '{"a": 2}', "x2"), (1, 10, "x2", "add", '{"a": 2}', "x1"), (1, 11, "x3", "add", '{"a": 2}', "x2"),
        (2, 0, "c0", "other", '{"a": 1}', "nowhere"),
        (2, 1, "c9", "add", None, None), (2, 2, "c8", "add", "[1]", None), (2, 3, "c7", "add", '{"a": 1, "a": 2}', None), (2, 4, "c6", "add", '{"b": 11}', None),
        (2, 4, "c6", "add", '{"b": 11}', None),
    ]
    results = [(1, 1, "c0", 'say "hi"\n\u00e9'), (1, 3, "c1", None), (1, 5, "c1", "again"), (1, 7, "none", "lost"), (1, 12, None, "no id"), (1, 13, "x1", "r")]
    out = chat_format.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, after string"),
        spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"), schemas).collect()
    at = {(r.conv_id, r.turn): r for r in out}
    assert len(out) == len(calls) - 1 + len(results)
    assert {k: (r.status, r.step) for k, r in at.items()} == {
        (1, 0): ("linked", 0), (1, 2): ("linked", 2), (1, 4): ("unanswered", 4), (1, 6): ("duplicate", None), (1, 8): ("unanswered", None),
        (1, 9): ("cyclic", None), (1, 10): ("cyclic", None), (1, 11): ("cyclic", None), (2, 0): ("unanswered", 0), (2, 1): ("unanswered", 0),
        (2, 2): ("unanswered", 0), (2, 3): ("unanswered", 0), (2, 4): ("unanswered", 0), (1, 1): ("linked", 1), (1, 3): ("linked", 3),
        (1, 5): ("duplicate", None), (1, 7): ("orphan", None), (1, 12): ("orphan", None), (1, 13): ("cyclic", None)}
    assert at[1, 0].json == '{"arguments":{"a":1,"b":1.5},"id":"c0","name":"add","role":"call"}'
    assert at[1, 1].json == '{"content":"say \\"hi\\"\\n\u00e9","id":"c0","role":"result"}'
    assert at[1, 3].json == '{"content":null,"id":"c1","role":"result"}'
    assert at[1, 2].errors == ["a: below 0", "s: above 3"] and at[1, 4].errors == ["a: not integer"]
    assert at[2, 0].errors == ["unknown tool"] and at[2, 4].errors == ["a: missing", "b: above 10"]
    for turn in (1, 2, 3):
        assert at[2, turn].errors == ["arguments: not an object"] and '"arguments":null' in at[2, turn].json


def test_every_row_of_conversations_has_a_line(spark, tmpdir_path):
    from emberflow.llm import queries

    rows = [(1, 0, "system", 'be "kind"'), (1, 1, "user", "a question of some length"), (1, 2, "assistant", "yes"), (1, 3, "tool", None),
            (2, 0, None, "who"), (2, 1, "system", ""), (2, 1, "system", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmpdir_path}/conversations.parquet")
    out = queries.op4_tool_call_linking(spark, tmpdir_path).collect()
    assert len(out) == len(rows)
    plain = sorted((r.conv_id, r.turn, r.call_id, r.step, r.status, r.valid, r.errors, r.json) for r in out if r.kind == "message")
    line = lambda c, t, j: (c, t, None, None, "plain", True, "", j)
    assert plain == [line(1, 0, '{"content":"be \\"kind\\"","role":"system"}'), line(1, 3, '{"content":null,"role":"tool"}'),
                     line(2, 0, '{"content":"who","role":null}'), *[line(2, 1, '{"content":"","role":"system"}')] * 2]
    assert sorted((r.turn, r.status) for r in out if r.kind != "message") == [(1, "linked"), (2, "linked")]


def test_tool_call_chain_levels(spark):
    calls = spark.createDataFrame([(1, f"c{i}", f"c{i - 1}") for i in range(40)], "conv_id long, call_id string, after string")
    assert {r.call_id: r.level for r in chat_format.call_levels(calls).collect()} == {f"c{i}": i for i in range(40)}


def test_tool_calls_empty(spark):
    calls = spark.createDataFrame([], "conv_id long, turn long, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    assert chat_format.link_tool_calls(calls, results, {}).count() == 0
