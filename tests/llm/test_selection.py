"""Language identification, hard negatives and conversation repair against brute force; queries against their SQL."""

from __future__ import annotations

import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute_repair  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

from emberflow.llm import common, conversation_repair, hard_negatives, language_id, oracle, queries  # noqa: E402

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SMALL), name, queries.QUERIES[name], oracle.SQL[name], SMALL)
    assert r["ok"], r.get("why")


# language identification

def plain_grams(text, n=4):
    shown = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    shown = f" {' '.join(shown.split())} " if shown.split() else " "
    return [shown[i:i + n] for i in range(len(shown) - n + 1)]


def test_language_counts_and_filters_equal_sets(spark):
    texts = [("the cat sat on the mat", "en"), ("The CAT, again: the-cat!", "en"), ("le chat est sur la table", "fr"), ("Le chat\n\tdort 12 x", "fr"),
             ("\u00e9t\u00e9 \u00c9T\u00c9 le chat", "fr"), ("the the", "en"), (None, "en"), ("", "fr"), ("a", "en"), ("123", "fr")]
    df = spark.createDataFrame(texts, "text string, lang string")
    got = {}
    for r in language_id.language_grams(df, 4).collect():
        got.setdefault(r.lang, {})[r.gram] = r.docs
    for lang in ("en", "fr"):
        df_of = {}
        for t, own in texts:
            if own == lang:
                for g in set(plain_grams(t or "")):
                    df_of[g] = df_of.get(g, 0) + 1
        assert sorted(got[lang].values()) == sorted(df_of.values())
    # the filter answers for every language at once, and never misses
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts * 8)]
    filters = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), share=0.0, part=0.0)
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    sets = {x: {} for x in filters.languages}
    for _, t, lang in known:
        for g in set(plain_grams(t or "")):
            sets[lang][g] = sets[lang].get(g, 0) + 1
    sample = ["the cat", "le chat", "\u00e9t\u00e9", "zzzz yyyy wwww vvvv"]
    grams, cuts, _ = language_id._grams(sample, 4)
    masks = filters.containing(grams)[:, 0]
    want = np.array([sum((sets[x].get(g, 0) > 1) << b for b, x in enumerate(filters.languages)) for t in sample for g in plain_grams(t)])
    assert len(want) == len(masks) == cuts[-1] and (masks & want == want).all() and (masks != want).mean() < 0.05
    hits = filters.hits(grams, cuts)
    exact = np.array([[sum(sets[x].get(g, 0) > 1 for g in plain_grams(t)) for x in filters.languages] for t in sample])
    assert np.abs(hits - exact).max() < 1


def test_false_positives_are_corrected():
    rng = np.random.default_rng(0)
    slots, wrong = 1 << 15, 0.6**language_id.HASHES
    masks = (rng.random((slots, 1)) < 0.6).astype(np.uint8)  # one language, full of strangers
    filters = language_id.Filters(masks, ["x"], np.ones(1), np.array([wrong]), 4)
    grams = rng.integers(0, 2**63, 20000, dtype=np.uint64)
    assert abs(filters.hits(grams, np.array([0, 20000]))[0, 0]) < 400 < 20000 * wrong


def test_languages_of_held_out_documents(spark):
    out = queries.op11_language_id(spark, LARGER).join(common.table(spark, LARGER, "documents").select(F.col("doc_id").alias("d"), "lang"), F.col("doc_id") == F.col("d")).collect()
    assert len(out) == common.table(spark, LARGER, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98


def test_language_edges(spark):
    shape = "doc_id long, text string, lang string, __lang string, gram long"
    rows = [(i, "the cat sat on the mat " * 3, "en", "own", i) for i in range(9)] + [(20 + i, "le chat est sur la table " * 3, "fr", "own", i) for i in range(9)]
    odd = [(100, None, "en", "own", 0), (101, "", "en", "own", 0), (102, "12 34 --", "en", "own", 0), (None, "le chat est sur", None, "own", 0),
           (103, "le chat est sur la table " * 4000, None, "own", 0), (104, "q", None, "own", 0), (104, "q", None, "own", 0)]
    df = spark.createDataFrame(rows + odd, shape)
    filters = language_id.train(df)
    out = language_id.identify(df, filters)
    assert out.columns == ["doc_id", "text", "lang", "__lang_in", "gram", "__lang", "__lang_score"] and out.count() == len(rows) + len(odd)
    at = {r.doc_id: (r["__lang"], r["__lang_score"], r["__lang_in"]) for r in out.collect()}
    assert at[100] == at[101] == at[102] == ("und", 0.0, "own")
    assert at[None][0] == at[103][0] == at[20][0] == "fr" and at[0][0] == "en" and at[104][0] == filters.languages[0]
    empty = language_id.train(df.limit(0))
    assert {(r["__lang"], r["__lang_score"]) for r in language_id.identify(df, empty).collect()} == {("und", 0.0)}
    assert language_id.identify(df.limit(0), filters).count() == 0


# hard negatives

def plain_negatives(rows, anchors, low=30, high=90):
    v = {i: (label, [int(np.floor(256 * float(x))) for x in e]) for i, label, e in rows}
    out = []
    for a in sorted(i for i in v if anchors(i)):
        score = {i: sum(x * y for x, y in zip(v[a][1], v[i][1])) for i in v if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if v[i][0] == v[a][0]][:5]:
            near = [i for i in ranked if v[i][0] != v[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]][:10]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(near)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((4, 6))
    rows = [(i, int(i % 3), (centres[i % 4] + 0.4 * rng.standard_normal(6)).round(2).tolist()) for i in range(300)]
    rows += [(1000 + i, 1, rows[5][2]) for i in range(200)]  # one vector many times, ties in every score
    rows += [(2000, 7, [0.5] * 6), (2010, 2, [0.0] * 6)]
    bad = [(3000, None, [1.0] * 6), (3010, 1, None), (3020, 1, [1.0, None] + [1.0] * 4), (3030, 1, [float("nan")] * 6), (3040, 1, [float("inf")] * 6),
           (3050, 1, [1.0]), (None, 1, [1.0] * 6)]
    df = spark.createDataFrame([(i, label, e, 1, "x") for i, label, e in rows + bad + rows[:20]],
                               "vec_id long, label long, embedding array<double>, block long, windows string")
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, block_rows=16).collect()
    assert sorted(tuple(r) for r in got) == plain_negatives(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    alone = hard_negatives.mine(df.where("vec_id = 2000"), F.col("vec_id") % 10 == 0)
    assert alone.count() == 0 and alone.columns == [r.split(" ")[0] for r in hard_negatives.SHAPE.split(", ")]
    huge = spark.createDataFrame([(0, 1, [1e14, 1.0]), (1, 1, [1e14, 2.0])], "vec_id long, label long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(huge, F.col("vec_id") % 10 == 0).collect()


def test_zone_maps_bound_every_product():
    rng = np.random.default_rng(5)
    anchors, vectors = rng.integers(-50, 50, (20, 8)).astype(float), rng.integers(-50, 50, (90, 8)).astype(float)
    blocks = np.split(vectors[np.argsort(hard_negatives.hilbert_index((vectors + 50).astype(np.int64), 7))], 9)
    down, up = hard_negatives.bounds(anchors, np.array([b.min(axis=0) for b in blocks]), np.array([b.max(axis=0) for b in blocks]))
    for x, b in enumerate(blocks):
        products = anchors @ b.T
        assert (down[:, x] <= products.min(axis=1)).all() and (products.max(axis=1) <= up[:, x]).all()


def test_zone_maps_leave_blocks_out(spark):
    """Of clustered vectors only a part of the blocks is read."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((16, 8)) * 3
    rows = [(i, int(i % 2), (centres[i % 16] + 0.05 * rng.standard_normal(8)).tolist()) for i in range(1600)]
    df = spark.createDataFrame([(i, label, [int(256 * x) for x in e]) for i, label, e in rows], "vec_id long, label long, v array<long>")
    blocks, zones = hard_negatives.write_blocks(df, 8, 1600, 50)
    asks = df.where("vec_id % 100 = 0").select(
        F.col("vec_id").alias("anchor_id"), "label", "v", F.lit(True).alias("same"),
        F.expr("array(struct(-9007199254740992L as low, 9007199254740992L as high, -9007199254740992L as last))").alias("windows"),
        F.lit(5).alias("k"), F.expr("cast(array() as array<long>)").alias("seen"))
    n, first = zones.count(), hard_negatives.blocks_to_read(asks, zones, 8, True)
    assert n >= 20 and first.count() <= 3 * asks.count()
    v = {i: (label, np.array([int(256 * x) for x in e])) for i, label, e in rows}
    fifth = {a: sorted((-int(v[a][1] @ w) for i, (label, w) in v.items() if i != a and label == v[a][0]))[4] for a in range(0, 1600, 100)}
    lasts = spark.createDataFrame([(a, -s) for a, s in fifth.items()], "anchor_id long, last long")
    again = asks.drop("windows").join(lasts, "anchor_id").withColumn("windows", F.expr("array(struct(-9007199254740992L as low, 9007199254740992L as high, last))"))
    rest = hard_negatives.blocks_to_read(again.select(asks.columns), zones, 8, False).count()
    assert rest < 0.25 * n * asks.count()


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    place = hard_negatives.hilbert_index(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


# conversation repair

def turns(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(60), None]:
        for i in range(rng.choice([1, 2, 3, 7, 20])):
            rows.append((conv, rng.choice([None, i, i, i, i // 2]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]),
                         rng.choice(["a.", "b!", "c", "  ", "", "d? \n", None, f"x{i}.", f"y{i}", "long " * 5000 + "."])))
    rows += rows[:40]
    # one conversation with a third of all rows and more, over several blocks and partitions
    rows += [(1000, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{i}.", f"{i}!", ""])) for i in range(1500)]
    return rows + [(1001, None, "user", "same.")] * 300


SHAPE = "conv_id long, turn long, role string, text string, block long, edits string, n string"


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_search_over_all_edits(spark, seed, tmpdir_path):
    rows = turns(seed)
    spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE).repartition(7).write.parquet(f"{tmpdir_path}/conversations.parquet")
    out = queries.op13_conversation_repair(spark, tmpdir_path)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 7 + ["string"] * 2
    assert {r.conv_id: tuple(r)[1:] for r in out.collect()} == brute_repair.repaired(rows)


def test_repaired_rows_are_those_of_the_digest(spark):
    import hashlib

    rows = [r for r in turns(3) if r[0] is None or r[0] < 1000]
    given = conversation_repair.damage(spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE))
    lines = {}
    for r in sorted(conversation_repair.repaired_turns(given).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in conversation_repair.repair(given).collect():
        name = " " if r.conv_id is None else str(r.conv_id)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(lines.get(name, [])).encode()).hexdigest()


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], SHAPE)
    assert conversation_repair.repair(none).count() == 0 and conversation_repair.repaired_turns(none).count() == 0
    one = conversation_repair.repair(none, spark.createDataFrame([(5, 0, "user", "x", 1, "", "")], SHAPE)).collect()
    assert [tuple(r) for r in one] == [(5, 0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")]
