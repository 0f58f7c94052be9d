"""Classifier, packing, tokens, pages, neighbours and the pipeline."""

from __future__ import annotations

import math
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from emberflow.llm import bpe, common, html_text, neighbours, packing, quality, queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


# tokens

def library():
    import tiktoken
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def odd_texts():
    rng = random.Random(9)
    letters = " \n\t'stSREllmd0123abcé中ß́  aaabbb...,,--==‍👩‍👩‍👧<|endoftext|>�"
    return [None, "", " ", "<|endoftext|>", "a" * 5000] + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(300)]


def test_encode_equals_the_library_and_decodes_back(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids_count", F.lit(1)).repartition(2)
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    own = library()
    rows = bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == own.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text == r.text
        at = 0
        for i, a, b in zip(r.ids, r.starts, r.ends):
            piece = own.decode_single_token_bytes(i)
            before = len(text.encode()[:at].decode("utf-8", "ignore"))
            assert a == before and text.encode()[at:at + len(piece)] == piece
            assert piece in text[a:b].encode() and len(text[a:b].encode()) < len(piece) + 8
            at += len(piece)


def test_decode_of_split_characters_and_unknown_ids(spark):
    ids = library().encode_ordinary("𓀀")
    assert len(ids) > 1
    df = spark.createDataFrame([(ids[:1],), (None,), (ids,)], "ids array<int>")
    got = [(bytes(r.decoded), r.text) for r in bpe.decode(df, RANKS, public_tokenizers.PATTERN).collect()]
    assert len(got) == 3 and (b"", "") in got and ("𓀀".encode(), "𓀀") in got and any("𓀀".encode().startswith(b) and b and "�" in t for b, t in got)
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([([50256],)], "ids array<int>"), RANKS, public_tokenizers.PATTERN).collect()


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    coder, own = bpe.Codec(RANKS, public_tokenizers.PATTERN), library()
    for text in ("one two three four five six", "seven one two", "", "three four"):
        assert coder.encode([text])[0].tolist() == own.encode_ordinary(text)


# packing

def test_pieces_and_sequences(spark):
    from tokenizers import Tokenizer

    texts = odd_texts()[:60] + ["word " * 300]
    df = spark.createDataFrame(list(enumerate(texts)) + [(7, texts[7])], "doc_id long, text string")
    pieces = packing.token_pieces(df, JSON, length=64)
    packed = packing.pack(pieces.withColumn("place", F.lit(3)), length=64, part_rows=64).collect()
    slow = Tokenizer.from_file(JSON)
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, t in enumerate(texts):
        ids = slow.encode(t or "", add_special_tokens=False).ids + [2]
        copies = 2 if d == 7 else 1
        rows = sorted(by_doc[d], key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in rows[::copies]) == np.array(ids, "<u4").tobytes()
        assert all(r.length == 64 for r in rows if r.piece) and len(rows) == copies * math.ceil(len(ids) / 64)
        assert [r.start for r in rows[::copies]] == np.cumsum([0] + [r.length for r in rows[::copies]])[:-1].tolist()
    filled = {}
    for r in packed:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    counts = np.zeros(65, np.int64)
    np.add.at(counts, [r.length for r in packed], 1)
    at_once = sum(bins for _, bins in packing.best_fit(counts))
    assert packing.lower_bound(counts) <= len(filled) <= at_once + 4


def test_best_fit_equals_item_by_item():
    rng = random.Random(2)
    for _ in range(60):
        size = rng.choice([10, 17, 64])
        items = [rng.randrange(1, size + 1) for _ in range(rng.randrange(0, 120))]
        rooms = []
        for x in sorted(items, reverse=True):
            fits = [r for r in rooms if r >= x]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - x)
            else:
                rooms.append(size - x)
        counts = np.bincount(items, minlength=size + 1) if items else np.zeros(size + 1, np.int64)
        packed = packing.best_fit(counts)
        assert sorted(size - sum(lengths) for lengths, bins in packed for _ in range(bins)) == sorted(rooms)
        assert sorted(x for lengths, bins in packed for x in lengths * bins) == sorted(items)
        assert packing.lower_bound(counts) <= len(rooms)


def test_lower_bound_beats_the_sum():
    counts = np.zeros(11, np.int64)
    counts[6] = 4  # no two fit together
    assert packing.lower_bound(counts) == 4
    counts[:] = 0
    counts[4] = 4  # 4 x 4 in bins of 10: two each
    assert packing.lower_bound(counts) == 2


def test_pack_empty(spark):
    pieces = packing.token_pieces(spark.createDataFrame([], "doc_id long, text string"), JSON)
    assert packing.pack(pieces).count() == 0


# quality

def test_quality_learns_from_rows_that_are_not_held_out(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    labels = common.table(spark, "/root/testdata/sf0.01", "labels")
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    model = quality.train(docs, labels)
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, flipped)
    assert np.array_equal(model.weights, again.weights) and (model.bias, model.slope, model.offset) == (again.bias, again.slope, again.offset)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.score(docs.select("doc_id", "text", quality.held_out().alias("held")), model).collect()
    assert all(r.held == held(r.doc_id) and 0 <= r["__score"] <= 1 and r["__predicted"] == (r["__score"] >= 0.5) for r in rows)
    out = [(r["__score"], known[r.doc_id]) for r in rows if r.held and r.doc_id in known]
    pairs = [(a, b) for a, x in out for b, y in out if x > y]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.98


def test_quality_sample_comes_part_by_part(spark, monkeypatch):
    """The driver gets the sample's codes in parts, never in one collect."""
    docs = spark.createDataFrame([(i, f"word{i} other words") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    kind, parts = type(docs), []
    collect, stream = kind.collect, kind.toLocalIterator

    def watched(df):
        assert "codes" not in df.columns
        return collect(df)

    def streamed(df, *args):
        parts.append(df.rdd.getNumPartitions())
        return stream(df, *args)

    monkeypatch.setattr(kind, "collect", watched)
    monkeypatch.setattr(kind, "toLocalIterator", streamed)
    quality.train(docs, labels)
    assert parts == [quality.SAMPLE_PARTS]


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "x"), (2, None), (None, ""), (3, "word " * 50000), (3, "word " * 50000)], "doc_id long, text string").withColumn("score", F.lit("s"))
    for labels, expected in (([], 0.5), ([(1, 1), (2, None), (None, 0)], None), ([(1, 0), (1, 1), (3, 0), (2, 1)], None)):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        rows = quality.score(docs, quality.train(docs, table)).collect()
        assert len(rows) == 5 and all(0 <= r["__score"] <= 1 for r in rows)
        assert expected is None or all(abs(r["__score"] - expected) < 1e-9 for r in rows)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), table)).count() == 0


# pages

@pytest.mark.parametrize("source,expected", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain &amp; simple", "plain & simple"),
    ("<body><nav><a href=x>menu</a></nav><article><h1>T &lt;b&gt;</h1><p>One\n  two<b> three</b><p>Four</article><footer>f</footer>", "T <b>\nOne two three\nFour"),
    ("<body><div class='ad box'>buy</div><div id=main><p>Text of the page here.</p><ul><li>a<li>b</ul></div><div class=comments><p>c</p></div>", "Text of the page here.\na\nb"),
    ("<body><header>site</header><main><header><h1>Title</h1></header><p>Body text.</p><aside>side</aside><form>f<input></form></main><script>x='</p>'</script>", "Title\nBody text."),
    ("<body><article><p>x<!-- <p>no</p> --> y<br>z<table><tr><td>1<td>2</table></article><!-- open", "x y\nz\n1\n2"),
    ("<body><div role=navigation>n</div><p hidden>h</p><p style='display: none'>d</p><p>Seen text.</p>", "Seen text."),
])
def test_main_text(source, expected):
    assert html_text.main_text(source) == expected


@pytest.mark.parametrize("wrapper", ["div class='layout has-sidebar'", "div id='page' class='no-sidebar'", "form action='/'", "div class=sidebar"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_main_text_in_wrappers(wrapper, tag):
    """An element around the main text is not left out by its name; menus and comments in it are."""
    long = "The text of the page, which is longer than anything else here, by far. " * 4
    end = wrapper.split()[0]
    source = (f"<body><{wrapper}><div class=menu><a href=x>Home</a></div><{tag}><p>{long}</p></{tag}>"
              f"<ol class=commentlist><li><article class=comment><p>so true</p></article></li></ol></{end}></body>")
    if tag == "div":
        source = source.replace("<article class=comment>", "").replace("</article>", "")
    assert html_text.main_text(source) == long.strip()


def test_main_text_keeps_code_comments():
    source = "<article><p>Some code follows:</p><pre>x = 1 <span class='hljs-comment'># one</span></pre><div class='comments'>hello</div></article>"
    assert html_text.main_text(source) == "Some code follows:\nx = 1 # one"


def test_extract_keeps_columns_and_rows(spark):
    pages = spark.createDataFrame([(1, None, "u"), (2, "<p>a b</p>" * 3, "u"), (2, "<p>a b</p>" * 3, "u"), (None, "<p>" * 3000 + "deep", "u")], "page_id long, html string, text string")
    rows = html_text.extract(pages).collect()
    assert sorted((r["__text"], r.text) for r in rows) == [("", "u"), ("a b\na b\na b", "u"), ("a b\na b\na b", "u"), ("deep", "u")]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_articles_of_the_pages(spark):
    import re
    for r in common.table(spark, SMALL, "pages").collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html_text.html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?(?:h1|p|br)>", inner)]
        assert html_text.main_text(r.html) == "\n".join(b for b in blocks if b)


# neighbours

def exact_nearest(rows, k):
    out = {}
    for q, v in rows:
        near = sorted(((-float(np.dot(v, w)), i) for i, w in rows if i != q))[:k]
        out[q] = [(i, -s) for s, i in near]
    return out


def test_neighbours_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(6).round(2).tolist()) for i in range(40)] + [(100 + i, [1.0, 2.0] + [0.0] * 4) for i in range(30)]
    bad = [(200, None), (220, [0.0] * 6), (240, [1.0, None] + [0.0] * 4), (260, [float("nan")] * 6), (280, [float("inf")] + [0.0] * 5), (300, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(good + bad + good[:2], "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("v", F.lit(2))
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5, bits=64, radius=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = {q: v for q, v in exact_nearest(good, 5).items() if q % 20 == 0}
    assert got.keys() == expected.keys()
    for q, near in expected.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near] and np.allclose([s for _, s in got[q]], [s for _, s in near], rtol=0, atol=1e-12)


def test_neighbours_recall(spark):
    d = "/root/testdata/sf0.1"
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in common.table(spark, d, "embeddings").collect()]
    found = neighbours.nearest(common.table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20, rerank=200).collect()
    expected = {q: {i for i, _ in near} for q, near in exact_nearest([r for r in rows], 20).items() if q % 20 == 0}
    hits = sum(r.vec_id in expected[r.query_id] for r in found)
    assert len(found) == 20 * len(expected) and hits / len(found) >= 0.9


def test_pigeonhole_finds_every_code():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 16, (500, 4), dtype=np.uint16)
    query = codes[0] ^ np.array([1, 0, 6, 0], np.uint16)
    index = neighbours.BlockIndex(codes)
    for radius in (0, 3, 20, 28, 40, 64):
        far = neighbours._POPCOUNT[codes ^ query].sum(axis=1)
        assert index.within(query, radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_neighbours_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(one, F.col("vec_id") % 20 == 0).count() == 0


# queries and pipeline

def test_every_operator_is_registered_and_reads_its_whole_table(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = common.table(spark, SMALL, "documents")
    extra = spark.createDataFrame([(10**6, None, "en", "s", None), (10**6 + 1, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.limit(1))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "suffix-array dedup", "best-fit packing"]
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SMALL).cache()
        if i < 4:
            assert after.columns == docs.columns
            assert all(r.text is None or r.n_chars == len(r.text) for r in after.collect()) or i == 0
        given, got = rows(before), rows(after) if i < 4 else None
        if i == 1:
            expected = [(d, t) for (d, t), (_, s) in zip(brute.kept_lines(given), given) if t == s or brute.words(t)]
            assert sorted(((d or -1, t or "") for d, t in got)) == sorted((d or -1, t or "") for d, t in expected)
        if i == 2:
            assert set(got) == {g for g, (_, n, c) in zip(given, brute.components(given, 5, 80)) if c in (None, g[0])}
        if i == 3:
            kept = brute.cut_passages([t for _, t in given], 400, corpus_pipeline.PASSAGE_WORDS)
            expected = [(d, k) for (d, t), k in zip(given, kept) if k == (t or "") or brute.words(k)]
            assert sorted((d or -1, t or "") for d, t in got) == sorted((d or -1, t) for d, t in expected)
        if i == 4:
            assert {r.doc_id for r in after.collect()} == {d for d, _ in given}
        before = after


def test_pipeline_run(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0
