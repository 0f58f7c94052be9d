"""Every operator on tables whose further columns are called like its own."""

from __future__ import annotations

import os
import sys

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from emberflow.llm import bpe, chat_format, common, exact_dedup, html_text, line_dedup, neighbours, ngram_join, packing, quality, suffix_dedup  # noqa: E402

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
#: Names that the operators use inside or add.
NAMES = ["__touched", "__r", "__t", "__m", "__row", "__doc", "__lines", "__gone", "__kept", "__kept_text", "__n_bytes", "__n_removed", "__n_spans",
         "__n_lines", "__score", "__predicted", "__text", "__uid", "__part", "__nth", "__grp", "__sequence", "__at", "t", "m", "row", "cls", "n", "tokens",
         "spans", "holder", "copies", "ids", "starts", "ends", "decoded", "offset", "sequence_id", "place", "score", "label", "key", "content", "slot",
         "bucket", "link", "v", "asks", "cid", "side", "bi", "bj", "given_0", "given_3", "a b", "c.d", "conv", "__lead", "__first", "step", "level"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


@pytest.fixture(scope="module")
def docs(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{line}\nown one"), (2, f"{line}\nown one"), (3, f"other start {line}\nsecond line of three"), (4, None), (5, "short"), (5, "short")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def clashing(df, but=()):
    names = [n for n in NAMES if n not in df.columns and n not in but]
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names]), names


def shown(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


CALLS = {
    "op1 rows": lambda d: ngram_join.jaccard_components(d, 3, 90),
    "op1 stage": lambda d: ngram_join.drop_near_duplicates(d),
    "op2": lambda d: bpe.decode(bpe.encode(d, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN),
    "op5": lambda d: exact_dedup.exact_duplicates(d),
    "op6": lambda d: packing.pack(packing.token_pieces(d, JSON, length=64), length=64).drop("sequence_id", "offset"),
    "op8": lambda d: html_text.extract(d, "text"),
    "op9": lambda d: line_dedup.remove_lines(d),
    "op10": lambda d: suffix_dedup.remove_repeats(d, 100, 30, words=20),
}


@pytest.mark.parametrize("name", CALLS)
def test_columns_of_any_name_go_through(docs, name):
    plain = CALLS[name](docs)
    wide, names = clashing(docs)
    got = CALLS[name](wide)
    assert len(set(c.lower() for c in got.columns)) == len(got.columns)
    of = {n: n if f"`{n}`" and n in got.columns and n not in plain.columns else f"{n}_in" for n in names}
    kept = [n for n in names if of[n] in got.columns]
    assert kept == names or not kept  # operators of their own columns have none of the input's
    for n in kept:
        assert {r[0] for r in got.select(F.col(f"`{of[n]}`")).distinct().collect()} <= {f"own {n}"}
    assert shown(got.select(plain.columns)) == shown(plain)


def test_scores_beside_columns_of_any_name(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    model = quality.train(clashing(docs)[0], clashing(labels, ("label",))[0])
    plain, got = quality.score(docs, model), quality.score(clashing(docs)[0], model)
    assert shown(got.select(plain.columns)) == shown(plain) and got.first()["__score_in"] == "own __score"


def test_neighbours_and_calls_beside_columns_of_any_name(spark):
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(40)], "vec_id long, embedding array<double>")
    ask = F.col("vec_id") % 20 == 0
    assert shown(neighbours.nearest(clashing(vectors)[0], ask, k=3)) == shown(neighbours.nearest(vectors, ask, k=3))
    calls = spark.createDataFrame([(1, 0, "c", "f", "{}", None)], "conv_id long, turn long, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([(1, 1, "c", "r")], "conv_id long, turn long, call_id string, content string")
    plain = chat_format.link_tool_calls(calls, results, {})
    assert shown(chat_format.link_tool_calls(clashing(calls)[0], clashing(results)[0], {})) == shown(plain)


def test_pipeline_stages_keep_columns_of_any_name(spark, docs):
    given = docs.withColumn("n_chars", F.length("text"))
    wide, names = clashing(given)
    stage = dict(corpus_pipeline.STAGES)["line dedup"]
    plain, got = stage(spark, given, ""), stage(spark, wide, "")
    assert got.columns == wide.columns and shown(got.select(given.columns)) == shown(plain)
    assert all(r[n] == f"own {n}" for r in got.collect() for n in names)
