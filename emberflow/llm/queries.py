"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, common, conversation_repair, exact_dedup, hard_negatives, html_text, language_id, line_dedup, neighbours, ngram_join, packing, quality, suffix_dedup


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles of all documents, Jaccard of 0.9 or more."""
    found = ngram_join.jaccard_components(common.table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.drop("row")


def op2_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN, offsets=False), path, public_tokenizers.PATTERN, text=False)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose vec_id is divisible by 20."""
    return neighbours.nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


#: What a user's turn asks for, as a call of the tool "reply".
REPLY = {"reply": [chat_format.Field("text", "string", least=20, most=300), chat_format.Field("turn", "integer", least=0)]}


def op4_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of users as calls, and of assistants as results, linked and serialised; others as plain messages.

    A user's turn t calls "reply" with identifier conv_id:t, after the call of
    turn t - 2; an assistant's turn t answers conv_id:(t - 1).
    """
    turns = common.table(spark, sf_dir, "conversations")
    name = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    calls = turns.where("role = 'user'").select(
        "conv_id", "turn", name(0).alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"), name(2).alias("after"))
    results = turns.where("role = 'assistant'").select("conv_id", "turn", name(1).alias("call_id"), F.col("text").alias("content"))
    others = turns.where("role is null or role not in ('user', 'assistant')").select("conv_id", "turn", "role", F.col("text").alias("content"))
    lines = chat_format.link_tool_calls(calls, results, REPLY).unionByName(chat_format.plain_messages(others))
    return lines.select("conv_id", "turn", "kind", "call_id", "step", "status", "valid", F.concat_ws("; ", "errors").alias("errors"), "json")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents; the largest doc_id stays."""
    return exact_dedup.exact_duplicates(common.table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 1024."""
    pieces = packing.token_pieces(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=1024)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), length=1024)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), F.col("__score").alias("score"),
                                             F.col("__predicted").alias("predicted"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = html_text.extract(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents without those similar (0.8) to an earlier line."""
    cut = line_dedup.remove_lines(common.table(spark, sf_dir, "documents"))
    return cut.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.sha2(common.text_or_empty(), 256).alias("kept_sha256"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents in 400-byte strings that start more than once, removed; ``text`` is what is left."""
    cut = suffix_dedup.remove_repeats(common.table(spark, sf_dir, "documents"), length=400)
    return cut.select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"),
                      F.col("__n_spans").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"), F.col("__kept_text").alias("text"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__lang_score").alias("score"))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose vec_id is divisible by 100; every seventh label is moved on first."""
    vectors = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after the damage, their faults and the cheapest edits that mend them."""
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.damage(turns), turns)


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_byte_level_bpe": op2_byte_level_bpe,
    "op3_approximate_nearest_neighbours": op3_approximate_nearest_neighbours,
    "op4_tool_call_linking": op4_tool_call_linking,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_html_extraction": op8_html_extraction,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_language_id": op11_language_id,
    "op12_hard_negative_mining": op12_hard_negative_mining,
    "op13_conversation_repair": op13_conversation_repair,
}
