"""Search-term splitting.

The original uses a dictionary segmenter for Chinese in its finest-grained
mode. ``dictionary_segments`` does that with the words of a dictionary table.
No dictionary ships with the original, so the default here is a Unicode word
split done JVM-side: runs of letters/digits, lower-cased. Runs of CJK
ideographs are cut into overlapping bigrams (``word_segments``), the usual
dictionary-free fallback. A Python UDTF form is registered for SQL's
``LATERAL`` syntax.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}]+"
CJK = r"\p{IsHan}"
_SEGMENT_PATTERN = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text: str | Column) -> Column:
    """Array of lower-cased letter/digit runs of the whole text."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_PATTERN), 0)


def word_segments(text: str | Column) -> Column:
    """Like ``split_words`` but a run of CJK ideographs becomes its
    overlapping character bigrams (a single ideograph stays as is)."""
    runs = F.regexp_extract_all(F.lower(_c(text)), F.lit(_SEGMENT_PATTERN), 0)

    def cut(run: Column) -> Column:
        n = F.char_length(run)
        bigrams = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(run, i, 2))
        is_han = run.rlike(r"^\p{IsHan}+$")
        return F.when(is_han & (n > 1), bigrams).otherwise(F.array(run))

    return F.flatten(F.transform(runs, cut))


def register_split_words_udtf(spark: SparkSession, name: str = "split_words") -> None:
    """Register a Python table function for ``LATERAL split_words(x)`` in SQL.

    Slow path (rows go through Python); the column function above is the
    default in every built-in query.
    """
    from pyspark.sql.functions import udtf

    pattern = re.compile(r"[^\W_]+")  # letters and digits of any script

    @udtf(returnType="word: string")
    class SplitWords:
        def eval(self, text: str):
            if text is None:
                return
            for m in pattern.finditer(text.lower()):
                yield (m.group(0),)

    spark.udtf.register(name, SplitWords)


# --------------------------------------------------------------------------
# Finest-grained segmentation by a dictionary table
# --------------------------------------------------------------------------
#: Largest dictionary (rows, and characters of all its words) that goes to the tasks as a trie.
TRIE_WORDS, TRIE_CHARS = 100_000, 400_000


def build_trie(words) -> dict:
    """Words by their characters; the key "" of a node says that a word ends there."""
    root: dict = {}
    for word in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = True
    return root


def trie_matches(text: str, root: dict) -> list[str]:
    """All dictionary words in ``text``, overlapping ones too, by their starts, shorter ones first."""
    out = []
    for i in range(len(text)):
        node, j = root, i
        while j < len(text) and (node := node.get(text[j])) is not None:
            j += 1
            if "" in node:
                out.append(text[i:j])
    return out


def dictionary_segments(terms: DataFrame, dictionary: DataFrame, column: str, word: str = "word",
                        most_words: int = TRIE_WORDS, most_chars: int = TRIE_CHARS) -> DataFrame:
    """``terms`` with one row for each dictionary word found in ``column`` (lower-cased): ``word``.

    Every word of the dictionary at every place counts, overlapping and nested
    ones too. A dictionary of at most ``most_words`` words and ``most_chars``
    characters becomes a trie that each task walks once per start, in Arrow
    batches; a larger one stays a table, and the substrings of the terms that
    have the length of some word are joined with it. Null terms have no words;
    null and empty words of the dictionary find nothing.
    """
    known = dictionary.select(F.lower(F.col(word)).alias("_word")).where(F.length("_word") > 0).distinct()
    size = known.agg(F.count(F.lit(1)).alias("words"), F.sum(F.length("_word")).alias("chars"), F.collect_set(F.length("_word")).alias("lengths")).first()
    if size["words"] <= most_words and (size["chars"] or 0) <= most_chars:
        words = [r[0] for r in known.collect()]

        @F.pandas_udf("array<string>")
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            root = build_trie(words)  # once for a task
            for texts in batches:
                yield texts.map(lambda t: [] if t is None else trie_matches(t, root))

        return terms.withColumn(word, F.explode(find(F.lower(F.col(column)))))
    # as many lengths as differ among the words
    lengths = F.array(*[F.lit(n) for n in sorted(size["lengths"])])
    text = F.lower(F.col(column))
    place = F.explode(F.flatten(F.transform(lengths, lambda n: F.when(F.length(text) >= n, F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))).otherwise(F.array().cast("array<string>")))))
    return terms.withColumn(word, place).join(known, F.col(word) == F.col("_word"), "left_semi")
