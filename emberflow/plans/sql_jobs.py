"""The two SQL-defined jobs, written as Spark SQL over temp views.

The source table is a temp view over a (batch or streaming) DataFrame with
the computed event-time column ``rt`` and, on streams, a watermark, which is
what the original table DDL declares. The query text is plain Spark SQL:
``window()`` in ``GROUP BY`` is the tumbling window, ``window.start/end``
its start/end, and a generator in the select list (or ``LATERAL`` with the
registered UDTF) splits terms.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession

from emberflow.functions.words import WORD_PATTERN
from emberflow.sources.topics import topic_table

_ids = itertools.count()


def register_view(df: DataFrame, prefix: str) -> str:
    name = f"{prefix}_{next(_ids)}"
    df.createOrReplaceTempView(name)
    return name


def keyword_stats_sql(spark: SparkSession, page_rows: DataFrame, stamp: str = "wall",
                      delay: str | None = "1 second") -> DataFrame:
    """``page_view(common MAP, page MAP, ts BIGINT, rt AS whole seconds of ts,
    WATERMARK rt - 1 s)`` -> keyword stats by SQL.

    Nearly every group of a word and a window goes through the shuffle, so in
    batch its key has the window's start alone."""
    src = topic_table(page_rows, "ts", delay)
    view = register_view(src, "page_view")
    time, key, start, end = "rt", "window(rt, '10 seconds')", "window.start", "window.end"
    if not src.isStreaming:
        time = "timestamp_micros(unix_micros(rt) - pmod(unix_micros(rt), 10000000)) AS start"
        key, start, end = "start", "start", "start + INTERVAL 10 SECONDS"
    ts = "unix_timestamp() * 1000" if stamp == "wall" else f"unix_millis({end})"
    pattern = WORD_PATTERN.replace("\\", "\\\\")
    return spark.sql(f"""
        SELECT word AS keyword, count(*) AS ct, 'search' AS source,
               date_format({start}, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format({end}, 'yyyy-MM-dd HH:mm:ss') AS edt,
               {ts} AS ts
        FROM (SELECT explode(regexp_extract_all(lower(page['item']), '{pattern}', 0)) AS word,
                     {time}
              FROM {view}
              WHERE page['last_page_id'] = 'search' AND page['item'] IS NOT NULL AND rt IS NOT NULL)
        GROUP BY word, {key}""")


def province_stats_sql(spark: SparkSession, order_wide_rows: DataFrame, stamp: str = "wall",
                       delay: str | None = "1 second") -> DataFrame:
    """``order_wide(..., rt AS TO_TIMESTAMP(create_time), WATERMARK rt - 1 s)``
    -> province stats by SQL: orders first, then their count, which runs on
    streams too (append mode)."""
    src = order_wide_rows.selectExpr(
        "province_id", "province_name", "province_area_code", "province_iso_code",
        "province_3166_2_code", "order_id", "split_total_amount",
        "try_to_timestamp(create_time, 'yyyy-MM-dd HH:mm:ss') AS rt")
    if src.isStreaming and delay is not None:
        src = src.withWatermark("rt", delay)
    view = register_view(src, "order_wide")
    ts = "unix_timestamp() * 1000" if stamp == "wall" else "unix_millis(w.end)"
    return spark.sql(f"""
        SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               province_id, province_name, province_area_code, province_iso_code,
               province_3166_2_code, CAST(sum(amount) AS DECIMAL(16,2)) AS order_amount,
               count(order_id) AS order_count, {ts} AS ts
        FROM (SELECT window(rt, '10 seconds') AS w, province_id, province_name,
                     province_area_code, province_iso_code, province_3166_2_code, order_id,
                     sum(split_total_amount) AS amount
              FROM {view}
              GROUP BY window(rt, '10 seconds'), province_id, province_name, province_area_code,
                       province_iso_code, province_3166_2_code, order_id)
        GROUP BY w, province_id, province_name, province_area_code, province_iso_code,
                 province_3166_2_code""")


def keyword_stats_lateral_sql(spark: SparkSession, page_rows: DataFrame,
                              stamp: str = "wall") -> DataFrame:
    """The ``LATERAL`` form with the Python UDTF (slow path, for SQL users
    who register their own splitter)."""
    from emberflow.functions.words import register_split_words_udtf
    register_split_words_udtf(spark)
    view = register_view(topic_table(page_rows, "ts", None), "page_view")
    ts = "unix_timestamp() * 1000" if stamp == "wall" else "unix_millis(window.end)"
    return spark.sql(f"""
        SELECT word AS keyword, count(*) AS ct, 'search' AS source,
               date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt, {ts} AS ts
        FROM (SELECT page['item'] AS full_word, rt FROM {view}
              WHERE page['last_page_id'] = 'search' AND page['item'] IS NOT NULL) t,
             LATERAL split_words(full_word)
        GROUP BY word, window(rt, '10 seconds')""")
