"""Ten-second statistics: visitor, product, province and keyword reports.

Each report is one aggregate keyed by (window, dimensions), so the shuffle
carries partial aggregates only (hot keys collapse to one row per map task
before the exchange). Distinct order counts are exact: a two-level aggregate
(first by (window, key, order id), then by (window, key)), in batch and as
chained aggregates in append mode on streams, so no per-key set is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberflow import schemas as S
from emberflow.functions.scalars import (APPRAISE_GOOD, event_time_whole_seconds, fmt,
                                         now_millis)
from emberflow.functions.words import split_words
from emberflow.operators.joins import enrich
from emberflow.operators.logs import is_entry_page

WINDOW = "10 seconds"
WINDOW_MS = 10_000



def _zero_l() -> Column:
    return F.lit(0).cast("bigint")


def _zero_m() -> Column:
    return F.lit(0).cast(S.MONEY)


def _ts_of_time_text(col: str) -> Column:
    return F.unix_millis(F.try_to_timestamp(F.col(col), F.lit(S.TIME_FORMAT)))


def _windowed(df: DataFrame, ts_ms: str, delay: str | None) -> tuple[DataFrame, Column]:
    """Add the event-time column ``rt`` (and a watermark on streams)."""
    df = df.withColumn("rt", F.timestamp_millis(F.col(ts_ms)))
    if df.isStreaming and delay is not None:
        df = df.withWatermark("rt", delay)
    return df, F.window("rt", WINDOW)


def window_start(time: str) -> Column:
    """Start of the window of a time: a key of 8 bytes where a window's two ends take 40."""
    micros = F.unix_micros(F.col(time))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(WINDOW_MS * 1000)))


def _both_ends(agg: DataFrame) -> DataFrame:
    """The window's start ``w`` as the window."""
    return agg.withColumn("w", F.struct(F.col("w").alias("start"), (F.col("w") + F.expr(f"INTERVAL {WINDOW}")).alias("end")))


def _window_text(w: str = "w") -> list[Column]:
    return [fmt(F.col(f"{w}.start")).alias("stt"), fmt(F.col(f"{w}.end")).alias("edt")]


# --------------------------------------------------------------------------
# Visitor statistics
# --------------------------------------------------------------------------
VISITOR_DIMS = ["vc", "ch", "ar", "is_new"]


def _visitor_row(df: DataFrame, uv, pv, sv, uj, dur) -> DataFrame:
    return df.select(*[F.col(f"common.{d}").alias(d) for d in VISITOR_DIMS],
                     uv.cast("bigint").alias("uv_ct"), pv.cast("bigint").alias("pv_ct"),
                     sv.cast("bigint").alias("sv_ct"), uj.cast("bigint").alias("uj_ct"),
                     dur.cast("bigint").alias("dur_sum"), F.col("ts"))


def visitor_uv_metric(uv_rows: DataFrame) -> DataFrame:
    return _visitor_row(uv_rows, F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit(0))


def visitor_uj_metric(uj_rows: DataFrame) -> DataFrame:
    return _visitor_row(uj_rows, F.lit(0), F.lit(0), F.lit(0), F.lit(1), F.lit(0))


def visitor_pv_metric(page_rows: DataFrame) -> DataFrame:
    sv = F.when(is_entry_page("page.last_page_id"), 1).otherwise(0)
    return _visitor_row(page_rows, F.lit(0), F.lit(1), sv, F.lit(0),
                        F.coalesce(F.col("page.during_time"), _zero_l()))


def union_visitor(uv_rows: DataFrame, uj_rows: DataFrame, page_rows: DataFrame) -> DataFrame:
    return (visitor_uv_metric(uv_rows).unionByName(visitor_uj_metric(uj_rows))
            .unionByName(visitor_pv_metric(page_rows)))


def visitor_metrics(flagged_pages: DataFrame) -> DataFrame:
    """The rows of ``union_visitor``, those of one page row added up, from ``visits.visit_flags``."""
    sv = F.when(is_entry_page("page.last_page_id"), 1).otherwise(0)
    return _visitor_row(flagged_pages, F.col("uv").cast("int"), F.lit(1), sv, F.col("uj").cast("int"),
                        F.coalesce(F.col("page.during_time"), _zero_l()))


def visitor_stats(metric_rows: DataFrame, delay: str | None = "11 seconds") -> DataFrame:
    """Sum of the five counters per (10 s window, vc, ch, ar, is_new).

    ``ts`` is the smallest event time of the window's rows.
    """
    df, w = _windowed(metric_rows, "ts", delay)
    agg = df.groupBy(w.alias("w"), *VISITOR_DIMS).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in
          ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")],
        F.min("ts").alias("ts"))
    return agg.select(*_window_text(), *VISITOR_DIMS, "uv_ct", "pv_ct", "sv_ct", "uj_ct",
                      "dur_sum", "ts")


# --------------------------------------------------------------------------
# Product statistics
# --------------------------------------------------------------------------
_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
           "good_comment_ct"]
_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
_ORDER_IDS = ["order_oid", "paid_oid", "refund_oid"]


def _product_row(df: DataFrame, sku: Column, ts: Column, **metrics: Column) -> DataFrame:
    cols = [sku.try_cast("bigint").alias("sku_id")]
    for c in _COUNTS:
        cols.append(metrics.get(c, _zero_l()).cast("bigint").alias(c))
    for c in _AMOUNTS:
        cols.append(metrics.get(c, _zero_m()).cast(S.MONEY).alias(c))
    for c in _ORDER_IDS:
        cols.append(metrics.get(c, F.lit(None)).cast("bigint").alias(c))
    cols.append(ts.cast("bigint").alias("ts"))
    return df.select(*cols)


def page_click_metric(page_rows: DataFrame) -> DataFrame:
    """Detail-page views of a SKU: one click each."""
    hit = (F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")
    return _product_row(page_rows.filter(hit), F.col("page.item"), F.col("ts"),
                        click_ct=F.lit(1))


def page_display_metric(page_rows: DataFrame) -> DataFrame:
    """Every SKU display of any page, with the page's ``ts``."""
    d = (page_rows.select(F.explode("displays").alias("d"), "ts")
         .filter(F.col("d.item_type") == "sku_id"))
    return _product_row(d, F.col("d.item"), F.col("ts"), display_ct=F.lit(1))


def page_metrics(page_rows: DataFrame) -> DataFrame:
    """``page_click_metric`` and ``page_display_metric`` in one pass over the pages."""
    def hit(item: Column, click: int) -> Column:
        return F.struct(item.alias("item"), F.lit(click).alias("click"))
    clicked = (F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")
    shown = F.transform(F.filter("displays", lambda d: d["item_type"] == "sku_id"), lambda d: hit(d["item"], 0))
    none = F.array().cast("array<struct<item:string,click:int>>")
    hits = F.concat(F.when(clicked, F.array(hit(F.col("page.item"), 1))).otherwise(none), F.coalesce(shown, none))
    rows = page_rows.select(F.explode(hits).alias("h"), "ts")
    return _product_row(rows, F.col("h.item"), F.col("ts"), click_ct=F.col("h.click"), display_ct=1 - F.col("h.click"))


def favor_metric(favor_info: DataFrame) -> DataFrame:
    return _product_row(favor_info, F.col("sku_id"), _ts_of_time_text("create_time"),
                        favor_ct=F.lit(1))


def cart_metric(cart_info: DataFrame) -> DataFrame:
    return _product_row(cart_info, F.col("sku_id"), _ts_of_time_text("create_time"),
                        cart_ct=F.lit(1))


def order_metric(order_wide_rows: DataFrame) -> DataFrame:
    return _product_row(order_wide_rows, F.col("sku_id"), _ts_of_time_text("create_time"),
                        order_sku_num=F.col("sku_num"),
                        order_amount=F.col("split_total_amount"),
                        order_oid=F.col("order_id"))


def payment_metric(payment_wide_rows: DataFrame) -> DataFrame:
    return _product_row(payment_wide_rows, F.col("sku_id"),
                        _ts_of_time_text("payment_create_time"),
                        payment_amount=F.col("split_total_amount"),
                        paid_oid=F.col("order_id"))


def refund_metric(refund_info: DataFrame) -> DataFrame:
    return _product_row(refund_info, F.col("sku_id"), _ts_of_time_text("create_time"),
                        refund_amount=F.col("refund_amount"),
                        refund_oid=F.col("order_id"))


def comment_metric(comment_info: DataFrame) -> DataFrame:
    good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
    return _product_row(comment_info, F.col("sku_id"), _ts_of_time_text("create_time"),
                        comment_ct=F.lit(1), good_comment_ct=good)


def union_product(*metric_frames: DataFrame) -> DataFrame:
    out = metric_frames[0]
    for f in metric_frames[1:]:
        out = out.unionByName(f)
    return out


def product_stats_core(metric_rows: DataFrame, delay: str | None = "2 seconds") -> DataFrame:
    """Counters per (10 s window, sku) before the dimension lookups.

    In batch the rows are dealt by (window, sku) once, and both levels work on
    them there: rows of orders hardly ever share a key, so level 1 would deal
    them all by their order ids and level 2 all of them again.
    """
    df, w = _windowed(metric_rows, "ts", delay)
    w = w.alias("w")
    if not df.isStreaming:
        df = df.where("rt is not null").withColumn("w", window_start("rt")).drop("rt").repartition("w", "sku_id")
        w = F.col("w")
    sums = [F.sum(c).alias(c) for c in _COUNTS + _AMOUNTS]
    # level 1: one row per (window, sku, order id); level 2: count them.
    lvl1 = df.groupBy(w, "sku_id", *_ORDER_IDS).agg(*sums, F.min("ts").alias("ts"))
    agg = lvl1.groupBy("w", "sku_id").agg(
        *[F.sum(c).alias(c) for c in _COUNTS + _AMOUNTS],
        *[F.count(c).alias(c) for c in _ORDER_IDS], F.min("ts").alias("ts"))
    if not df.isStreaming:
        agg = _both_ends(agg)
    return agg.select(
        *_window_text(), "sku_id",
        *[F.col(c).cast("bigint").alias(c) for c in _COUNTS],
        *[F.col(c).cast(S.MONEY).alias(c) for c in _AMOUNTS],
        F.col("order_oid").alias("order_ct"), F.col("paid_oid").alias("paid_order_ct"),
        F.col("refund_oid").alias("refund_order_ct"), "ts")


#: log2 of the registers of a sketch; its relative standard error is about 1.04 / sqrt(2 ** SKETCH_K).
SKETCH_K = 12


def order_sketches(metric_rows: DataFrame, delay: str | None = "2 seconds") -> DataFrame:
    """Mergeable counts of distinct orders per (10 s window, sku), for roll-ups that
    need not read the orders again: ``order_sketch``, ``paid_sketch`` and
    ``refund_sketch`` (HLL, of fixed size whatever the number of orders). The
    reports themselves count exactly (``product_stats_core``)."""
    df, w = _windowed(metric_rows, "ts", delay)
    agg = df.groupBy(w.alias("w"), "sku_id").agg(*[F.hll_sketch_agg(c, SKETCH_K).alias(c.replace("_oid", "_sketch")) for c in _ORDER_IDS])
    return agg.select(*_window_text(), "sku_id", *[c.replace("_oid", "_sketch") for c in _ORDER_IDS])


def roll_up_orders(sketches: DataFrame, *keys: Column) -> DataFrame:
    """``order_sketches`` rows merged by ``keys`` (a day, a sku, ..): the merged
    sketches and their estimates ``order_ct``, ``paid_order_ct`` and ``refund_order_ct``."""
    names = ("order", "paid", "refund")
    merged = sketches.groupBy(*keys).agg(*[F.hll_union_agg(f"{n}_sketch").alias(f"{n}_sketch") for n in names])
    return merged.select("*", *[F.hll_sketch_estimate(f"{n}_sketch").alias(c) for n, c in zip(names, ("order_ct", "paid_order_ct", "refund_order_ct"))])


def product_dims(core: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """SKU, SPU, category3 and trademark lookups after the window, as one
    lookup of the pre-joined product dimension."""
    from emberflow.operators.wide import dim_product
    product = dims.get("product")
    if product is None:
        product = dim_product(dims["sku"], dims["spu"], dims["tm"], dims["category3"])
    out = enrich(core, product, "sku_id",
                 {"sku_name": "SKU_NAME", "sku_price": F.col("PRICE").try_cast(S.MONEY),
                  "spu_id": "SPU_KEY", "tm_id": "TM_KEY", "category3_id": "CAT_KEY",
                  "spu_name": "SPU_NAME", "category3_name": "CATEGORY3_NAME",
                  "tm_name": "TM_NAME"}, dim_key="sku_key")
    return out.select(*S.PRODUCT_STATS_COLUMNS)


def product_stats(metric_rows: DataFrame, dims: dict[str, DataFrame],
                  delay: str | None = "2 seconds") -> DataFrame:
    return product_dims(product_stats_core(metric_rows, delay), dims)


# --------------------------------------------------------------------------
# Province statistics (SQL job)
# --------------------------------------------------------------------------
PROVINCE_DIMS = ["province_id", "province_name", "province_area_code", "province_iso_code",
                 "province_3166_2_code"]


def province_from_order(order_wide_rows: DataFrame) -> DataFrame:
    """Order-wide row -> one-order stats row."""
    return order_wide_rows.select(
        *PROVINCE_DIMS, F.col("split_total_amount").alias("order_amount"),
        F.lit(1).cast("bigint").alias("order_count"), "order_id", "create_time")


def province_stats(order_wide_rows: DataFrame, delay: str | None = "1 second",
                   stamp: str = "wall") -> DataFrame:
    """Per (10 s window on ``create_time``, province): distinct orders and
    amount. ``stamp='wall'`` sets ``ts`` to the wall clock as the SQL job
    does; ``'window_end'`` makes it repeatable."""
    df = order_wide_rows.withColumn("rt", F.try_to_timestamp("create_time", F.lit(S.TIME_FORMAT)))
    if df.isStreaming and delay is not None:
        df = df.withWatermark("rt", delay)
    w = F.window("rt", WINDOW).alias("w")
    orders = df.groupBy(w, *PROVINCE_DIMS, "order_id").agg(F.sum("split_total_amount").alias("amount"))
    agg = orders.groupBy("w", *PROVINCE_DIMS).agg(
        F.sum("amount").cast(S.MONEY).alias("order_amount"), F.count("order_id").alias("order_count"))
    ts = now_millis() if stamp == "wall" else F.unix_millis(F.col("w.end"))
    return agg.select(*_window_text(), *PROVINCE_DIMS, "order_amount", "order_count",
                      ts.alias("ts"))


# --------------------------------------------------------------------------
# Keyword statistics (SQL job)
# --------------------------------------------------------------------------
def search_term_filter(page_table: DataFrame) -> DataFrame:
    """``page['last_page_id']='search' and page['item'] is not null``."""
    return page_table.filter((F.col("page")["last_page_id"] == "search")
                             & F.col("page")["item"].isNotNull()).select(
        F.col("page")["item"].alias("full_word"), event_time_whole_seconds("ts").alias("rt"))


def split_words_lateral(terms: DataFrame, splitter=split_words) -> DataFrame:
    """``FROM t, LATERAL TABLE(split_words(full_word))`` over whole terms."""
    return terms.select(F.explode(splitter(F.col("full_word"))).alias("word"), "rt")


def keyword_stats(page_table: DataFrame, delay: str | None = "1 second",
                  stamp: str = "wall", splitter=split_words) -> DataFrame:
    words = split_words_lateral(search_term_filter(page_table), splitter)
    if words.isStreaming:
        words = words.withWatermark("rt", delay) if delay is not None else words
        agg = words.groupBy(F.window("rt", WINDOW).alias("w"), "word").agg(F.count(F.lit(1)).alias("ct"))
    else:
        words = words.where("rt is not null")
        agg = _both_ends(words.groupBy(window_start("rt").alias("w"), "word").agg(F.count(F.lit(1)).alias("ct")))
    ts = now_millis() if stamp == "wall" else F.unix_millis(F.col("w.end"))
    return agg.select(F.col("word").alias("keyword"), "ct", F.lit("search").alias("source"),
                      *_window_text(), ts.alias("ts"))


def tumbling_counts(df: DataFrame, ts_ms: str = "ts", delay: str | None = None) -> DataFrame:
    """Rows per 10 s event-time window, with the window as text."""
    d, w = _windowed(df, ts_ms, delay)
    return d.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("ct")).select(
        *_window_text(), "ct")
