"""Named queries over the driver tables, one per operator id of the survey.

Each entry is ``(spark, sf_dir) -> DataFrame``. The inputs are built by the
fixture adapters from the whole driver tables; nothing is sampled or capped.
Compared outputs cast money to double (exact decimal sums, one rounding) so
that Spark and DuckDB hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberflow.functions import scalars as SC
from emberflow.functions.words import dictionary_segments, split_words, word_segments
from emberflow.operators import cdc, joins, logs, report, stats, visits, wide
from emberflow.plans import sql_jobs
from emberflow.sources import fixtures as FX
from emberflow.sources import topics

# Parameters of the fixture runs: the original bands, +-5 s between order and
# detail, -15 min / +5 s between payment and order.
ORDER_BAND_MS = 5_000
PAYMENT_LOWER_MS, PAYMENT_UPPER_MS = -15 * 60_000, 5_000
JUMP_WITHIN_MS = 3_600_000       # same-visitor gaps in ``events`` are minutes apart
CSV_BAND_MS = 3_600_000
AGE_AS_OF = "2026-01-01"

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Money as double for hashing; everything else unchanged."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


# --------------------------------------------------------------------------
# shared inputs
# --------------------------------------------------------------------------
class Inputs:
    """Shared inputs of one query, each built once (same DataFrame object
    wherever a query uses it twice)."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self._memo: dict = {}

    def _get(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def dims(self):
        def build():
            s, d = self.spark, self.d
            out = {"user": FX.dim_user_info(s, d), "province": FX.dim_base_province(s, d),
                   "sku": FX.dim_sku_info(s, d), "spu": FX.dim_spu_info(s, d),
                   "tm": FX.dim_base_trademark(s, d), "category3": FX.dim_base_category3(s, d)}
            out["product"] = wide.dim_product(out["sku"], out["spu"], out["tm"],
                                              out["category3"])
            return out
        return self._get("dims", build)

    def order_wide(self):
        return self._get("order_wide", lambda: wide.order_wide(
            FX.order_info(self.spark, self.d), FX.order_detail(self.spark, self.d),
            self.dims(), -ORDER_BAND_MS, ORDER_BAND_MS, as_of()))

    def payment_wide(self):
        return self._get("payment_wide", lambda: wide.payment_wide_from_orders(
            FX.payment_info(self.spark, self.d), FX.order_info(self.spark, self.d),
            FX.order_detail(self.spark, self.d), self.dims(), -ORDER_BAND_MS, ORDER_BAND_MS,
            PAYMENT_LOWER_MS, PAYMENT_UPPER_MS, as_of()))

    def merged_orders(self):
        """Order x detail rows before the dimension lookups (one object, so
        every branch of a query shares it)."""
        return self._get("merged", lambda: merged_orders(self.spark, self.d))

    def order_lines(self):
        """The columns the order metric and the payment join read.

        Built as one struct beside the order id, so that neither branch drops
        columns below it: both are the same subtree, and the shuffles under it
        run once. The id stays a column of its own, so the lines are still
        known to be dealt by it and the payments meet them where they lie.
        """
        def build():
            line = F.array(F.struct("sku_id", "sku_num", "split_total_amount", "create_time")).alias("_line")
            dealt = self.merged_orders().select("order_id", line).repartition("order_id")
            return dealt.select("order_id", F.inline("_line"))
        return self._get("lines", build)

    def paid_lines(self):
        def build():
            j = wide.payment_wide_join(FX.payment_info(self.spark, self.d), self.order_lines(),
                                       PAYMENT_LOWER_MS, PAYMENT_UPPER_MS)
            return j.select("sku_id", F.col("p_create_time").alias("payment_create_time"),
                            "split_total_amount", F.col("p_order_id").alias("order_id"))
        return self._get("paid", build)

    def page_rows_fixture(self):
        return self._get("pages", lambda: page_rows_fixture(self.spark, self.d))


def parsed_log(spark, d):
    return logs.parse_log(FX.raw_log_lines(spark, d))


def repaired_log(spark, d):
    return logs.repair_is_new(logs.clean_rows(parsed_log(spark, d)))


def page_rows(spark, d):
    return logs.split_page(repaired_log(spark, d))


def page_rows_fixture(spark, d):
    """Repaired page rows straight from the structured fixture (no JSON trip)."""
    return logs.split_page(logs.repair_is_new(FX.page_log_rows(spark, d)))


def dims(spark, d):
    return Inputs(spark, d).dims()


def as_of():
    return F.to_date(F.lit(AGE_AS_OF))


def merged_orders(spark, d):
    j = wide.order_detail_join(FX.order_info(spark, d), FX.order_detail(spark, d),
                               -ORDER_BAND_MS, ORDER_BAND_MS)
    return wide.order_wide_merge(j)


def order_wide_rows(spark, d):
    return Inputs(spark, d).order_wide()


def payment_wide_rows(spark, d):
    return Inputs(spark, d).payment_wide()


def envelopes(spark, d):
    return cdc.cdc_normalize(FX.change_records(spark, d))


def product_metric_frames(spark, d, inp: Inputs | None = None):
    inp = inp or Inputs(spark, d)
    # click / display counts read no visitor flag: the page split alone is
    # enough (the repaired and unrepaired page rows give the same metrics)
    pr = logs.split_page(FX.page_log_rows(spark, d))
    return [stats.page_metrics(pr),
            stats.favor_metric(FX.favor_info(spark, d)), stats.cart_metric(FX.cart_info(spark, d)),
            # metrics read no dimension column; the lookups are left joins on
            # unique keys, so the un-enriched lines give the same rows
            stats.order_metric(inp.order_lines()),
            stats.payment_metric(inp.paid_lines()),
            stats.refund_metric(FX.order_refund_info(spark, d)),
            stats.comment_metric(FX.comment_info(spark, d))]


def product_stats_rows(spark, d):
    inp = Inputs(spark, d)
    return stats.product_stats(stats.union_product(*product_metric_frames(spark, d, inp)),
                               inp.dims())


# --------------------------------------------------------------------------
# projections used by several entries
# --------------------------------------------------------------------------
PAGE_FLAT = ["seq", "ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc", "during_time",
             "item", "item_type", "last_page_id", "page_id", "source_type", "ts"]


def _visit_proj(df):
    return df.select("seq", "common.mid", "common.is_new", "page.page_id",
                     "page.last_page_id", "ts")


def _env_proj(df):
    return df.select("seq", "database", F.col("tableName").alias("table_name"), "type",
                     F.col("before")["id"].alias("before_id"),
                     F.col("after")["id"].alias("after_id"),
                     F.cardinality("before").alias("before_n"),
                     F.cardinality("after").alias("after_n"),
                     F.col("after")["order_status"].alias("after_status"), "ts_ms")


def _route_proj(df):
    return df.select("seq", F.col("tableName").alias("table_name"), "type", "sink_type",
                     "sink_table", F.col("after")["id"].alias("after_id"),
                     F.cardinality("after").alias("after_n"),
                     F.array_join(F.array_sort(F.map_keys("after")), ",").alias("after_keys"))


# --------------------------------------------------------------------------
# the entries
# --------------------------------------------------------------------------
def q_src_raw_log(spark, d):
    return FX.raw_log_lines(spark, d)


def q_src_topic_table(spark, d):
    pt = logs.page_table(page_rows(spark, d))
    t = topics.topic_table(pt, "ts", delay=None)
    return t.select(F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"),
                    F.col("page")["last_page_id"].alias("last_page_id"), "ts",
                    SC.fmt("rt").alias("rt"))


def q_src_csv_lines(spark, d):
    return topics.parse_csv_lines(FX.csv_name_lines(spark, d), ["id", "name", "ts"])


def q_src_dim_table(spark, d):
    return FX.dim_sku_info(spark, d)


def q_log_parse_dirty(spark, d):
    return logs.dirty_lines(parsed_log(spark, d))


def q_log_split_start(spark, d):
    s = logs.split_start(repaired_log(spark, d))
    return s.select("seq", "common.mid", "common.uid", "common.ar", "common.ch", "common.vc",
                    "common.is_new", "start", "ts")


def q_log_split_page(spark, d):
    return logs.flatten_page(page_rows(spark, d)).select(*PAGE_FLAT)


def q_log_split_display(spark, d):
    return logs.split_display(page_rows(spark, d))


def q_is_new_repair(spark, d):
    raw = logs.clean_rows(parsed_log(spark, d)).select("seq", F.col("common.is_new")
                                                       .alias("is_new_raw"))
    fixed = repaired_log(spark, d).select("seq", "common.mid", "ts", "common.is_new")
    return fixed.join(raw, "seq").select("seq", "mid", "ts", "is_new_raw", "is_new")


def q_is_entry_page(spark, d):
    return page_rows(spark, d).select("seq", "common.mid", "page.page_id",
                                      logs.is_entry_page().alias("is_entry"))


def q_unique_visit(spark, d):
    return _visit_proj(visits.unique_visit(page_rows_fixture(spark, d)))


def q_jump_detail(spark, d):
    return _visit_proj(visits.jump_detail(page_rows_fixture(spark, d), JUMP_WITHIN_MS))


def q_jump_detail_looped(spark, d):
    return _visit_proj(visits.jump_detail(page_rows_fixture(spark, d), JUMP_WITHIN_MS, times=3))


def _visitor_inputs(spark, d):
    pr = page_rows_fixture(spark, d)
    return visits.unique_visit(pr), visits.jump_detail(pr, JUMP_WITHIN_MS), pr


def q_visitor_uv_metric(spark, d):
    return stats.visitor_uv_metric(visits.unique_visit(page_rows_fixture(spark, d)))


def q_visitor_uj_metric(spark, d):
    return stats.visitor_uj_metric(visits.jump_detail(page_rows_fixture(spark, d),
                                                      JUMP_WITHIN_MS))


def q_visitor_pv_metric(spark, d):
    return stats.visitor_pv_metric(page_rows_fixture(spark, d))


def q_union_visitor(spark, d):
    return stats.union_visitor(*_visitor_inputs(spark, d))


def q_visitor_stats(spark, d):
    return stats.visitor_stats(stats.visitor_metrics(visits.visit_flags(FX.page_log_rows(spark, d), JUMP_WITHIN_MS)))


def q_tumbling_10s(spark, d):
    return stats.tumbling_counts(FX.page_log_rows(spark, d))


def q_order_time_parts(spark, d):
    return SC.order_time_parts(FX.order_info(spark, d)).select(
        "id", "create_time", "create_date", "create_hour", "create_ts")


def q_order_interval_join(spark, d):
    j = wide.order_detail_join(FX.order_info(spark, d), FX.order_detail(spark, d),
                               -ORDER_BAND_MS, ORDER_BAND_MS)
    return comparable(j.select(F.col("id").alias("order_id"), F.col("d_sku_id").alias("sku_id"),
                               F.col("create_time").alias("order_time"),
                               F.col("d_create_time").alias("detail_time"),
                               F.col("d_split_total_amount").alias("split_total_amount")))


def q_order_wide_merge(spark, d):
    return comparable(merged_orders(spark, d).drop("detail_id", "_ort"))


def q_dim_user(spark, d):
    w = wide.enrich_user(merged_orders(spark, d), FX.dim_user_info(spark, d), as_of())
    return w.select("order_id", "sku_id", "user_id", "user_gender", "user_age")


def q_user_age(spark, d):
    u = FX.dim_user_info(spark, d)
    return u.select("ID", "BIRTHDAY", SC.user_age("BIRTHDAY", as_of()).alias("age"))


def q_dim_province(spark, d):
    w = wide.enrich_province(merged_orders(spark, d), FX.dim_base_province(spark, d))
    return w.select("order_id", "sku_id", "province_id", "province_name", "province_area_code",
                    "province_iso_code", "province_3166_2_code")


def _sku_chain(spark, d, upto: str):
    w = wide.enrich_sku(merged_orders(spark, d), FX.dim_sku_info(spark, d))
    if upto == "spu":
        w = wide.enrich_spu(w, FX.dim_spu_info(spark, d))
    elif upto == "tm":
        w = wide.enrich_tm(w, FX.dim_base_trademark(spark, d))
    elif upto == "category3":
        w = wide.enrich_category3(w, FX.dim_base_category3(spark, d))
    return w


def q_dim_sku(spark, d):
    return _sku_chain(spark, d, "sku").select("order_id", "sku_id", "sku_name", "spu_id",
                                              "tm_id", "category3_id")


def q_dim_spu(spark, d):
    return _sku_chain(spark, d, "spu").select("order_id", "sku_id", "spu_id", "spu_name")


def q_dim_tm(spark, d):
    return _sku_chain(spark, d, "tm").select("order_id", "sku_id", "tm_id", "tm_name")


def q_dim_category3(spark, d):
    return _sku_chain(spark, d, "category3").select("order_id", "sku_id", "category3_id",
                                                    "category3_name")


def q_order_wide(spark, d):
    return comparable(order_wide_rows(spark, d).drop("detail_id"))


def q_payment_interval_join(spark, d):
    j = wide.payment_wide_join(FX.payment_info(spark, d), merged_orders(spark, d),
                               PAYMENT_LOWER_MS, PAYMENT_UPPER_MS)
    return j.select(F.col("p_id").alias("payment_id"), "order_id", "sku_id",
                    F.col("p_create_time").alias("payment_time"),
                    F.col("create_time").alias("order_time"))


def q_payment_wide(spark, d):
    return comparable(payment_wide_rows(spark, d).drop("detail_id"))


def q_csv_interval_join(spark, d):
    a = topics.parse_csv_lines(FX.csv_name_lines(spark, d), ["id", "name", "ts"])
    b = topics.parse_csv_lines(FX.csv_sex_lines(spark, d), ["id", "sex", "ts"])
    a = a.select(F.col("id").cast("bigint").alias("id"), "name",
                 F.col("ts").cast("bigint").alias("ts"),
                 F.timestamp_seconds(F.col("ts").cast("bigint")).alias("rt"))
    b = b.select(F.col("id").cast("bigint").alias("id2"), "sex",
                 F.col("ts").cast("bigint").alias("ts2"),
                 F.timestamp_seconds(F.col("ts").cast("bigint")).alias("rt2"))
    j = joins.interval_join(a, b, "id", "id2", "rt", "rt2", -CSV_BAND_MS, CSV_BAND_MS,
                            bucketed=True)
    return j.select("id", "name", "ts", "sex", "ts2")


def q_cdc_normalize(spark, d):
    return _env_proj(envelopes(spark, d))


def q_cdc_drop_deletes(spark, d):
    return _env_proj(cdc.cdc_drop_deletes(envelopes(spark, d)))


def q_cdc_current_image(spark, d):
    cur = cdc.cdc_current_image(envelopes(spark, d))
    return cur.select(F.col("tableName").alias("table_name"), "pk", "last_type",
                      F.cardinality("image").alias("n_keys"),
                      F.col("image")["order_status"].alias("order_status"),
                      F.col("image")["name"].alias("name"), "ts_ms")


def q_retract_rows(spark, d):
    r = cdc.retract_rows(envelopes(spark, d))
    return r.select("seq", F.col("tableName").alias("table_name"), "type", "is_add",
                    F.col("row")["id"].alias("id"), F.cardinality("row").alias("n_keys"),
                    F.col("row")["order_status"].alias("order_status"))


def q_route_join(spark, d):
    routed = cdc.route_join(cdc.cdc_drop_deletes(envelopes(spark, d)), FX.routing_config(spark))
    return _route_proj(routed)


def q_route_columns(spark, d):
    routed = cdc.route_columns(cdc.route_join(cdc.cdc_drop_deletes(envelopes(spark, d)),
                                              FX.routing_config(spark)))
    return _route_proj(routed)


def q_route_sink_type(spark, d):
    facts, _ = cdc.route(envelopes(spark, d), FX.routing_config(spark))
    return _route_proj(facts)


def q_route_unmatched(spark, d):
    un = cdc.route_unmatched(cdc.cdc_drop_deletes(envelopes(spark, d)), FX.routing_config(spark))
    return _env_proj(un)


def q_sink_dim_upsert(spark, d):
    _, dim_rows = cdc.route(envelopes(spark, d), FX.routing_config(spark))
    users = dim_rows.filter(F.col("sink_table") == "dim_user_info")
    return cdc.dim_upsert(None, users, ["id", "name", "gender", "birthday"])


def q_dim_upsert_existing(spark, d):
    """Changes without the birthday merged into a stored table that has it."""
    _, dim_rows = cdc.route(envelopes(spark, d), FX.routing_config(spark))
    users = dim_rows.filter(F.col("sink_table") == "dim_user_info").withColumn(
        "after", F.map_filter("after", lambda k, v: k.isin("id", "name")))
    stored = FX.dim_user_info(spark, d).withColumn("NAME", F.lit("old"))
    return cdc.dim_upsert(stored, users, ["id", "name"])


def q_dim_table_schema(spark, d):
    """Columns of the configured dimension tables and how the routed changes fill them."""
    _, dim_rows = cdc.route(envelopes(spark, d), FX.routing_config(spark))
    return cdc.dim_table_columns(dim_rows, FX.routing_config(spark))


def q_src_change_log_snapshot(spark, d):
    """Order image from a snapshot of the first state and the changes after it."""
    env = envelopes(spark, d).filter(F.col("tableName") == "order_info")
    snapshot = env.filter(F.col("type") == "insert").select("database", "tableName", F.col("after").alias("image"))
    cur = cdc.cdc_current_image(cdc.snapshot_then_changes(snapshot, env.filter(F.col("type") != "insert")))
    return cur.select(F.col("tableName").alias("table_name"), "pk", "last_type",
                      F.cardinality("image").alias("n_keys"), F.col("image")["order_status"].alias("order_status"))


def q_sink_topic_per_row(spark, d):
    """Payloads of the facts, each with the topic it goes to."""
    facts, _ = cdc.route(envelopes(spark, d), FX.routing_config(spark))
    image = F.struct(*[F.col("after")[c].alias(c) for c in ("id", "user_id", "order_status")])
    return facts.select(F.col("sink_table").alias("topic"), F.col("after")["id"].alias("after_id"), F.to_json(image).alias("image"))


def q_order_wide_coalesce(spark, d):
    """Wide rows with every second amount missing, filled from the full rows where that is allowed."""
    full = merged_orders(spark, d).select("detail_id", "order_id", "sku_id", "create_time", "total_amount", "split_total_amount")
    even = F.col("sku_id") % 2 == 0
    part = full.withColumn("total_amount", F.when(even, F.col("total_amount"))).withColumn(
        "split_total_amount", F.when(even, F.col("split_total_amount")))
    return comparable(wide.order_wide_coalesce(part, full).drop("detail_id"))


def q_page_click_metric(spark, d):
    return comparable(stats.page_click_metric(logs.split_page(FX.page_log_rows(spark, d))))


def q_page_display_metric(spark, d):
    return comparable(stats.page_display_metric(logs.split_page(FX.page_log_rows(spark, d))))


def q_favor_metric(spark, d):
    return comparable(stats.favor_metric(FX.favor_info(spark, d)))


def q_cart_metric(spark, d):
    return comparable(stats.cart_metric(FX.cart_info(spark, d)))


def q_order_metric(spark, d):
    return comparable(stats.order_metric(Inputs(spark, d).order_lines()))


def q_payment_metric(spark, d):
    return comparable(stats.payment_metric(Inputs(spark, d).paid_lines()))


def q_refund_metric(spark, d):
    return comparable(stats.refund_metric(FX.order_refund_info(spark, d)))


def q_comment_metric(spark, d):
    return comparable(stats.comment_metric(FX.comment_info(spark, d)))


def q_union_product(spark, d):
    return comparable(stats.union_product(*product_metric_frames(spark, d)))


def q_product_stats(spark, d):
    return comparable(product_stats_rows(spark, d))


def q_province_from_order(spark, d):
    return comparable(stats.province_from_order(order_wide_rows(spark, d)))


def q_province_stats(spark, d):
    # only the province lookup feeds this report (left joins on unique keys)
    rows = wide.enrich_province(merged_orders(spark, d), FX.dim_base_province(spark, d))
    return comparable(stats.province_stats(rows, stamp="window_end"))


def q_search_term_filter(spark, d):
    t = stats.search_term_filter(FX.search_page_rows(spark, d))
    return t.select(F.sha2("full_word", 256).alias("term_sha256"),
                    F.length("full_word").alias("term_len"), SC.fmt("rt").alias("rt"))


def q_split_words_lateral(spark, d):
    w = stats.split_words_lateral(stats.search_term_filter(FX.search_page_rows(spark, d)))
    return w.select("word", SC.fmt("rt").alias("rt"))


def q_split_words(spark, d):
    docs = FX.read_table(spark, d, "documents")
    return docs.select("doc_id", F.explode(split_words("text")).alias("word")) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id")
                             .alias("docs"))


def q_word_segments(spark, d):
    docs = FX.read_table(spark, d, "documents")
    return docs.select(F.explode(word_segments("text")).alias("word")) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def q_dictionary_segments(spark, d):
    """Words of a dictionary (of the benchmark's texts) at every place of the search terms."""
    words = FX.read_table(spark, d, "benchmark").select(F.explode(split_words("text")).alias("word")).where("length(word) >= 5").distinct()
    terms = FX.read_table(spark, d, "documents").select("doc_id", "text")
    found = dictionary_segments(terms, words, "text").groupBy("word")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


def q_order_sketches(spark, d):
    """Distinct orders of each day: sketches of windows and skus rolled up, beside the exact count."""
    metrics = stats.order_metric(Inputs(spark, d).order_lines())
    day = F.substring("stt", 1, 10).alias("dt")
    rolled = stats.roll_up_orders(stats.order_sketches(metrics), day).select("dt", "order_ct")
    exact = (metrics.groupBy(F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd").alias("dt"))
             .agg(F.count_distinct("order_oid").alias("exact_ct")))
    near = F.abs(F.col("order_ct") - F.col("exact_ct")) <= F.col("exact_ct") * (4 * 1.04 / 2 ** (stats.SKETCH_K / 2))
    return exact.join(rolled, "dt", "left").select("dt", "exact_ct", near.alias("within_bound"))


def q_keyword_stats(spark, d):
    return stats.keyword_stats(FX.search_page_rows(spark, d), stamp="window_end")


def _brand_amounts(spark, d):
    """What the GMV reports read of the product statistics: no lookups but sku -> trademark."""
    core = stats.product_stats_core(stats.union_product(*product_metric_frames(spark, d)))
    return joins.enrich(core, FX.dim_sku_brand(spark, d), "sku_id", {"tm_name": "TM_NAME"}, key_type="bigint")


def q_gmv_total(spark, d):
    core = stats.product_stats_core(stats.union_product(*product_metric_frames(spark, d)))
    return comparable(report.gmv_daily(core))


def q_gmv_by_brand(spark, d):
    return comparable(report.gmv_by_brand_daily(_brand_amounts(spark, d)))


def q_gmv_by_brand_series(spark, d):
    s = report.gmv_by_brand_series(report.gmv_by_brand_daily(_brand_amounts(spark, d)))
    return s.select("dt", F.array_join("categories", "|").alias("categories"),
                    F.array_join(F.transform("data", lambda x: F.format_string("%.2f", x.cast("double"))), "|")
                    .alias("data"))


def q_code_labels(spark, d):
    c = FX.comment_info(spark, d)
    return c.select("id", "appraise", SC.code_label("appraise").alias("appraise_name"))


def q_snake_to_camel(spark, d):
    return SC.snake_to_camel(FX.dim_sku_info(spark, d))


def q_keyword_stats_sql(spark, d):
    return sql_jobs.keyword_stats_sql(spark, FX.search_page_rows(spark, d), stamp="window_end")


def q_province_stats_sql(spark, d):
    rows = wide.enrich_province(merged_orders(spark, d), FX.dim_base_province(spark, d))
    return comparable(sql_jobs.province_stats_sql(spark, rows, stamp="window_end"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
