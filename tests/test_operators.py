"""Per-operator edge cases on tiny hand-made rows."""

import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberflow import schemas as S
from emberflow.functions import scalars as SC
from emberflow.functions.words import dictionary_segments, split_words, word_segments
from emberflow.operators import cdc, joins, logs, report, stats, visits, wide
from emberflow.plans import sql_jobs
from emberflow.plans.catalog import QUERIES

SF_SMALL = "/root/testdata/sf0.001"


def _page(mid, ts, seq, last=None, page_id="home", is_new="0", during=1000, displays=None,
          start=None):
    o = {"common": {"mid": mid, "is_new": is_new, "vc": "v1", "ch": "app", "ar": "1"},
         "ts": ts}
    if start is None:
        o["page"] = {"page_id": page_id, "during_time": during}
        if last is not None:
            o["page"]["last_page_id"] = last
    else:
        o["start"] = start
    if displays is not None:
        o["displays"] = displays
    return (seq, json.dumps(o))


def _raw(spark, rows):
    return spark.createDataFrame(rows, "seq long, value string")


# ---------------------------------------------------------------- logs
def test_parse_dirty_only_for_unparsable_or_non_object(spark):
    rows = [_page("a", 1, 1), (2, '{"common": {"mid": "a"'), (3, "[1]"), (4, "not json"),
            (5, '{"ts": "abc"}'), (6, None)]
    p = logs.parse_log(_raw(spark, rows))
    dirty = sorted(r.seq for r in logs.dirty_lines(p).collect())
    assert dirty == [2, 3, 4, 6]          # a typed mismatch (5) is not dirty
    assert sorted(r.seq for r in logs.clean_rows(p).collect()) == [1, 5]


def test_split_start_page_display_null_safe(spark):
    rows = [_page("a", 1, 1, start={"entry": "icon"}),
            _page("a", 2, 2, displays=[{"item": "7", "item_type": "sku_id", "order": 1},
                                       {"item": "x", "item_type": "activity_id", "order": 2}]),
            _page("a", 3, 3, start=""),  # empty start -> page log
            _page("a", 4, 4, displays=[])]
    clean = logs.clean_rows(logs.parse_log(_raw(spark, rows)))
    assert [r.seq for r in logs.split_start(clean).collect()] == [1]
    assert sorted(r.seq for r in logs.split_page(clean).collect()) == [2, 3, 4]
    d = logs.split_display(logs.split_page(clean)).collect()
    assert sorted((r.item, r.page_id) for r in d) == [("7", "home"), ("x", "home")]


def test_repair_is_new_first_flag_only(spark):
    rows = [_page("a", 5, 1, is_new="1"), _page("a", 3, 2, is_new="0"),
            _page("a", 7, 3, is_new="1"), _page("b", 1, 4, is_new="1"),
            _page("a", 5, 0, is_new="1")]   # same ts, lower seq -> first
    clean = logs.clean_rows(logs.parse_log(_raw(spark, rows)))
    got = {r.seq: r["common"]["is_new"] for r in logs.repair_is_new(clean).collect()}
    assert got == {0: "1", 1: "0", 2: "0", 3: "0", 4: "1"}


def test_entry_page_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("home",)], "l string")
    assert [r.e for r in df.select(logs.is_entry_page("l").alias("e")).collect()] == \
        [True, True, False]


# ---------------------------------------------------------------- visits
def _pages_df(spark, rows):
    return logs.split_page(logs.clean_rows(logs.parse_log(_raw(spark, rows))))


def test_unique_visit_first_entry_per_day(spark):
    day = 86_400_000
    rows = [_page("a", 10, 1), _page("a", 20, 2), _page("a", 30, 3, last="home"),
            _page("a", day + 5, 4, last=""), _page("b", 40, 5, last="x")]
    got = sorted(r.seq for r in visits.unique_visit(_pages_df(spark, rows)).collect())
    assert got == [1, 4]


def _brute_jump(rows, within, times):
    """Reference: walk each visitor's events in (ts, seq) order."""
    out = []
    by = {}
    for seq, mid, ts, entry in rows:
        by.setdefault(mid, []).append((ts, seq, entry))
    for ev in by.values():
        ev.sort()
        for i, (ts, seq, entry) in enumerate(ev):
            if not entry:
                continue
            keep = True
            for j in range(i + 1, i + times):
                if j >= len(ev) or ev[j][0] - ts >= within:
                    break
                if not ev[j][2]:
                    keep = False
                    break
            if keep:
                out.append(seq)
    return sorted(out)


def test_jump_detail_edges(spark):
    rows = [_page("a", 0, 1), _page("a", 10_000, 2),          # next at exactly 10 s: timeout
            _page("a", 30_000, 3), _page("a", 35_000, 4, last="home"),   # non-entry next: drop
            _page("a", 60_000, 5), _page("a", 61_000, 6),      # entry next: match
            _page("b", 0, 7, last="home")]
    got = sorted(r.seq for r in visits.jump_detail(_pages_df(spark, rows), 10_000).collect())
    assert got == [1, 2, 5, 6]


@pytest.mark.parametrize("bucket_ms", [20_000, 50_000, 1_000_000])
@pytest.mark.parametrize("times", [2, 3])
def test_jump_detail_bucket_boundaries_match_brute_force(spark, bucket_ms, times):
    import random
    rnd = random.Random(7)
    rows, spec = [], []
    seq = 0
    for mid in ("a", "b", "c"):
        t = 0
        for _ in range(60):
            t += rnd.choice([1_000, 4_000, 9_999, 10_000, 15_000, 33_000])
            entry = rnd.random() < 0.6
            seq += 1
            rows.append(_page(mid, t, seq, last=None if entry else "home"))
            spec.append((seq, mid, t, entry))
    got = sorted(r.seq for r in visits.jump_detail(_pages_df(spark, rows), 10_000, times,
                                                     bucket_ms=bucket_ms).collect())
    assert got == _brute_jump(spec, 10_000, times)


# ---------------------------------------------------------------- joins
@pytest.mark.parametrize("lo_inc,hi_inc,expect", [(True, True, [-5, 0, 5]),
                                                  (False, True, [0, 5]),
                                                  (True, False, [-5, 0]),
                                                  (False, False, [0])])
def test_interval_join_bounds(spark, lo_inc, hi_inc, expect):
    left = spark.createDataFrame([(1, 100)], "id long, t long").withColumn(
        "rt", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(1, 100 + d, d) for d in (-6, -5, 0, 5, 6)] + [(2, 100, 99)],
                                  "id2 long, t2 long, d long").withColumn(
        "rt2", F.timestamp_seconds("t2"))
    j = joins.interval_join(left, right, "id", "id2", "rt", "rt2", -5000, 5000, lo_inc, hi_inc)
    assert sorted(r.d for r in j.collect()) == expect


def test_enrich_left_join_keeps_missing(spark):
    facts = spark.createDataFrame([(1,), (2,)], "k long")
    dim = spark.createDataFrame([("1", "one")], "ID string, NAME string")
    got = sorted((r.k, r.name) for r in joins.enrich(facts, dim, "k", {"name": "NAME"},
                                                      key_type="bigint").collect())
    assert got == [(1, "one"), (2, None)]


# ---------------------------------------------------------------- cdc
def _change(topic, op, before, after, ts):
    v = {"op": op, "ts_ms": ts, "source": {"db": "shop"}}
    if before is not None:
        v["before"] = before
    if after is not None:
        v["after"] = after
    return (ts, topic, json.dumps(v))


def _env(spark, rows):
    return cdc.cdc_normalize(spark.createDataFrame(rows, "seq long, topic string, value string"))


def test_cdc_normalize_and_drop_deletes(spark):
    t = "srv.shop.base_trademark"
    e = _env(spark, [_change(t, "c", None, {"id": "11", "tm_name": "x"}, 1),
                     _change(t, "u", {"id": "11"}, {"id": "11", "tm_name": "y"}, 2),
                     _change(t, "d", {"id": "11"}, None, 3),
                     _change(t, "r", None, {"id": "12"}, 4)])
    got = [(r.database, r.tableName, r.type, len(r.before), len(r.after))
           for r in e.orderBy("seq").collect()]
    assert got == [("shop", "base_trademark", "insert", 0, 2),
                   ("shop", "base_trademark", "update", 1, 2),
                   ("shop", "base_trademark", "delete", 1, 0),
                   ("shop", "base_trademark", "read", 0, 1)]
    assert [r.type for r in cdc.cdc_drop_deletes(e).orderBy("seq").collect()] == \
        ["insert", "update", "read"]


def test_current_image_and_retract(spark):
    t = "srv.shop.t"
    e = _env(spark, [_change(t, "c", None, {"id": "1", "v": "a"}, 1),
                     _change(t, "u", {"id": "1", "v": "a"}, {"id": "1", "v": "b"}, 2),
                     _change(t, "c", None, {"id": "2", "v": "c"}, 3),
                     _change(t, "d", {"id": "2", "v": "c"}, None, 4)])
    cur = {r.pk: r.image["v"] for r in cdc.cdc_current_image(e).collect()}
    assert cur == {"1": "b"}
    r = [(x.seq, x.is_add, x.row["v"]) for x in cdc.retract_rows(e).orderBy("seq", "is_add")
         .collect()]
    assert r == [(1, True, "a"), (2, False, "a"), (2, True, "b"), (3, True, "c"),
                 (4, False, "c")]


def test_route_prune_unmatched_and_branches(spark):
    e = _env(spark, [_change("s.db.user_info", "c", None, {"id": "1", "name": "n", "x": "z"}, 1),
                     _change("s.db.order_info", "c", None, {"id": "9", "status": "O"}, 2),
                     _change("s.db.other", "c", None, {"id": "5"}, 3)])
    cfg = spark.createDataFrame([
        ("user_info", "insert", "hbase", "dim_user", "id, name", None, None, 1),
        ("user_info", "insert", "hbase", "dim_user", "id,name", None, None, 2),
        ("order_info", "insert", "kafka", "dwd_order", "id,status", None, None, 1)],
        S.TABLE_PROCESS)
    facts, dims = cdc.route(e, cfg)
    assert [(r.sink_table, sorted(r.after)) for r in facts.collect()] == \
        [("dwd_order", ["id", "status"])]
    assert [(r.sink_table, sorted(r.after)) for r in dims.collect()] == \
        [("dim_user", ["id", "name"])]   # newest config row wins, exact key match
    assert [r.tableName for r in cdc.route_unmatched(e, cfg).collect()] == ["other"]


def test_dim_upsert_keeps_absent_columns(spark):
    cur = spark.createDataFrame([("1", "old", "M"), ("2", "two", "F")],
                                "ID string, NAME string, GENDER string")
    ch = spark.createDataFrame([
        (10, {"id": "1", "name": "new"}), (11, {"id": "3", "name": "c", "gender": "F"}),
        (12, {"id": "1", "name": "newer"}), (5, {"id": "1", "gender": "X"})],
        "seq long, after map<string,string>")
    got = {r.ID: (r.NAME, r.GENDER) for r in
           cdc.dim_upsert(cur, ch, ["id", "name", "gender"], order=("seq",)).collect()}
    assert got == {"1": ("newer", "X"), "2": ("two", "F"), "3": ("c", "F")}


def test_dim_table_schema():
    s = cdc.dim_table_schema("id,tm_name")
    assert [f.name for f in s.fields] == ["ID", "TM_NAME"]
    assert all(isinstance(f.dataType, T.StringType) for f in s.fields)


# ---------------------------------------------------------------- scalars / words
def test_order_time_parts_and_age(spark):
    df = spark.createDataFrame([("2021-03-05 07:08:09", "2000-03-06")], "create_time string, b string")
    r = SC.order_time_parts(df).select(
        "create_date", "create_hour", "create_ts",
        SC.user_age("b", F.to_date(F.lit("2021-03-05"))).alias("age")).first()
    assert (r.create_date, r.create_hour, r.age) == ("2021-03-05", "07", 21)


def test_code_labels_and_camel(spark):
    df = spark.createDataFrame([("1201",), ("9999",)], "c string")
    assert [r.l for r in df.select(SC.code_label("c").alias("l")).collect()] == ["good", None]
    assert SC.snake_to_camel_name("ORDER_ID") == "orderId"
    assert SC.snake_to_camel_name("category3_id") == "category3Id"


def test_split_words_and_segments(spark):
    df = spark.createDataFrame([("Zephyr box12, 木星灯塔!",)], "t string")
    r = df.select(split_words("t").alias("w"), word_segments("t").alias("s")).first()
    assert r.w == ["zephyr", "box12", "木星灯塔"]
    assert r.s == ["zephyr", "box12", "木星", "星灯", "灯塔"]


def test_split_words_udtf(spark):
    from emberflow.functions.words import register_split_words_udtf
    register_split_words_udtf(spark)
    spark.createDataFrame([("Hello World",)], "t string").createOrReplaceTempView("tw")
    got = [r.word for r in spark.sql(
        "SELECT word FROM tw, LATERAL split_words(t)").collect()]
    assert got == ["hello", "world"]


# ---------------------------------------------------------------- stats / reports
def test_product_stats_distinct_orders_exact(spark):
    rows = [(1, 1000, 5), (1, 2000, 5), (1, 3000, 6), (1, 15000, 5), (2, 1000, 5)]
    df = spark.createDataFrame(rows, "sku long, t long, oid long")
    m = stats._product_row(df, F.col("sku"), F.col("t"), order_oid=F.col("oid"),
                           order_sku_num=F.lit(1))
    got = {(r.stt, r.sku_id): (r.order_ct, r.order_sku_num)
           for r in stats.product_stats_core(m).collect()}
    assert got == {("1970-01-01 00:00:00", 1): (2, 3), ("1970-01-01 00:00:10", 1): (1, 1),
                   ("1970-01-01 00:00:00", 2): (1, 1)}


def _static_plan(spark, make):
    """The plan as it is made, without changes at run time."""
    fixed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in fixed}
    try:
        for k, v in fixed.items():
            spark.conf.set(k, v)
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_product_stats_shuffles_its_rows_once(spark):
    rows = [(1, 1000, 5), (1, None, 5), (None, -1, 6), (None, 1000, None)]
    df = spark.createDataFrame(rows, "sku long, t long, oid long")
    m = stats._product_row(df, F.col("sku"), F.col("t"), order_oid=F.col("oid"))
    assert _static_plan(spark, lambda: stats.product_stats_core(m)).count("Exchange hashpartitioning") == 1
    got = {(r.stt, r.edt, r.sku_id, r.order_ct) for r in stats.product_stats_core(m).collect()}
    assert got == {("1970-01-01 00:00:00", "1970-01-01 00:00:10", 1, 1), ("1969-12-31 23:59:50", "1970-01-01 00:00:00", None, 1),
                   ("1970-01-01 00:00:00", "1970-01-01 00:00:10", None, 0)}


def test_payments_meet_order_lines_without_a_further_shuffle(spark):
    for name in ("product_stats", "gmv_total"):
        plan = _static_plan(spark, lambda: QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(r"SortMergeJoin \[p_order_id#\d+L?\], \[order_id#", plan)) == 1, name
        assert not re.search(r"Exchange hashpartitioning\(order_id#", plan), name


def test_keyword_windows_are_keyed_by_their_start(spark):
    rows = [("search", "b a a", -1), ("search", "a", 0), ("search", "A", 9999), ("search", "a", None), ("search", None, 0), ("home", "a", 0)]
    pages = spark.createDataFrame(rows, "l string, i string, ts long").select(
        F.create_map(F.lit("last_page_id"), "l", F.lit("item"), "i").alias("page"), "ts")
    for make in (lambda: stats.keyword_stats(pages, stamp="window_end"), lambda: sql_jobs.keyword_stats_sql(spark, pages, stamp="window_end")):
        key, = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _static_plan(spark, make))
        assert "window" not in key and len(key.split(", ")) == 3
        assert {(r.keyword, r.ct, r.stt, r.edt, r.ts) for r in make().collect()} == {
            ("a", 2, "1969-12-31 23:59:50", "1970-01-01 00:00:00", 0), ("b", 1, "1969-12-31 23:59:50", "1970-01-01 00:00:00", 0),
            ("a", 2, "1970-01-01 00:00:00", "1970-01-01 00:00:10", 10000)}
        assert "struct" not in " ".join(t for _, t in make().dtypes) and make().columns == ["keyword", "ct", "source", "stt", "edt", "ts"]


def test_gmv_reports(spark):
    ps = spark.createDataFrame(
        [("2024-01-01 10:00:00", "A", 5.0), ("2024-01-01 11:00:00", "B", 7.0),
         ("2024-01-01 12:00:00", "A", 4.0), ("2024-01-02 00:00:00", "C", 100.0),
         ("2024-01-01 13:00:00", "C", 9.0)], "stt string, tm_name string, order_amount double"
    ).withColumn("order_amount", F.col("order_amount").cast(S.MONEY))
    assert float(report.gmv_total(ps, 20240101).first()[0]) == 25.0
    top = [(r.tm_name, float(r.order_amount)) for r in report.gmv_by_brand(ps, 20240101, 2)
           .collect()]
    assert top == [("A", 9.0), ("C", 9.0)]   # tie broken by name
    ser = report.gmv_by_brand_series(report.gmv_by_brand_daily(ps, 2)).orderBy("dt").collect()
    assert ser[0].categories == ["A", "C"] and [float(x) for x in ser[0].data] == [9.0, 9.0]


def test_order_wide_coalesce(spark):
    a = spark.createDataFrame([(1, None, 5.0)], "detail_id long, sku_name string, "
                              "split_total_amount double")
    b = spark.createDataFrame([(1, "x", 9.0)], "detail_id long, sku_name string, "
                              "split_total_amount double")
    r = wide.order_wide_coalesce(a, b).first()
    assert (r.sku_name, r.split_total_amount) == ("x", 5.0)


def test_order_wide_coalesce_repeated_keys(spark):
    shape = "detail_id long, order_id long, total_amount double, split_total_amount double, place int"
    a = spark.createDataFrame([(1, None, None, None, 1), (1, 7, 9.0, 2.0, 2), (2, 5, None, None, 3), (None, None, None, None, 4)], shape)
    b = spark.createDataFrame([(1, 8, None, 5.0, 2), (1, 6, 4.0, 6.0, 9), (1, None, 3.0, 7.0, 1), (None, 3, 3.0, 3.0, 1)], shape)
    rows = lambda df: sorted((r.place, r.detail_id, r.order_id, r.total_amount, r.split_total_amount) for r in df.collect())
    assert rows(wide.order_wide_coalesce(a, b)) == [(1, 1, 6, 3.0, None), (2, 1, 7, 9.0, 2.0), (3, 2, 5, None, None), (4, None, None, None, None)]
    assert rows(wide.order_wide_coalesce(a, b, order="place")) == [(1, 1, 8, 3.0, None), (2, 1, 7, 9.0, 2.0), (3, 2, 5, None, None), (4, None, None, None, None)]


def test_change_records_are_parsed_once(spark):
    for name in ("route_columns", "sink_dim_upsert", "route_unmatched", "dim_table_schema"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, name


def test_dim_table_columns_of_uncarried_columns(spark):
    config = spark.createDataFrame([("t", "insert", "hbase", "dim_t", "id,a,b", None, "x", 1), ("u", "insert", "kafka", "dwd_u", "id", None, None, 1)], S.TABLE_PROCESS)
    dims = spark.createDataFrame([("dim_t", {"id": "1", "a": None}), ("dim_t", {"id": "2"})], "sink_table string, after map<string,string>")
    got = sorted(tuple(r) for r in cdc.dim_table_columns(dims, config).collect())
    assert got == [("dim_t", 1, "ID", "string", True, "x", 2, 2), ("dim_t", 2, "A", "string", False, "x", 1, 0), ("dim_t", 3, "B", "string", False, "x", 0, 0)]
    assert cdc.dim_table_columns(dims.limit(0), config).count() == 3


@pytest.mark.parametrize("most", [500_000, 3])
def test_dictionary_segments_equal_substring_search(spark, most):
    words = ["ab", "abc", "bc", "c", "灯塔", "塔", "AB", "xyz", "aa", None, ""]
    texts = [(1, "abcabc"), (2, "ABC xyzz"), (3, "木星灯塔灯塔"), (4, None), (5, ""), (6, "aaaa"), (6, "aaaa")]
    got = dictionary_segments(spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame([(w,) for w in words], "word string"), "t", most_words=most)
    known = {w.lower() for w in words if w}
    want = [(i, t, t.lower()[a:b]) for i, t in texts if t for a in range(len(t)) for b in range(a + 1, len(t) + 1) if t.lower()[a:b] in known]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_order_sketches_merge_like_the_direct_count(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("sku"), (F.col("id") % 86_400_000 * 10).alias("t"), (F.col("id") * 3 % 41_000).alias("oid"))
    metrics = stats._product_row(rows, F.col("sku"), F.col("t"), order_oid=F.col("oid"), paid_oid=F.when(F.col("oid") % 2 == 0, F.col("oid")))
    rolled = stats.roll_up_orders(stats.order_sketches(metrics), F.substring("stt", 1, 10).alias("dt")).first()
    direct = metrics.agg(F.hll_sketch_estimate(F.hll_sketch_agg("order_oid", stats.SKETCH_K)).alias("n"), F.count_distinct("order_oid").alias("exact"),
                         F.count_distinct("paid_oid").alias("paid")).first()
    bound = 4 * 1.04 / 2 ** (stats.SKETCH_K / 2)
    assert rolled.order_ct == direct.n or abs(rolled.order_ct - direct.n) <= bound * direct.exact
    assert abs(rolled.order_ct - direct.exact) <= bound * direct.exact and abs(rolled.paid_order_ct - direct.paid) <= bound * direct.paid
    assert rolled.refund_order_ct == 0 and len(rolled.order_sketch) < 2 ** (stats.SKETCH_K + 1)
