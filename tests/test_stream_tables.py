"""Streams that keep tables: images of changed rows, versions of routes, topic-to-topic visit jobs; and passes shared by reports."""

from __future__ import annotations

import itertools
import os
import random

from pyspark.sql import functions as F

from emberflow import schemas as S
from emberflow.operators import cdc, logs, stats, visits
from emberflow.plans import catalog
from emberflow.sources import fixtures as FX
from emberflow.streaming import dim_store, images, jobs, sinks, warehouse
from emberflow.streaming.processors import STREAM_PAGE

SF_SMALL = "/root/testdata/sf0.001"
ENVELOPE = "database string, tableName string, before map<string,string>, after map<string,string>, type string, ts_ms long, partition int, seq long"


def shown(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_image_stream_equals_batch(spark, tmpdir_path):
    """Changes split over files, out of order, with rows deleted and inserted again."""
    rng = random.Random(5)
    rows, state = [], {}
    for i in range(300):
        k = str(rng.randrange(25))
        image = {"id": k, "v": str(i), **({"w": "x"} if i % 3 else {})}
        if k in state and rng.random() < 0.4:
            rows.append(("shop", "t", state.pop(k), {}, "delete", i // 4, 0, i))
        else:
            rows.append(("shop", "t" if i % 5 else "u", state.get(k, {}), image, "update" if k in state else "insert", i // 4, 0, i))
            state[k] = image
    shuffled = rows[:]
    rng.shuffle(shuffled)
    src, root, ck = (os.path.join(tmpdir_path, x) for x in ("src", "images", "ck"))
    for i in range(0, 300, 60):
        spark.createDataFrame(shuffled[i:i + 60], ENVELOPE).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(src)
    sinks.current_image_stream(stream, root, ck, {"availableNow": True}).awaitTermination(300)
    want = cdc.cdc_current_image(spark.createDataFrame(rows, ENVELOPE))
    columns = ["database", "tableName", "pk", F.to_json("image"), "last_type", "ts_ms", "seq"]
    assert shown(images.read_images(spark, root), *columns) == shown(want, *columns) != []
    pairs = cdc.retract_rows(stream).writeStream.format("memory").queryName("pairs").trigger(availableNow=True).option("checkpointLocation", ck + "2").start()
    pairs.awaitTermination(300)
    columns = ["seq", "is_add", F.to_json("row")]
    assert shown(spark.table("pairs"), *columns) == shown(cdc.retract_rows(spark.createDataFrame(rows, ENVELOPE)), *columns)


def _change(table, after, at, kind="insert", before=None):
    return ("shop", table, before or {}, after, kind, at, 0, at)


def _route(sink, columns, version, kind="hbase"):
    return {"source_table": "user_info", "operate_type": "insert", "sink_type": kind, "sink_table": sink, "sink_columns": columns, "version": str(version)}


def test_replay_routes_as_the_first_run_did(spark, tmpdir_path):
    """A route that changes between two batches; then the log is processed again with both routes known."""
    src, conf, log = (os.path.join(tmpdir_path, x) for x in ("src", "conf", "log"))
    put = lambda folder, *rows: spark.createDataFrame(list(rows), ENVELOPE).coalesce(1).write.mode("append").parquet(folder)
    read = lambda folder: spark.readStream.schema(ENVELOPE).parquet(folder)

    def run(name):
        out = os.path.join(tmpdir_path, name)
        sinks.config_log_stream(read(conf), log, os.path.join(tmpdir_path, "ck-conf"), trigger={"availableNow": True}).awaitTermination(300)
        sinks.route_stream(read(src), log, out, os.path.join(tmpdir_path, f"ck-{name}"), {"availableNow": True}).awaitTermination(300)
        tables = {t: shown(dim_store.read_dim(spark, f"{out}/dims/{t}"), "*") for t in ("dim_a", "dim_b") if os.path.exists(f"{out}/dims/{t}")}
        return tables, shown(spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true").json(f"{out}/unrouted"), "tableName", "seq")

    put(conf, _change("table_process", _route("dim_a", "id,name", 1), 100))
    put(src, _change("user_info", {"id": "1", "name": "a", "city": "x"}, 150), _change("user_info", {"id": "0", "name": "early"}, 50))
    run("first")
    put(conf, _change("table_process", _route("dim_b", "id,city", 2), 200, "update"), _change("table_process", {}, 400, "delete", _route("dim_b", "id,city", 2)))
    put(src, _change("user_info", {"id": "2", "name": "b", "city": "y"}, 250), _change("user_info", {"id": "3", "name": "late", "city": "z"}, 450),
        _change("user_info", {"id": "4", "name": "d", "city": "u"}, 160))
    first, again = run("first"), run("backfill")
    assert first == again
    assert first[0] == {"dim_a": ["Row(ID='1', NAME='a')", "Row(ID='4', NAME='d')"], "dim_b": ["Row(ID='2', CITY='y')"]}
    assert first[1] == ["Row(tableName='user_info', seq=450)", "Row(tableName='user_info', seq=50)"]


def test_unique_visits_from_topic_to_topic(spark, tmpdir_path):
    """The query ends by itself, gives the batch rows, and holds no state once the watermark has passed a day."""
    pages = logs.split_page(FX.page_log_rows(spark, SF_SMALL))
    flat = jobs.flat_page_rows(pages)
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("pages", "visits", "ck"))
    flat.orderBy("ts", "seq").coalesce(1).write.json(src)
    go = lambda: warehouse.start_unique_visit(spark, src, STREAM_PAGE, out, ck, {"availableNow": True}).awaitTermination(300)
    go()
    found = spark.read.schema(STREAM_PAGE).json(out)
    assert shown(found, "seq") == shown(visits.unique_visit(pages), "seq")
    last = flat.agg(F.max("ts")).first()[0]
    for i in (2, 4):  # two rows that are no entry pages, days later: the watermark passes the first
        spark.createDataFrame([("closer", -i, last + i * 86_400_000, "0", "v", "c", "a", "home", "home", None, None, 0)], STREAM_PAGE).coalesce(1).write.mode("append").json(src)
        go()
    held = spark.read.format("statestore").option("path", os.path.join(ck, "unique_visit")).option("stateVarName", "last_date").load()
    assert held.count() == 0 and found.count() == spark.read.schema(STREAM_PAGE).json(out).count()


def test_visitor_jobs_chained_from_topic_to_topic(spark, tmpdir_path):
    """Page topic -> visits and bounces topics -> visitor report, each job by its starter; the report is that of the batch operators."""
    within = 3_600_000
    pages = logs.split_page(FX.page_log_rows(spark, SF_SMALL))
    page_topic, visit_topic, jump_topic, report, ck = (os.path.join(tmpdir_path, x) for x in ("pages", "visits", "jumps", "report", "ck"))
    jobs.flat_page_rows(pages).orderBy("ts", "seq").coalesce(1).write.json(page_topic)
    last = pages.agg(F.max("ts")).first()[0]
    # a day later an entry page, which becomes a visit and a bounce; two days later a page that lets the bounce time out
    for days, before in ((1, None), (2, "home")):
        row = ("closer", -days, last + days * 86_400_000, "0", "closer", "c", "a", "home", before, None, None, 0)
        spark.createDataFrame([row], STREAM_PAGE).coalesce(1).write.mode("append").json(page_topic)
    now = {"availableNow": True}
    warehouse.start_unique_visit(spark, page_topic, STREAM_PAGE, visit_topic, ck, now).awaitTermination(300)
    warehouse.start_jump_detail(spark, page_topic, STREAM_PAGE, jump_topic, ck, within, trigger=now).awaitTermination(300)
    found, jumped = visits.unique_visit(pages), visits.jump_detail(pages, within)
    for topic, want in ((visit_topic, found), (jump_topic, jumped)):
        got = spark.read.schema(STREAM_PAGE).json(topic)
        assert shown(got.where("mid != 'closer'"), "seq") == shown(want, "seq") != []
        assert shown(got.where("mid = 'closer'"), "seq") == ["Row(seq=-1)"]
    warehouse.start_visitor_stats(spark, visit_topic, jump_topic, page_topic, STREAM_PAGE, report, ck, now).awaitTermination(300)
    want = stats.visitor_stats(stats.union_visitor(found, jumped, pages))
    assert shown(spark.read.parquet(report).where("vc != 'closer'"), *S.VISITOR_STATS_COLUMNS) == shown(want, *S.VISITOR_STATS_COLUMNS) != []


def test_visit_flags_equal_the_three_operators(spark):
    rows = FX.page_log_rows(spark, SF_SMALL)
    odd = rows.limit(40).withColumn("common", F.col("common").withField("mid", F.lit(None).cast("string"))).withColumn("seq", F.col("seq") + 10**9)
    every = rows.unionByName(odd)
    pages = logs.split_page(logs.repair_is_new(every))
    for within, times in itertools.product((3_600_000, 60_000), (2, 3)):
        flags = visits.visit_flags(every, within, times)
        assert shown(flags, "seq", "common.is_new") == shown(pages, "seq", "common.is_new")
        assert shown(flags.where("uv"), "seq") == shown(visits.unique_visit(pages), "seq")
        assert shown(flags.where("uj"), "seq") == shown(visits.jump_detail(pages, within, times), "seq")


def test_page_metrics_equal_the_two_operators(spark):
    pages = logs.split_page(FX.page_log_rows(spark, SF_SMALL))
    both = stats.page_click_metric(pages).unionByName(stats.page_display_metric(pages))
    assert shown(stats.page_metrics(pages), *both.columns) == shown(both, *both.columns) != []


def test_reports_read_few_times(spark):
    plan = lambda n: catalog.QUERIES[n](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    stats_plan = plan("visitor_stats")
    assert stats_plan.count("Relation [") <= 2 and stats_plan.count("Join ") == 1
    assert plan("jump_detail").count("Union") == 0


def test_order_lines_are_read_once_by_product_reports(spark):
    """Where orders and lines are joined by shuffle, the payments read the shuffled lines of the order metric."""
    fixed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in fixed}
    try:
        for k, v in fixed.items():
            spark.conf.set(k, v)
        for name in ("product_stats", "gmv_by_brand", "gmv_total"):
            plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("lineitem.parquet") == 1, name
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_log_stage_is_one_query_that_parses_each_line_once(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "out")
    FX.raw_log_lines(spark, SF_SMALL).where("seq < 50 or seq >= 1000000000000").write.json(src)
    stream = spark.readStream.schema("seq long, value string").json(src)
    queries = jobs.log_stage_stream(stream, out, os.path.join(tmpdir_path, "ck"), {"availableNow": True})
    assert len(queries) == 1
    queries[0].awaitTermination(300)
    plan = jobs.tagged_log_stream(stream).writeStream.format("noop").trigger(availableNow=True).option("checkpointLocation", os.path.join(tmpdir_path, "ck2")).start()
    plan.awaitTermination(300)
    physical = plan._jsq.explainInternal(False)
    assert physical.count("from_json") == 1
    dirty = spark.read.json(os.path.join(out, "dirty"))
    assert dirty.count() == FX.raw_log_lines(spark, SF_SMALL).where("seq >= 1000000000000").count() and dirty.where("value is null").count() == 0


def test_hot_visitor_is_spread_over_keys(spark, tmpdir_path):
    """20,000 rows of one visitor in one batch: many keys with few rows each, and the batch result."""
    rows = [("hot", i, 7_000 * i, "0", "v", "c", "a", "home", None if i % 3 else "x", None, None, 1) for i in range(20_000)]
    src, ck = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "ck")
    flat = spark.createDataFrame(rows + [("zz", -1, 4_102_444_800_000, "0", "v", "c", "a", "home", "home", None, None, 1)], STREAM_PAGE)
    flat.coalesce(1).write.json(src)
    stream = spark.readStream.schema(STREAM_PAGE).json(src)
    q = (jobs.jump_detail_stream(stream, 10_000).writeStream.format("memory").queryName("hot_jumps").option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    want = visits.jump_detail(jobs.struct_page_rows(flat), 10_000)
    assert shown(spark.table("hot_jumps"), "seq") == shown(want, "seq") != []
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress) > 500  # keys, not one visitor
