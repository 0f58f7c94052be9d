"""Stream forms of the stateless / windowed stages equal their batch forms;
a query restarted from its checkpoint finishes with the same output."""

import glob
import os
import shutil

from pyspark.sql import functions as F

from conftest import SF_SMALL
from emberflow import schemas as S
from emberflow.operators import cdc, stats, wide
from emberflow.plans import catalog
from emberflow.sources import fixtures as FX
from emberflow.streaming import dim_store, sinks

FAR_FUTURE = "2100-01-01 00:00:00"


def _to_files(df, path, order_col, n=2, extra=None):
    """Rows as ``n`` time-ordered JSON files (mtime = arrival order)."""
    tmp = path + "_parts"
    df.repartitionByRange(n, order_col).sortWithinPartitions(order_col).write.json(tmp)
    files = sorted(glob.glob(os.path.join(tmp, "part-*.json")))
    os.makedirs(path)
    for i, f in enumerate(files):
        dst = os.path.join(path, f"{i:03d}.json")
        shutil.copy(f, dst)
        os.utime(dst, (1_000_000 + 10 * i,) * 2)
    if extra is not None:
        extra.coalesce(1).write.json(tmp + "_x")
        for f in glob.glob(os.path.join(tmp + "_x", "part-*.json")):
            dst = os.path.join(path, "999.json")
            shutil.copy(f, dst)
            os.utime(dst, (2_000_000,) * 2)
    return path


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def _drain(df, name, ckpt, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(600)
    return df.sparkSession.table(name)


def _same(a, b, cols):
    ra = sorted(tuple(r) for r in a.select(*cols).collect())
    rb = sorted(tuple(r) for r in b.select(*cols).collect())
    if ra != rb:
        sa, sb = set(ra), set(rb)
        print("ONLY GOT", len(ra), sorted(sa - sb)[:5])
        print("ONLY WANT", len(rb), sorted(sb - sa)[:5])
    assert ra == rb
    return len(ra)


def test_order_wide_stream_join_equals_batch(spark, tmpdir_path):
    inp = catalog.Inputs(spark, SF_SMALL)
    oi, od = FX.order_info(spark, SF_SMALL), FX.order_detail(spark, SF_SMALL)
    po = _to_files(oi, os.path.join(tmpdir_path, "oi"), "create_time")
    pd_ = _to_files(od, os.path.join(tmpdir_path, "od"), "create_time")
    so, sd = _stream(spark, po, oi.schema), _stream(spark, pd_, od.schema)
    band = catalog.ORDER_BAND_MS
    got = _drain(wide.order_wide(so, sd, inp.dims(), -band, band, catalog.as_of(),
                                 watermark="0 seconds"), "ow_s",
                 os.path.join(tmpdir_path, "ck"))
    want = inp.order_wide()
    assert _same(got, want, ["detail_id", "order_id", "sku_name", "province_name", "user_age",
                             "tm_name", "category3_name", "split_total_amount"]) > 0


def test_keyword_stats_stream_equals_batch(spark, tmpdir_path):
    rows = FX.search_page_rows(spark, SF_SMALL)
    closer = spark.createDataFrame(
        [({"mid": "x"}, {"last_page_id": "search", "item": "zzcloser"}, 4_102_444_800_000)],
        rows.schema)
    p = _to_files(rows, os.path.join(tmpdir_path, "kw"), "ts", extra=closer)
    got = _drain(stats.keyword_stats(_stream(spark, p, rows.schema), stamp="window_end"),
                 "kw_s", os.path.join(tmpdir_path, "ck"))
    want = stats.keyword_stats(rows, stamp="window_end")
    assert _same(got, want, ["keyword", "ct", "source", "stt", "edt", "ts"]) > 0


def test_province_and_product_stats_stream_equal_batch(spark, tmpdir_path):
    inp = catalog.Inputs(spark, SF_SMALL)
    ow = inp.order_wide().select("province_id", "province_name", "province_area_code",
                                 "province_iso_code", "province_3166_2_code", "order_id",
                                 "split_total_amount", "create_time")
    closer = spark.createDataFrame([(99, "x", "x", "x", "x", -1, None, FAR_FUTURE)], ow.schema)
    p = _to_files(ow, os.path.join(tmpdir_path, "ow"), "create_time", extra=closer)
    got = _drain(stats.province_stats(_stream(spark, p, ow.schema), stamp="window_end"),
                 "prov_s", os.path.join(tmpdir_path, "ck1"))
    want = stats.province_stats(ow, stamp="window_end")
    cols = ["stt", "edt", "province_id", "order_amount", "order_count", "ts"]
    assert _same(got, want, cols) > 0

    m = stats.union_product(*catalog.product_metric_frames(spark, SF_SMALL, inp))
    closer = spark.createDataFrame([(-1,) + (0,) * 7 + (None,) * 3 + (None,) * 3
                                    + (4_102_444_800_000,)], m.schema)
    p2 = _to_files(m, os.path.join(tmpdir_path, "m"), "ts", extra=closer)
    got2 = _drain(stats.product_stats_core(_stream(spark, p2, m.schema)), "prod_s",
                  os.path.join(tmpdir_path, "ck2"))
    want2 = stats.product_stats_core(m)
    cols2 = ["stt", "sku_id", "click_ct", "display_ct", "order_ct", "paid_order_ct",
             "refund_order_ct", "order_amount", "refund_amount", "ts"]
    assert _same(got2.filter("sku_id >= 0"), want2, cols2) > 0


def test_route_stream_writes_topics_and_versioned_dims(spark, tmpdir_path):
    raw = FX.change_records(spark, SF_SMALL)
    p = _to_files(raw, os.path.join(tmpdir_path, "chg"), "seq", n=3)
    cfg_path = os.path.join(tmpdir_path, "cfg")
    FX.routing_config(spark).write.parquet(cfg_path)
    envs = cdc.cdc_normalize(_stream(spark, p, raw.schema))
    out = os.path.join(tmpdir_path, "out")
    q = sinks.route_stream(envs, cfg_path, out, os.path.join(tmpdir_path, "ck"),
                           trigger={"availableNow": True})
    q.awaitTermination(600)
    got = dim_store.read_dim(spark, os.path.join(out, "dims", "dim_user_info"))
    want = catalog.q_sink_dim_upsert(spark, SF_SMALL)
    assert _same(got, want, ["ID", "NAME", "GENDER", "BIRTHDAY"]) > 0
    facts = spark.read.text(os.path.join(out, "topics", "*", "*", "sink_table=*"))
    batch_facts, _ = cdc.route(cdc.cdc_normalize(raw), FX.routing_config(spark))
    assert facts.count() == batch_facts.count()


def test_restart_from_checkpoint_same_output(spark, tmpdir_path):
    rows = FX.search_page_rows(spark, SF_SMALL)
    closer = spark.createDataFrame(
        [({"mid": "x"}, {"last_page_id": "search", "item": "zzcloser"}, 4_102_444_800_000)],
        rows.schema)
    staged = _to_files(rows, os.path.join(tmpdir_path, "all"), "ts", n=4, extra=closer)
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    files = sorted(os.listdir(staged))
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")

    def run():
        df = stats.keyword_stats(_stream(spark, src, rows.schema), stamp="window_end")
        q = sinks.report_stream(df, out, S.KEYWORD_STATS_COLUMNS, ck,
                                trigger={"availableNow": True})
        q.awaitTermination(600)

    for f in files[:2]:                       # first run sees half of the files
        shutil.copy(os.path.join(staged, f), os.path.join(src, f))
        os.utime(os.path.join(src, f), (os.path.getmtime(os.path.join(staged, f)),) * 2)
    run()
    for f in files[2:]:                       # restart from the checkpoint
        shutil.copy(os.path.join(staged, f), os.path.join(src, f))
        os.utime(os.path.join(src, f), (os.path.getmtime(os.path.join(staged, f)),) * 2)
    run()
    got = spark.read.parquet(out)
    want = stats.keyword_stats(rows, stamp="window_end")
    assert _same(got, want, ["keyword", "ct", "stt", "edt"]) > 0


def test_keyword_stats_sql_on_stream_and_lateral_udtf(spark, tmpdir_path):
    from emberflow.plans import sql_jobs
    rows = FX.search_page_rows(spark, SF_SMALL)
    closer = spark.createDataFrame(
        [({"mid": "x"}, {"last_page_id": "search", "item": "zzcloser"}, 4_102_444_800_000)],
        rows.schema)
    p = _to_files(rows, os.path.join(tmpdir_path, "kw"), "ts", extra=closer)
    got = _drain(sql_jobs.keyword_stats_sql(spark, _stream(spark, p, rows.schema),
                                            stamp="window_end"),
                 "kw_sql_s", os.path.join(tmpdir_path, "ck"))
    want = stats.keyword_stats(rows, stamp="window_end")
    cols = ["keyword", "ct", "source", "stt", "edt", "ts"]
    assert _same(got, want, cols) > 0
    lateral = sql_jobs.keyword_stats_lateral_sql(spark, rows, stamp="window_end")
    assert _same(lateral, want, cols) > 0


def test_payment_wide_stream_join_equals_batch(spark, tmpdir_path):
    inp = catalog.Inputs(spark, SF_SMALL)
    ow = inp.order_wide()
    pay = FX.payment_info(spark, SF_SMALL)
    pw = _to_files(ow, os.path.join(tmpdir_path, "ow"), "create_time")
    pp = _to_files(pay, os.path.join(tmpdir_path, "pay"), "create_time")
    got = _drain(wide.payment_wide(_stream(spark, pp, pay.schema), _stream(spark, pw, ow.schema),
                                   catalog.PAYMENT_LOWER_MS, catalog.PAYMENT_UPPER_MS,
                                   watermark="0 seconds"),
                 "pw_s", os.path.join(tmpdir_path, "ck"))
    want = wide.payment_wide(pay, ow, catalog.PAYMENT_LOWER_MS, catalog.PAYMENT_UPPER_MS)
    assert _same(got, want, ["payment_id", "detail_id", "order_id", "payment_create_time",
                             "order_create_time", "tm_name", "split_total_amount"]) > 0


def test_unparsable_time_falls_back_to_record_time(spark):
    pay = spark.createDataFrame(
        [(1, 1, "not a time", "2024-01-01 00:10:00")],
        "id long, order_id long, create_time string, rec string").withColumn(
        "rec", F.to_timestamp("rec"))
    ow = spark.createDataFrame([(1, "2024-01-01 00:00:00", "2024-01-01 00:00:00")],
                               "order_id long, create_time string, rec string").withColumn(
        "rec", F.to_timestamp("rec"))
    j = wide.payment_wide_join(pay, ow, record_time="rec")
    assert j.count() == 1          # 00:10 payment, order 10 min before: inside -15 min
    assert wide.payment_wide_join(pay, ow).count() == 0   # no fallback: no event time


def test_late_rows_dropped_across_batches(spark, tmpdir_path):
    """No allowed lateness anywhere: a row older than the watermark that
    arrives in a later micro-batch is dropped from its window."""
    schema = FX.search_page_rows(spark, SF_SMALL).schema
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)

    def put(i, rows):
        d = os.path.join(tmpdir_path, f"f{i}")
        spark.createDataFrame(rows, schema).coalesce(1).write.json(d)
        f = glob.glob(os.path.join(d, "part-*.json"))[0]
        shutil.copy(f, os.path.join(src, f"{i}.json"))
        os.utime(os.path.join(src, f"{i}.json"), (1_000_000 + i,) * 2)

    def row(word, ts):
        return ({"mid": "m"}, {"last_page_id": "search", "item": word}, ts)

    # Spark filters late input with the previous batch's watermark, so the
    # late row comes two batches after the rows that moved the watermark.
    put(0, [row("early", 100_000), row("early", 101_000)])
    put(1, [row("ontime", 120_000)])
    put(2, [row("late", 5_000)])                    # 5 s << watermark 100 s
    put(3, [row("closer", 4_102_444_800_000)])
    got = _drain(stats.keyword_stats(_stream(spark, src, schema), stamp="window_end"),
                 "late_s", os.path.join(tmpdir_path, "ck"))
    words = sorted((r.keyword, r.ct) for r in got.collect())
    assert words == [("early", 2), ("ontime", 1)]


def test_order_side_jobs_chained_through_a_topic(spark, tmpdir_path):
    """order_info + order_detail topics -> order-wide job -> dwm_order_wide
    topic -> province-stats job -> report table, as two running queries."""
    from emberflow.streaming import warehouse
    inp = catalog.Inputs(spark, SF_SMALL)
    oi, od = FX.order_info(spark, SF_SMALL), FX.order_detail(spark, SF_SMALL)
    # one far-future order + line closes the last windows downstream (a topic
    # written by a file sink is read through its own log, so the closing row
    # has to travel through the job like any other row)
    oi_close = oi.limit(1).withColumn("id", F.lit(-1).cast("bigint")) \
        .withColumn("province_id", F.lit(-1).cast("bigint")) \
        .withColumn("create_time", F.lit(FAR_FUTURE))
    od_close = od.limit(1).withColumn("order_id", F.lit(-1).cast("bigint")) \
        .withColumn("create_time", F.lit(FAR_FUTURE))
    p_oi = _to_files(oi, os.path.join(tmpdir_path, "dwd_order_info"), "create_time",
                     extra=oi_close)
    p_od = _to_files(od, os.path.join(tmpdir_path, "dwd_order_detail"), "create_time",
                     extra=od_close)
    topic = os.path.join(tmpdir_path, "dwm_order_wide")
    ck = os.path.join(tmpdir_path, "ck")
    band = catalog.ORDER_BAND_MS
    q1 = warehouse.start_order_wide(spark, p_oi, p_od, oi.schema, od.schema, inp.dims(), topic,
                                    ck, -band, band, trigger={"availableNow": True},
                                    as_of=catalog.as_of(), max_files_per_trigger=1)
    q1.awaitTermination(600)
    want_wide = inp.order_wide()
    report = os.path.join(tmpdir_path, "province_stats")
    q2 = warehouse.start_province_stats(spark, topic, want_wide.schema, report, ck,
                                        trigger={"availableNow": True}, stamp="window_end")
    q2.awaitTermination(600)
    got = spark.read.parquet(report)
    want = stats.province_stats(want_wide, stamp="window_end")
    assert _same(got, want, ["stt", "edt", "province_id", "order_amount", "order_count",
                             "ts"]) > 0
