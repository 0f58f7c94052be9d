"""The segment dimension store, run-scoped sinks, and lookups that follow it."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from emberflow import schemas as S
from emberflow.operators import cdc, joins, logs, wide
from emberflow.plans import catalog
from emberflow.sources import fixtures as FX
from emberflow.sources import topics
from emberflow.streaming import dim_store, jobs, sinks, warehouse
from emberflow.streaming.processors import STREAM_PAGE


def changes(spark, rows):
    """rows of (seq, after)."""
    return spark.createDataFrame(rows, "seq long, after map<string,string>")


def table(spark, root):
    got = dim_store.read_dim(spark, root)
    return {tuple(sorted(r.asDict().items())) for r in got.collect()}


def row(**values):
    return tuple(sorted(values.items()))


def test_narrower_change_keeps_other_columns(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    assert dim_store.read_dim(spark, root) is None
    dim_store.write_segment(spark, changes(spark, [(1, {"id": "1", "name": "a", "gender": "F"}), (2, {"id": "2", "name": "b", "gender": "M"})]), root, "id", "q", 0)
    dim_store.write_segment(spark, changes(spark, [(3, {"id": "1", "name": "c"}), (4, {"id": "2", "name": None})]), root, "id", "q", 1)
    assert table(spark, root) == {row(ID="1", NAME="c", GENDER="F"), row(ID="2", NAME=None, GENDER="M")}


def test_key_keeps_its_own_name(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    rows = changes(spark, [(1, {"code": "x", "id": "9", "name": "n"})])
    dim_store.write_segment(spark, rows, root, "code", "q", 0)
    assert table(spark, root) == {row(CODE="x", ID="9", NAME="n")}
    up = cdc.dim_upsert(spark.createDataFrame([("x", "8", "o", "k")], "CODE string, ID string, NAME string, EXTRA string"), rows, ["code", "id"], "code")
    assert [r.asDict() for r in up.collect()] == [{"CODE": "x", "ID": "9", "NAME": "o", "EXTRA": "k"}]


def test_fresh_checkpoint_comes_after_and_replay_overwrites(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    for batch in range(3):
        dim_store.write_segment(spark, changes(spark, [(batch, {"id": "1", "v": f"a{batch}"})]), root, "id", "first", batch)
    dim_store.write_segment(spark, changes(spark, [(0, {"id": "1", "v": "b0"}), (0, {"id": "2", "v": "new"})]), root, "id", "second", 0)
    expected = {row(ID="1", V="b0"), row(ID="2", V="new")}
    assert table(spark, root) == expected
    dim_store.write_segment(spark, changes(spark, [(0, {"id": "1", "v": "b0"}), (0, {"id": "2", "v": "new"})]), root, "id", "second", 0)
    assert table(spark, root) == expected
    assert len(dim_store.table(spark, root).current().segments) == 4
    dim_store.write_segment(spark, changes(spark, [(0, {"id": "1", "v": "a1"})]), root, "id", "first", 1)  # a replay of an old batch
    assert table(spark, root) == expected


def test_unreadable_file_raises(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    dim_store.write_segment(spark, changes(spark, [(1, {"id": "1", "v": "a"})]), root, "id", "q", 0)
    folder = os.path.join(root, dim_store.table(spark, root).current().segments[0]["path"])
    part = next(f for f in os.listdir(folder) if f.startswith("part"))
    with open(os.path.join(folder, part), "wb") as f:
        f.write(b"no parquet at all, but long enough to be read")
    with pytest.raises(Exception):
        dim_store.read_dim(spark, root).collect()


def test_files_and_segments_stay_few_over_many_batches(spark, tmpdir_path):
    """Many batches of the same keys: the live segments grow with the logarithm, replaced ones are deleted."""
    root = os.path.join(tmpdir_path, "dim")
    most = 0
    for batch in range(40):
        rows = [(batch, {"id": str(i), "v": f"{batch}"}) for i in range(batch % 5, 20, 5)]
        dim_store.write_segment(spark, changes(spark, rows).coalesce(1), root, "id", "q", batch, ratio=3, keep=2)
        now = dim_store.table(spark, root).current()
        most = max(most, len(now.segments))
        assert all(sum(s["level"] == level for s in now.segments) < 3 for level in range(6))
    assert most <= 2 * 4 and len(os.listdir(os.path.join(root, "segments"))) <= most + 3 * 2
    assert len([f for f in os.listdir(os.path.join(root, "_manifest")) if f.endswith(".json")]) <= 2
    assert table(spark, root) == {row(ID=str(i), V=str(35 + i % 5)) for i in range(20)}


@pytest.mark.parametrize("point", ["batch", "merge"])
def test_crash_between_write_and_switch(spark, tmpdir_path, monkeypatch, point):
    root = os.path.join(tmpdir_path, "dim")
    put = lambda n: dim_store.write_segment(spark, changes(spark, [(n, {"id": str(n % 2), "v": f"v{n}"})]), root, "id", "q", n, ratio=3)
    put(0)
    put(1)
    before = table(spark, root)
    commits, real = [], dim_store.SegmentTable.commit

    def commit(self, manifest):
        commits.append(manifest.version)
        if len(commits) == (1 if point == "batch" else 2):
            raise OSError("the driver is lost")
        return real(self, manifest)

    monkeypatch.setattr(dim_store.SegmentTable, "commit", commit)
    with pytest.raises(OSError):
        put(2)
    monkeypatch.undo()
    after = {row(ID="0", V="v2"), row(ID="1", V="v1")}
    assert table(spark, root) == (before if point == "batch" else after)
    put(2)  # the replay
    put(3)
    assert table(spark, root) == {row(ID="0", V="v2"), row(ID="1", V="v3")}
    levels = sorted(s["level"] for s in dim_store.table(spark, root).current().segments)
    assert levels == [0, 1] if point == "batch" else levels == [1]


def files_read(df):
    """Rows, and files that the scans of ``df`` opened."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return rows, sum(s.metrics().get("numFiles").get().value() for s in scans if "Scan" in s.nodeName())


def test_lookup_reads_the_buckets_of_its_keys_only(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    every = spark.range(20000).select(F.col("id").alias("seq"), F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("name"), F.concat(F.lit("n"), "id")).alias("after"))
    for batch in range(2):
        dim_store.write_segment(spark, every.where(f"seq % 2 = {batch}"), root, "id", "q", batch, ratio=2)
    assert [s["level"] for s in dim_store.table(spark, root).current().segments] == [1]
    dim_store.write_segment(spark, changes(spark, [(1, {"id": "7", "name": "new"})]), root, "id", "q", 2, ratio=2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = spark.createDataFrame([(7,), (7,), (11111,), (-1,), (None,)], "k long")
        found = dim_store.lookup(spark, root, keys, ["ID", "NAME", "OTHER"])
        rows, opened = files_read(found)
        assert sorted(tuple(r) for r in rows) == [("11111", "n11111", None), ("7", "new", None)]
        assert opened <= 3 + 1  # one file for each key's bucket, and the last batch
        assert files_read(dim_store.read_dim(spark, root))[1] >= 64
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
        assert "In(pk" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    many = dim_store.lookup(spark, root, spark.range(3000).toDF("k"), ["ID", "NAME"])
    assert many.count() == 3000 and {r.NAME for r in many.where("ID in ('7', '8')").collect()} == {"new", "n8"}


def test_lookups_before_a_dimension_exists_give_nulls(spark, tmpdir_path):
    names = {k: k for k in ("user", "province", "sku", "spu", "tm", "category3")}
    stored = warehouse.stored_dims(os.path.join(tmpdir_path, "dims"), names)
    merged = catalog.merged_orders(spark, "/root/testdata/sf0.001").limit(50).cache()
    plain = wide.order_wide_lookups(merged, stored(spark), catalog.as_of())
    batch = wide.order_wide_lookups(merged, stored.for_batch(merged), catalog.as_of())
    assert batch.count() == plain.count() == 50
    assert batch.where("user_gender is not null or province_name is not null or spu_name is not null or tm_name is not null").count() == 0


def test_stored_lookups_equal_whole_tables(spark, tmpdir_path):
    d, root = "/root/testdata/sf0.001", os.path.join(tmpdir_path, "dims")
    inp = catalog.Inputs(spark, d)
    names = {k: k for k in ("user", "province", "sku", "spu", "tm", "category3")}
    for k in names:
        cols = [F.lit(x) for c in inp.dims()[k].columns for x in (c,)]
        pairs = [x for c, n in zip(inp.dims()[k].columns, cols) for x in (n, F.col(c).cast("string"))]
        rows = inp.dims()[k].select(F.lit(1).cast("long").alias("seq"), F.create_map(*pairs).alias("after"))
        dim_store.write_segment(spark, rows, f"{root}/{k}", "ID", "q", 0)
    merged = inp.merged_orders().where("order_id % 50 = 0").cache()
    stored = warehouse.stored_dims(root, names)
    show = lambda df: sorted(map(str, df.drop("detail_id").collect()))
    want = show(wide.order_wide_lookups(merged, {k: v for k, v in inp.dims().items() if k != "product"}, catalog.as_of()))
    assert show(wide.order_wide_lookups(merged, stored.for_batch(merged), catalog.as_of())) == want != []


def test_keys_of_a_table_cannot_change(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    dim_store.create_dim(spark, root, ["id", "name"], "id", "SALT_BUCKETS = 7")
    assert dim_store.table(spark, root).current().buckets == 7
    with pytest.raises(ValueError):
        dim_store.create_dim(spark, root, ["code"], "code")
    with pytest.raises(ValueError):
        dim_store.write_segment(spark, changes(spark, [(1, {"code": "1"})]), root, "code", "q", 0)
    config = spark.createDataFrame([("a", "insert", "hbase", "dim_a", "id,name", "id", None, 1), ("b", "insert", "hbase", "dim_a", "code,name", "code", None, 1)], S.TABLE_PROCESS)
    none = spark.createDataFrame([], "database string, tableName string, before map<string,string>, after map<string,string>, type string, ts_ms long, seq long")
    with pytest.raises(ValueError, match="different keys"):
        sinks.route_batch(spark, none, config, tmpdir_path, 0, "q")


def test_replayed_batch_is_read_once(spark, tmpdir_path):
    """A stream that has read a batch of a topic does not read it again when the batch is replayed."""
    topic, ck, out = (os.path.join(tmpdir_path, x) for x in ("topic", "ck", "out"))
    shape = "a int, b string"
    rows = spark.createDataFrame([(1, "x"), (2, "y")], shape)
    t = warehouse.Topic.of(topic)
    t.write_batch(rows, 0, "q")

    def read():
        stream = warehouse.Topic.of(topic).read(spark, rows.schema)
        warehouse.Topic.of(out).start(stream, ck, {"availableNow": True}).awaitTermination(300)
        return sorted(tuple(r) for r in spark.read.schema(shape).json(out).collect())

    assert read() == [(1, "x"), (2, "y")]
    t.write_batch(rows, 0, "q")  # the replay

    def broken(folder):
        rows.write.json(folder)
        raise OSError("lost while writing")

    with pytest.raises(OSError):
        sinks.commit_batch(spark, topic, "q", 1, broken)
    assert read() == [(1, "x"), (2, "y")]  # half a batch is not there
    t.write_batch(spark.createDataFrame([(3, "z")], shape), 1, "q")
    assert read() == [(1, "x"), (2, "y"), (3, "z")]


def test_topic_carries_record_time_and_options(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    spark.createDataFrame([(1,)], "a int").write.json(path)
    topic = warehouse.Topic(path=path, record_time="rec")
    stream = topic.read(spark, spark.createDataFrame([], "a int").schema)
    assert stream.columns == ["a", "rec"]
    raw = spark.createDataFrame([('{"a": 1, "b": "x"}', None, 3, 9), ("no json", None, 0, 1)], "value string, timestamp timestamp, partition int, seq long")
    kafka = warehouse.Topic(name="n", servers="s", options={"kafka.security.protocol": "SSL", "startingOffsets": "earliest"}, record_time="rec", offsets=True)
    got = kafka.parsed(raw, spark.createDataFrame([], "a int, b string").schema)
    assert got.columns == ["a", "b", "rec", "topic_partition", "topic_offset"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x", None, 3, 9), (None, None, None, 0, 1)]


def test_two_routes_feed_one_table(spark, tmpdir_path):
    config = spark.createDataFrame([
        ("user_info", "insert", "hbase", "dim_user", "id,name,gender", None, None, 1),
        ("user_info", "update", "hbase", "dim_user", "id,name", None, None, 1)], S.TABLE_PROCESS)
    empty = {}
    envelopes = spark.createDataFrame([
        ("shop", "user_info", empty, {"id": "1", "name": "a", "gender": "F"}, "insert", 1, 1),
        ("shop", "user_info", empty, {"id": "1", "name": "b", "gender": "X"}, "update", 2, 2),
        ("shop", "user_info", empty, {"id": "2", "name": "c", "gender": "M"}, "insert", 3, 3),
        ("shop", "other", empty, {"id": "5"}, "insert", 4, 4),
    ], "database string, tableName string, before map<string,string>, after map<string,string>, type string, ts_ms long, seq long")
    sinks.route_batch(spark, envelopes, config, tmpdir_path, 0, "q")
    assert table(spark, os.path.join(tmpdir_path, "dims", "dim_user")) == {row(ID="1", NAME="b", GENDER="F"), row(ID="2", NAME="c", GENDER="M")}
    assert spark.read.json(sinks.batch_folder(f"{tmpdir_path}/unrouted", "q", 0)).count() == 1


def test_created_table_is_empty_with_columns(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dim")
    dim_store.create_dim(spark, root, ["id", "name"], "id")
    dim_store.create_dim(spark, root, ["other"], "id")
    got = dim_store.read_dim(spark, root)
    assert (got.columns, got.count()) == (["ID", "NAME"], 0)


def test_reports_of_two_checkpoints_stand_side_by_side(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "out")
    spark.createDataFrame([(1, "x")], "a int, b string").write.json(src)
    for ck in ("ck1", "ck2", "ck2"):
        stream = spark.readStream.schema("a int, b string").json(src)
        sinks.report_stream(stream, out, ["b", "a"], os.path.join(tmpdir_path, ck), {"availableNow": True}, fmt="json").awaitTermination(300)
    assert spark.read.json(out).count() == 2 and len([f for f in os.listdir(out) if f.startswith("run=")]) == 2


def test_running_job_sees_a_dimension_change(spark, tmpdir_path):
    oi, od = FX.order_info(spark, "/root/testdata/sf0.001").limit(1), FX.order_detail(spark, "/root/testdata/sf0.001").limit(1)
    first, line = oi.first().asDict(), od.first().asDict()
    dims = os.path.join(tmpdir_path, "dims")
    inp = catalog.Inputs(spark, "/root/testdata/sf0.001").dims()
    put = lambda n, name: dim_store.write_segment(spark, changes(spark, [(n, {"id": "1", "NAME": name})]), dims, "id", "t", n)

    def lookups(s):
        stored = dim_store.read_dim(s, dims)
        province = inp["province"].join(stored.select("ID", F.col("NAME").alias("_n")), "ID").withColumn("NAME", F.col("_n")).drop("_n")
        return {**inp, "province": province}

    o, d, out = (os.path.join(tmpdir_path, x) for x in ("o", "d", "out"))
    names = []
    for n, name in enumerate(("old", "new")):
        put(n, name)
        at = f"2024-01-0{n + 1} 00:00:00"
        spark.createDataFrame([{**first, "id": n, "province_id": 1, "create_time": at}], oi.schema).write.mode("append").json(o)
        spark.createDataFrame([{**line, "order_id": n, "create_time": at}], od.schema).write.mode("append").json(d)
        if n == 0:
            q = warehouse.start_order_wide(spark, o, d, oi.schema, od.schema, lookups, out, os.path.join(tmpdir_path, "ck"), as_of=catalog.as_of())
        q.processAllAvailable()
        names.append(sorted((r.order_id, r.province_name) for r in spark.read.option("recursiveFileLookup", "true").json(out).collect()))
    q.stop()
    assert names == [[(0, "old")], [(0, "old"), (1, "new")]]


def test_change_log_reader_carries_the_topic(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "log")
    spark.createDataFrame([('{"before":null,"after":{"id":"1"},"op":"c","ts_ms":5}',)], "value string").write.text(path)
    raw = topics.read_topic(spark, "server.shop.user_info", stream=False, fmt="text", path=path)
    got = cdc.cdc_normalize(raw).first()
    assert (got.database, got.tableName, got.type, got.after) == ("shop", "user_info", "insert", {"id": "1"})
    nothing = spark.createDataFrame([("shop", "t", {}, {"id": "1"}, None, 1, 1)], "database string, tableName string, before map<string,string>, after map<string,string>, type string, ts_ms long, seq long")
    assert cdc.cdc_current_image(nothing).count() == 1


def test_jump_state_does_not_outlive_the_watermark(spark, tmpdir_path):
    src, ck = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "ck")

    def put(rows):
        full = [(mid, i, ts, "0", "v", "c", "a", "p", last, None, None, 1) for i, (mid, ts, last) in enumerate(rows)]
        spark.createDataFrame(full, STREAM_PAGE).coalesce(1).write.mode("append").json(src)

    put([("walker", 1000 * i, "home") for i in range(300)] + [("bouncer", 5000, None)])
    stream = spark.readStream.schema(STREAM_PAGE).json(src)
    q = (jobs.jump_detail_stream(stream, 10_000).writeStream.option("checkpointLocation", ck)
         .format("memory").queryName("jumps").outputMode("append").start())
    q.processAllAvailable()
    put([("other", 10_000_000, "home")])
    q.processAllAvailable()
    put([("other", 20_000_000, "home")])
    q.processAllAvailable()
    q.stop()
    assert [r.mid for r in spark.table("jumps").collect()] == ["bouncer"]
    # keys are (visitor, bucket)
    held = (spark.read.format("statestore").option("path", ck).option("stateVarName", "buf")
            .option("flattenCollectionTypes", "true").load())
    assert held.count() <= 2 and not held.where("key.mid in ('walker', 'bouncer')").count()


def test_bucketed_interval_join_equals_the_plain_one(spark):
    left = spark.range(300).selectExpr("id % 3 as k", "timestamp_millis(id * 137) as t", "id as l")
    right = spark.range(300).selectExpr("id % 3 as k2", "timestamp_millis(id * 151 - 4000) as t2", "id as r")
    for lower, upper, inclusive in ((-500, 500, True), (0, 1000, False), (-3000, -2000, True), (10, 10, True)):
        plain, fast = (sorted((x.l, x.r) for x in joins.interval_join(left, right, "k", "k2", "t", "t2", lower, upper, inclusive, inclusive, bucketed=b).collect()) for b in (False, True))
        assert plain == fast and (plain or lower == 10)


def test_tables_are_read_as_they_are_now(spark, tmpdir_path):
    rows = spark.createDataFrame([(1, "r")], "r_regionkey int, r_name string")
    rows.write.parquet(f"{tmpdir_path}/region.parquet")
    assert FX.read_table(spark, tmpdir_path, "region").count() == 1
    rows.write.mode("append").parquet(f"{tmpdir_path}/region.parquet")
    assert FX.read_table(spark, tmpdir_path, "region").count() == 2


def test_hot_order_can_be_split(spark, capsys):
    wide.order_detail_join(FX.order_info(spark, "/root/testdata/sf0.001"), FX.order_detail(spark, "/root/testdata/sf0.001")).explain()
    assert "REPARTITION_BY" not in capsys.readouterr().out


def test_payment_wide_and_product_jobs(spark, tmpdir_path):
    d = "/root/testdata/sf0.001"
    inp = catalog.Inputs(spark, d)
    orders = inp.order_wide()
    pay = FX.payment_info(spark, d)
    far = "2100-01-01 00:00:00"
    p, w, out, ck = (os.path.join(tmpdir_path, x) for x in ("p", "w", "out", "ck"))
    pay.unionByName(pay.limit(1).withColumn("order_id", F.lit(-1).cast("bigint")).withColumn("create_time", F.lit(far))).coalesce(1).write.json(p)
    orders.unionByName(orders.limit(1).withColumn("order_id", F.lit(-2).cast("bigint")).withColumn("create_time", F.lit(far))).coalesce(1).write.json(w)
    warehouse.start_payment_wide(spark, p, w, pay.schema, orders.schema, out, ck, trigger={"availableNow": True}).awaitTermination(600)
    key = lambda df: sorted((r.payment_id, r.sku_id, r.user_id, float(r.split_total_amount)) for r in df.select("payment_id", "sku_id", "user_id", "split_total_amount").collect())
    want = wide.payment_wide(pay, orders)
    assert key(spark.read.schema(want.schema).json(out)) == key(want)
    tables = {"page": logs.split_page(FX.page_log_rows(spark, d)).select("common", "page", "displays", "ts"), "favor": FX.favor_info(spark, d), "cart": FX.cart_info(spark, d),
              "order_wide": orders, "payment_wide": want, "refund": FX.order_refund_info(spark, d), "comment": FX.comment_info(spark, d)}
    time = {"payment_wide": "payment_create_time"}
    folders = {}
    for name, df in tables.items():
        folders[name] = os.path.join(tmpdir_path, f"in_{name}")
        last = df.limit(1)
        if name == "page":  # a detail page long after: closes the windows
            last = last.withColumn("ts", F.lit(4_102_444_800_000)).withColumn("page", F.col("page").withField("page_id", F.lit("good_detail")).withField("item_type", F.lit("sku_id")).withField("item", F.lit("-1")))
            last = last.withColumn("displays", F.lit(None).cast(df.schema["displays"].dataType))
        else:
            last = last.withColumn(time.get(name, "create_time"), F.lit(far)).withColumn("sku_id", F.lit(-1).cast("long"))
        df.unionByName(last).coalesce(1).write.json(folders[name])
    streams = warehouse.product_metric_streams(spark, folders, {n: t.schema for n, t in tables.items()})
    with pytest.raises(ValueError):
        warehouse.product_metric_streams(spark, {"other": "x"}, {})
    report = os.path.join(tmpdir_path, "report")
    warehouse.start_product_stats(spark, streams, lambda _: inp.dims(), report, ck, {"availableNow": True}).awaitTermination(600)
    columns = ["stt", "sku_id", "order_ct", "order_amount", "tm_name", "spu_name"]
    show = lambda df: sorted(map(str, df.where("sku_id >= 0").select(*columns).collect()))
    want = catalog.product_stats_rows(spark, d)
    assert show(spark.read.schema(want.schema).option("recursiveFileLookup", "true").parquet(report)) == show(want)
