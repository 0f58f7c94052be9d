"""Batch == stream: the same page rows fed as a file stream in several files
give the batch result (custom state for repair / unique visit / jump)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emberflow.operators import logs, stats, visits
from emberflow.sources import fixtures as FX
from emberflow.streaming import jobs
from emberflow.streaming.processors import STREAM_PAGE

FAR_FUTURE_MS = 4_102_444_800_000  # 2100-01-01: closes every open window / timer


def _flat_rows(spark):
    return jobs.flat_page_rows(FX.page_log_rows(spark, SF_SMALL))


def _write_split(df, path, n=3):
    """Write rows as ``n`` JSON files, each a time range (arrival order)."""
    df.repartitionByRange(n, "ts", "seq").sortWithinPartitions("ts", "seq").write.json(path)
    return sorted(os.path.join(path, f) for f in os.listdir(path)
                  if f.startswith("part-") and f.endswith(".json"))


def _run_stream(spark, src_dir, build, tmp, name, parts):
    os.makedirs(src_dir, exist_ok=True)
    stream = spark.readStream.schema(STREAM_PAGE).option("maxFilesPerTrigger", 1).json(src_dir)
    out = build(stream)
    q = (out.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, "ckpt_" + name))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _stage_files(spark, flat, tmp, extra=None):
    """Copy the time-ordered parts into a stream folder one by one."""
    import shutil
    parts = _write_split(flat, os.path.join(tmp, "parts"))
    src = os.path.join(tmp, "src")
    os.makedirs(src)
    for i, p in enumerate(parts):
        dst = os.path.join(src, f"{i:03d}.json")
        shutil.copy(p, dst)
        os.utime(dst, (1_000_000 + i * 10, 1_000_000 + i * 10))  # arrival order
    if extra is not None:
        extra.coalesce(1).write.json(os.path.join(tmp, "extra"))
        d = os.path.join(tmp, "extra")
        for f in os.listdir(d):
            if f.endswith(".json"):
                dst = os.path.join(src, f"999-{f}")
                shutil.copy(os.path.join(d, f), dst)
                os.utime(dst, (2_000_000, 2_000_000))
    return src


def test_is_new_repair_stream_equals_batch(spark, tmpdir_path):
    flat = _flat_rows(spark)
    src = _stage_files(spark, flat, tmpdir_path)
    got = _run_stream(spark, src, jobs.repair_is_new_stream, tmpdir_path, "repair_s", None)
    batch = jobs.flat_page_rows(logs.repair_is_new(FX.page_log_rows(spark, SF_SMALL)))
    assert _rows(got, ["seq", "is_new"]) == _rows(batch, ["seq", "is_new"])


def test_unique_visit_stream_equals_batch(spark, tmpdir_path):
    pages = logs.split_page(FX.page_log_rows(spark, SF_SMALL))
    flat = jobs.flat_page_rows(pages)
    src = _stage_files(spark, flat, tmpdir_path)
    got = _run_stream(spark, src, jobs.unique_visit_stream, tmpdir_path, "uv_s", None)
    batch = jobs.flat_page_rows(visits.unique_visit(pages))
    assert _rows(got, ["seq"]) == _rows(batch, ["seq"])


@pytest.mark.parametrize("times", [2, 3])
def test_jump_detail_stream_equals_batch(spark, tmpdir_path, times):
    within = 3_600_000
    pages = logs.split_page(FX.page_log_rows(spark, SF_SMALL))
    flat = jobs.flat_page_rows(pages)
    closer = spark.createDataFrame(
        [("zz_closer", -1, FAR_FUTURE_MS, "0", "v", "c", "a", "home", "home", None, None, 0)],
        STREAM_PAGE)
    src = _stage_files(spark, flat, tmpdir_path, extra=closer)
    got = _run_stream(spark, src, lambda s: jobs.jump_detail_stream(s, within, times),
                      tmpdir_path, f"uj_s{times}", None)
    batch = jobs.flat_page_rows(visits.jump_detail(pages, within, times))
    assert _rows(got, ["seq"]) == _rows(batch, ["seq"])


def test_visitor_stats_stream_equals_batch(spark, tmpdir_path):
    pages = logs.split_page(FX.page_log_rows(spark, SF_SMALL))
    flat = jobs.flat_page_rows(pages)
    closer = spark.createDataFrame(
        [("zz_closer", -1, FAR_FUTURE_MS, "0", "v", "c", "a", "home", "home", None, None, 0)],
        STREAM_PAGE)
    src = _stage_files(spark, flat, tmpdir_path, extra=closer)
    got = _run_stream(spark, src, lambda s: stats.visitor_stats(
        stats.visitor_pv_metric(jobs.struct_page_rows(s))), tmpdir_path, "vs_s", None)
    batch = stats.visitor_stats(stats.visitor_pv_metric(pages))
    cols = ["stt", "vc", "ch", "ar", "is_new", "pv_ct", "sv_ct", "dur_sum", "ts"]
    assert _rows(got.filter(F.col("vc") != "v"), cols) == _rows(batch, cols)


def test_log_stage_stream_equals_batch(spark, tmpdir_path):
    raw = FX.raw_log_lines(spark, SF_SMALL)
    parts = os.path.join(tmpdir_path, "raw_parts")
    raw.repartitionByRange(2, "seq").sortWithinPartitions("seq").write.json(parts)
    src = os.path.join(tmpdir_path, "raw")
    os.makedirs(src)
    import shutil
    for i, f in enumerate(sorted(x for x in os.listdir(parts) if x.endswith(".json"))):
        shutil.copy(os.path.join(parts, f), os.path.join(src, f"{i:03d}.json"))
        os.utime(os.path.join(src, f"{i:03d}.json"), (1_000_000 + i * 10,) * 2)
    stream = (spark.readStream.schema("seq long, value string")
              .option("maxFilesPerTrigger", 1).json(src))
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    for q in jobs.log_stage_stream(stream, out, ck, trigger={"availableNow": True}):
        q.awaitTermination(600)
    parsed = logs.parse_log(raw)
    clean = logs.repair_is_new(logs.clean_rows(parsed))
    pages = spark.read.json(os.path.join(out, "dwd_page_log"))
    assert _rows(pages, ["seq", "common.is_new"]) == \
        _rows(logs.split_page(clean), ["seq", "common.is_new"])
    assert spark.read.json(os.path.join(out, "dwd_start_log")).count() == \
        logs.split_start(clean).count()
    assert spark.read.json(os.path.join(out, "dwd_display_log")).count() == \
        logs.split_display(logs.split_page(clean)).count()
    assert spark.read.json(os.path.join(out, "dirty")).count() == \
        logs.dirty_lines(parsed).count()


def test_visitor_stats_from_three_streams(spark, tmpdir_path):
    """uv / uj / pv land as three topics; the stats query unions them with
    an 11 s watermark (the jump rows' 10 s wait + 1 s bound)."""
    import shutil
    within = 3_600_000
    pages = logs.split_page(logs.repair_is_new(FX.page_log_rows(spark, SF_SMALL)))
    closer = spark.createDataFrame(
        [("zz_closer", -1, FAR_FUTURE_MS, "0", "v", "c", "a", "home", "home", None, None, 0)],
        STREAM_PAGE)
    srcs = {}
    for name, df in {"uv": visits.unique_visit(pages),
                     "uj": visits.jump_detail(pages, within),
                     "pv": pages}.items():
        flat = jobs.flat_page_rows(df)
        tmp = os.path.join(tmpdir_path, name)
        os.makedirs(tmp)
        srcs[name] = _stage_files(spark, flat, tmp, extra=closer)
    streams = {n: spark.readStream.schema(STREAM_PAGE).option("maxFilesPerTrigger", 1).json(p)
               for n, p in srcs.items()}
    out = jobs.visitor_stats_stream(streams["uv"], streams["uj"], streams["pv"])
    q = (out.writeStream.format("memory").queryName("vs3").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    want = stats.visitor_stats(stats.union_visitor(
        visits.unique_visit(pages), visits.jump_detail(pages, within), pages))
    cols = ["stt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum",
            "ts"]
    assert _rows(spark.table("vs3").filter(F.col("vc") != "v"), cols) == _rows(want, cols)
