"""A visitor holding a third of all rows: results stay exact and the
successor window never puts that visitor's whole history in one group."""

import json
import random

from pyspark.sql import functions as F

from emberflow.operators import logs, visits


def _rows(n_hot=3000, n_cold=6000, seed=3):
    rnd = random.Random(seed)
    out, spec = [], []
    seq = 0
    mids = ["hot"] + [f"m{i}" for i in range(60)]
    clocks = {m: 0 for m in mids}
    for i in range(n_hot + n_cold):
        mid = "hot" if i < n_hot else rnd.choice(mids[1:])
        clocks[mid] += rnd.choice([500, 2_000, 9_000, 10_000, 30_000, 4_000_000])
        entry = rnd.random() < 0.5
        seq += 1
        page = {"page_id": "home", "during_time": 1}
        if not entry:
            page["last_page_id"] = "home"
        flag = "1" if rnd.random() < 0.3 else "0"
        out.append((seq, json.dumps({"common": {"mid": mid, "is_new": flag},
                                     "page": page, "ts": clocks[mid]})))
        spec.append((seq, mid, clocks[mid], entry, flag))
    return out, spec


def _pages(spark, rows):
    raw = spark.createDataFrame(rows, "seq long, value string")
    return logs.split_page(logs.clean_rows(logs.parse_log(raw)))


def test_hot_visitor_results_exact(spark):
    rows, spec = _rows()
    pages = _pages(spark, rows)
    by = {}
    for seq, mid, ts, entry, flag in spec:
        by.setdefault(mid, []).append((ts, seq, entry, flag))
    want_jump, want_uv, want_new = [], [], {}
    for ev in by.values():
        ev.sort()
        seen_new, days = False, set()
        for i, (ts, seq, entry, flag) in enumerate(ev):
            if flag == "1":
                want_new[seq] = "0" if seen_new else "1"
                seen_new = True
            else:
                want_new[seq] = "0"
            if entry and ts // 86_400_000 not in days:
                days.add(ts // 86_400_000)
                want_uv.append(seq)
            if entry:
                nxt = ev[i + 1] if i + 1 < len(ev) else None
                if nxt is None or nxt[0] - ts >= 10_000 or nxt[2]:
                    want_jump.append(seq)
    got_jump = sorted(r.seq for r in visits.jump_detail(pages, 10_000).collect())
    got_uv = sorted(r.seq for r in visits.unique_visit(pages).collect())
    got_new = {r.seq: r.is_new for r in logs.repair_is_new(pages).select(
        "seq", "common.is_new").collect()}
    assert got_jump == sorted(want_jump)
    assert got_uv == sorted(want_uv)
    assert got_new == want_new


def test_hot_visitor_split_across_window_groups(spark):
    rows, _ = _rows()
    pages = _pages(spark, rows).withColumn("_entry", logs.is_entry_page())
    ext = visits.with_successors(pages, "common.mid", "ts", "seq", 10_000, 1,
                                 {"entry": F.col("_entry")})
    # groups of the window = (visitor, bucket); the hot visitor spans many
    bucket = max(10_000 * 16, 60_000)
    sizes = (pages.filter(F.col("common.mid") == "hot")
             .groupBy(F.floor(F.col("ts") / bucket)).count().collect())
    assert len(sizes) > 50
    assert max(r["count"] for r in sizes) < 0.05 * pages.count()
    assert ext.count() == pages.count()
