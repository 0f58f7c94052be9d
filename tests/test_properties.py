"""Property tests: for any event sequence (ties, gaps at exactly the window,
any bucket width) the skew-safe batch forms equal a straight walk."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from emberflow.operators import logs, visits

EVENT = st.tuples(st.sampled_from(["a", "b", "c"]),
                  st.sampled_from([0, 1, 5_000, 9_999, 10_000, 10_001, 40_000, 86_399_999,
                                   86_400_000, 86_400_500, 200_000]),
                  st.integers(0, 3), st.booleans(), st.booleans())


def _frame(spark, events):
    rows, spec = [], []
    for seq, (mid, base, step, entry, new) in enumerate(events):
        ts = base + step * 1_000
        page = {"page_id": "home"}
        if not entry:
            page["last_page_id"] = "home"
        rows.append((seq, json.dumps({"common": {"mid": mid, "is_new": "1" if new else "0"},
                                      "page": page, "ts": ts})))
        spec.append((seq, mid, ts, entry, new))
    raw = spark.createDataFrame(rows, "seq long, value string")
    return logs.split_page(logs.clean_rows(logs.parse_log(raw))), spec


def _walk(spec, within, times):
    by = {}
    for seq, mid, ts, entry, new in spec:
        by.setdefault(mid, []).append((ts, seq, entry, new))
    jump, uv, fixed = [], [], {}
    for ev in by.values():
        ev.sort()
        seen, days = False, set()
        for i, (ts, seq, entry, new) in enumerate(ev):
            fixed[seq] = "1" if new and not seen else "0"
            seen = seen or new
            if entry and ts // 86_400_000 not in days:
                days.add(ts // 86_400_000)
                uv.append(seq)
            if entry:
                keep = True
                for j in range(i + 1, i + times):
                    if j >= len(ev) or ev[j][0] - ts >= within:
                        break
                    if not ev[j][2]:
                        keep = False
                        break
                if keep:
                    jump.append(seq)
    return sorted(jump), sorted(uv), fixed


@settings(max_examples=12, deadline=None)
@given(events=st.lists(EVENT, min_size=1, max_size=40), times=st.sampled_from([2, 3]),
       bucket=st.sampled_from([10_000, 23_000, 160_000]))
def test_visit_operators_equal_straight_walk(spark, events, times, bucket):
    pages, spec = _frame(spark, events)
    want_jump, want_uv, want_new = _walk(spec, 10_000, times)
    got_jump = sorted(r.seq for r in visits.jump_detail(pages, 10_000, times,
                                                         bucket_ms=bucket).collect())
    got_uv = sorted(r.seq for r in visits.unique_visit(pages).collect())
    got_new = {r.seq: r.is_new for r in logs.repair_is_new(pages)
               .select("seq", "common.is_new").collect()}
    assert got_jump == want_jump
    assert got_uv == want_uv
    assert got_new == want_new
