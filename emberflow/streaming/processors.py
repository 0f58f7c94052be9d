"""Custom keyed state for the three stream operators Spark has no built-in for.

All three run under ``groupBy(mid).transformWithStateInPandas`` on flat page
rows (``STREAM_PAGE``). Within a micro-batch a key's rows are handled in
``(ts, seq)`` order, the order the batch forms use.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

S_, L_ = T.StringType(), T.LongType()
STREAM_PAGE = T.StructType([
    T.StructField("mid", S_), T.StructField("seq", L_), T.StructField("ts", L_),
    T.StructField("is_new", S_), T.StructField("vc", S_), T.StructField("ch", S_),
    T.StructField("ar", S_), T.StructField("page_id", S_), T.StructField("last_page_id", S_),
    T.StructField("item", S_), T.StructField("item_type", S_),
    T.StructField("during_time", L_),
])
COLS = [f.name for f in STREAM_PAGE.fields]
# A page row in the jump state, and whether it is in its own time bucket.
JUMP_ROW = T.StructType([*STREAM_PAGE.fields, T.StructField("own", T.BooleanType())])
JUMP_COLS = [f.name for f in JUMP_ROW.fields]
DAY_MS = 86_400_000


def _rows(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    pdf = pd.concat(list(frames), ignore_index=True)
    return pdf.sort_values(["ts", "seq"], kind="stable").reset_index(drop=True)


_LONGS = {f.name for f in STREAM_PAGE.fields if isinstance(f.dataType, T.LongType)}


def _tuples(pdf: pd.DataFrame, columns: list[str]) -> list[tuple]:
    """State values are tuples of plain Python values (None for missing)."""
    out = []
    for row in pdf[columns].itertuples(index=False, name=None):
        out.append(tuple(None if pd.isna(v) else (int(v) if c in _LONGS else bool(v) if c == "own" else v)
                         for c, v in zip(columns, row)))
    return out


def _is_entry(last_page_id: pd.Series) -> pd.Series:
    return last_page_id.isna() | (last_page_id.fillna("").str.len() == 0)


# A whole log row carried through the repair as JSON text.
PAYLOAD_ROW = T.StructType([
    T.StructField("mid", S_), T.StructField("seq", L_), T.StructField("ts", L_),
    T.StructField("is_new", S_), T.StructField("payload", S_),
])


class IsNewRepair(StatefulProcessor):
    """First ``is_new='1'`` row per visitor keeps the flag; later ones get '0'.
    State: one boolean per visitor, no expiry by default (as in the
    original); ``ttl_ms`` bounds it (processing-time mode)."""

    def __init__(self, columns: list[str] | None = None, ttl_ms: int | None = None):
        self.columns = columns or COLS
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "flag boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        ones = pdf.index[pdf["is_new"] == "1"]
        if len(ones):
            already = self.seen.exists()
            later = ones if already else ones[1:]
            pdf.loc[later, "is_new"] = "0"
            if not already:
                self.seen.update((True,))
        yield pdf[self.columns]

    def close(self) -> None:
        pass


class UniqueVisit(StatefulProcessor):
    """Emit an entry page when its local date differs from the visitor's last
    emitted date. A timer clears the date 24 h of event time after the page
    that wrote it, so state follows the data's clock, also in a replay."""

    def __init__(self, tz: str = "UTC", ttl_ms: int = DAY_MS):
        self.tz, self.ttl_ms = tz, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_date", "d string, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        pdf = pdf[_is_entry(pdf["last_page_id"])]
        if pdf.empty:
            return
        days = (pd.to_datetime(pdf["ts"], unit="ms", utc=True).dt.tz_convert(self.tz)
                .dt.strftime("%Y-%m-%d"))
        last, due = self.last.get() if self.last.exists() else (None, None)
        keep = []
        for i, d in zip(pdf.index, days):
            if d != last:
                keep.append(i)
                last = d
        if keep:
            if due is not None:
                self.handle.deleteTimer(due)
            due = int(pdf.loc[keep[-1], "ts"]) + self.ttl_ms
            self.handle.registerTimer(due)
            self.last.update((last, due))
        yield pdf.loc[keep, COLS]

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


class JumpDetail(StatefulProcessor):
    """Bounce pattern: ``times`` consecutive entry pages within ``within_ms``.

    Keys are (visitor, time bucket); rows in the first ``within`` of a bucket
    also come, as copies, to the bucket before, so a visitor with very many rows
    is spread over buckets. Only a bucket's own rows are decided there. Rows are
    buffered per key (``ListState``), frame by frame as they come. An entry row is decided when
    the watermark passes its ``ts + within``: every successor that can still
    arrive on time is in the buffer by then. It is emitted on a match or a
    timeout, dropped when a successor inside the range is not an entry page.
    Other rows are held only until the watermark passes their ``ts`` (an earlier
    entry can still arrive) or, after a pending entry, until that is decided.
    One timer per key stands at the earliest row due; when it fires all due
    rows are handled and it is set for the next.
    """

    def __init__(self, within_ms: int = 10_000, times: int = 2):
        self.within, self.times = within_ms, times

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", JUMP_ROW)
        self.timer = handle.getValueState("timer", "at bigint")

    def _due(self, pdf: pd.DataFrame) -> pd.Series:
        open_ = _is_entry(pdf["last_page_id"]) & pdf["own"].astype(bool)
        return pdf["ts"] + open_.map({True: self.within, False: 1})

    def _set_timer(self, at: int) -> None:
        now = self.timer.get()[0] if self.timer.exists() else None
        if now is not None and now <= at:
            return
        if now is not None:
            self.handle.deleteTimer(now)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            self.buf.appendList(_tuples(pdf, JUMP_COLS))
            self._set_timer(int(self._due(pdf).min()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        buf = pd.DataFrame(list(self.buf.get()) if self.buf.exists() else [], columns=JUMP_COLS)
        self.buf.clear()
        if buf.empty:
            return
        buf = buf.sort_values(["ts", "seq"], kind="stable").reset_index(drop=True)
        entry, ts, n = _is_entry(buf["last_page_id"]).to_numpy(), buf["ts"].to_numpy(), len(buf)
        open_ = entry & buf["own"].astype(bool).to_numpy()
        emit, rest, pending = [], [], None  # pending: time of the last undecided entry
        for i in range(n):
            if not open_[i]:
                if ts[i] > wm or pending is not None and ts[i] - pending < self.within:
                    rest.append(i)
                continue
            if ts[i] + self.within > wm:
                pending = ts[i]
                rest.append(i)
                continue
            after = [j for j in range(i + 1, min(i + self.times, n)) if ts[j] - ts[i] < self.within]
            if all(entry[j] for j in after):
                emit.append(i)
        if rest:
            held = buf.loc[rest]
            self.buf.put(_tuples(held, JUMP_COLS))
            due = self._due(held)
            # rows kept for a pending entry are looked at again when it is due
            self._set_timer(int(due[due > wm].min()))
        if emit:
            yield buf.loc[emit, COLS]

    def close(self) -> None:
        pass
