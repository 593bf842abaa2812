"""Stateful processors: the streaming twins of ``emporia.operators.state``.

Each processor keeps one small value per key in the state store
(RocksDB provider, checkpointed) and is driven by
``groupBy(key).transformWithStateInPandas``. Rows of a key arrive per
micro-batch in no particular order, so every processor sorts its batch
by ``(ts_ms, tie)`` first -- the same order the batch closed forms use,
which is what makes stream and batch results equal.

State time-to-live (F10): Spark allows state TTL only in processing-time
mode, so the event-time processors expire state with an event-time timer
instead (``expire_ms`` after the key's latest record); the processing-time
ones take ``ttl_ms``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_DAY_MS = 86_400_000


def _days(ts_ms: pd.Series) -> pd.Series:
    """Epoch day (UTC) of epoch-ms values."""
    return (ts_ms // _DAY_MS).astype("int64")


def _sorted(rows: Iterator[pd.DataFrame], ts: str, tie: str) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values([ts, tie], kind="stable").reset_index(drop=True)


class _Expiring(StatefulProcessor):
    """Clears the states in ``self.expiring`` once event time passes the
    key's latest record by ``expire_ms`` (one timer per key)."""

    expire_ms: int | None = None
    expiring: tuple = ()

    def _rearm(self, latest_ms: int) -> None:
        if not self.expire_ms:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(int(latest_ms) + int(self.expire_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for st in self.expiring:
            st.clear()
        return iter([])


class TrafficMarker(_Expiring):
    """F1 + F2 per device: repair ``is_new`` (state: the first record's
    visit date) and mark the first page record of each day (state: the
    last page visit day); start records update F1 only and are not emitted.

    Input: ``mid, event_id, ts_ms, et, is_new, has_start, last_page_id,
    vc, ch, ar, during_time``. Output: page records with ``uv_ct``,
    ``sv_ct`` and the repaired ``is_new``.
    """

    OUTPUT = ("mid string, event_id long, ts_ms long, et timestamp, vc string, ch string, ar string, "
              "is_new string, uv_ct long, sv_ct long, during_time long")

    def __init__(self, expire_ms: int | None = None):
        self.expire_ms = expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first_visit_day", "day long")
        self.last = handle.getValueState("last_page_day", "day long")
        self.expiring = (self.last,)  # the first-visit day is kept for good (Q14)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, "ts_ms", "event_id")
        day = _days(pdf["ts_ms"])
        if self.first.exists():
            first = self.first.get()[0]
        else:
            first = int(day.iloc[0]) if pdf["is_new"].iloc[0] == "1" else int(day.iloc[0]) - 1
            self.first.update((first,))
        pdf["is_new"] = pdf["is_new"].where(~((pdf["is_new"] == "1") & (day != first)), "0")
        pages = pdf[~pdf["has_start"].fillna(False).astype(bool)].copy()
        if pages.empty:
            return
        pday = _days(pages["ts_ms"])
        prev = pday.shift(1)
        if self.last.exists():
            prev.iloc[0] = self.last.get()[0]
        pages["uv_ct"] = (prev.isna() | (prev != pday)).astype("int64")
        lp = pages["last_page_id"]
        pages["sv_ct"] = (lp.isna() | (lp == "")).astype("int64")
        self.last.update((int(pday.iloc[-1]),))
        self._rearm(pages["ts_ms"].max())
        yield pages[["mid", "event_id", "ts_ms", "et", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct",
                     "during_time"]]

    def close(self) -> None:
        pass


class FirstOfDay(_Expiring):
    """F3 (and each half of F4): emit a key's first record of each day;
    state: the last day emitted (TTL one day in the source job)."""

    def __init__(self, columns: list[str], ts: str = "ts_ms", tie: str = "event_id", expire_ms: int | None = None):
        self.columns, self.ts, self.tie, self.expire_ms = columns, ts, tie, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_day", "day long")
        self.expiring = (self.last,)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.ts, self.tie)
        day = _days(pdf[self.ts])
        prev = day.shift(1)
        if self.last.exists():
            prev.iloc[0] = self.last.get()[0]
        out = pdf[prev.isna() | (prev != day)]
        self.last.update((int(day.iloc[-1]),))
        self._rearm(pdf[self.ts].max())
        if not out.empty:
            yield out[self.columns]

    def close(self) -> None:
        pass


class LoginMarker(_Expiring):
    """state = last login day; emit ``uu_ct``/``back_ct`` rows. ``expire_ms`` must
    exceed the return span, or returns are not seen."""

    def __init__(self, return_days: int = 8, expire_ms: int | None = None):
        self.return_days, self.expire_ms = return_days, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_login_day", "day long")
        self.expiring = (self.last,)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, "ts_ms", "event_id")
        day = _days(pdf["ts_ms"])
        prev = day.shift(1)
        if self.last.exists():
            prev.iloc[0] = self.last.get()[0]
        first = prev.isna() | (prev != day)
        pdf["uu_ct"] = first.astype("int64")
        pdf["back_ct"] = (first & prev.notna() & (day - prev >= self.return_days)).astype("int64")
        self.last.update((int(day.iloc[-1]),))
        self._rearm(pdf["ts_ms"].max())
        out = pdf[first]
        if not out.empty:
            yield out[["uid", "event_id", "ts_ms", "et", "uu_ct", "back_ct"]]

    def close(self) -> None:
        pass


class Retractor(_Expiring):
    """state = the key's last version; a new version first emits the
    stored one with negated measures, then itself (the source job forgets
    a version after 10 s: ``ttl_ms`` in processing time, ``expire_ms`` in
    event time)."""

    def __init__(self, columns: list[str], measures: list[str], ts: str = "ts_ms", tie: str = "seq",
                 state_schema: str = "", ttl_ms: int | None = None, event_time: str | None = None,
                 expire_ms: int | None = None):
        self.columns, self.measures, self.ts, self.tie = columns, measures, ts, tie
        self.state_schema, self.ttl_ms, self.event_time = state_schema, ttl_ms, event_time
        self.expire_ms = expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_version", self.state_schema, self.ttl_ms)
        self.expiring = (self.last,)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.ts, self.tie)[self.columns]
        prev = [self.last.get()] if self.last.exists() else []
        earlier = pd.DataFrame([tuple(p) for p in prev], columns=self.columns)
        before = pd.concat([earlier, pdf.iloc[:-1]], ignore_index=True)
        neg = before.copy()
        for m in self.measures:
            neg[m] = -neg[m]
        neg["is_retraction"] = True
        cur = pdf.copy()
        cur["is_retraction"] = False
        last = pdf.iloc[-1]
        self.last.update(tuple(last[c].item() if hasattr(last[c], "item") else last[c] for c in self.columns))
        self._rearm(pdf[self.ts].max())
        if self.event_time:
            # a retraction keeps the old version's time; once the watermark has
            # passed it, it is late and dropped like any late row (Q6)
            neg = neg[neg[self.ts] >= timerValues.getCurrentWatermarkInMs()]
        out = pd.concat([neg, cur], ignore_index=True)
        if self.event_time:  # each row keeps its own time (a retraction: the old version's)
            out[self.event_time] = pd.to_datetime(out[self.ts], unit="ms")
        yield out

    def close(self) -> None:
        pass


class KeepNewer(StatefulProcessor):
    """state = largest time kept; a record passes only when its time is later than
    that. Micro-batches arrive in order, records within one by ``arrival``, which is not
    the compared time (TTL 1 h in the source job)."""

    def __init__(self, columns: list[str], ts: str, arrival: str, ttl_ms: int | None = None):
        self.columns, self.ts, self.arrival, self.ttl_ms = columns, ts, arrival, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest_ts", "ts long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.arrival, kind="stable")
        seen = pdf[self.ts].cummax().shift(1)
        if self.latest.exists():
            seen = seen.fillna(self.latest.get()[0]).clip(lower=self.latest.get()[0])
        keep = seen.isna() | (pdf[self.ts] > seen)
        stored = max([pdf[self.ts].max(), *([self.latest.get()[0]] if self.latest.exists() else [])])
        self.latest.update((int(stored),))
        out = pdf[keep]
        if not out.empty:
            yield out[self.columns]

    def close(self) -> None:
        pass


class DeviceState(StatefulProcessor):
    """A8 (after F8): per user the distinct payloads seen and the distinct
    values of each device field; emits the running state after every new
    payload (``pv`` and sorted, comma-joined sets).

    State: one map entry per payload and one per field value, so a batch
    reads the payloads it brings and writes only what is new; ``ttl_ms``
    forgets entries not renewed for that long (processing time)."""

    def __init__(self, fields: list[str], ts: str = "ts_ms", ttl_ms: int | None = None):
        self.fields, self.ts, self.ttl_ms = fields, ts, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("payloads", "payload string", "n int", self.ttl_ms)
        self.known = handle.getMapState("field_values", "field string, value string", "n int", self.ttl_ms)
        self.count = handle.getValueState("payload_count", "n long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import json
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.ts, kind="stable")
        pdf = pdf[[self.ts, *self.fields]].astype({f: "object" for f in self.fields})
        pdf = pdf.where(pdf.notna(), None).drop_duplicates(self.fields)  # F8 within the batch
        texts = [json.dumps(p) for p in pdf[self.fields].values.tolist()]
        new = pdf[[not self.seen.containsKey((t,)) for t in texts]]
        if new.empty:
            return
        values: dict[str, set[str]] = {f: set() for f in self.fields}
        for field, value in self.known.keys():
            values[field].add(value)
        n = self.count.get()[0] if self.count.exists() else 0
        out = []
        for rec in new.values.tolist():
            payload = rec[1:]
            self.seen.updateValue((json.dumps(payload),), (1,))
            n += 1
            for f, v in zip(self.fields, payload):
                if v is not None and v not in values[f]:
                    values[f].add(v)
                    self.known.updateValue((f, v), (1,))
            out.append((key[0], int(rec[0]), n, *[",".join(sorted(values[f])) for f in self.fields]))
        self.count.update((n,))
        yield pd.DataFrame(out, columns=["uid", self.ts, "pv", *self.fields])

    def close(self) -> None:
        pass
