"""Stateful operators whose result does not depend on the order of arrival.

Rows of a key wait in the state until the watermark has passed them.  Each
micro-batch puts its rows in their places by event time and gives out every
result that they change; a changelog reader takes the latest row per key
(``deleted`` rows take one back).  So results are complete after any batch,
without an end-of-input marker, and the watermark only bounds the state: of the
rows behind it only those stay that later results need, rows that arrive later
still are late (dropped by the engine, which counts them:
``core.Changelog.late_rows``).

A call into Python and its state reads cost the same for one row as for
thousands, and most keys have few rows.  So the state store's key is one of
BUCKETS buckets of keys, and all work on the rows of a bucket's keys is in numpy
arrays.  The state of a bucket is one Arrow table: its keys' rows of the last
watermark delay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import BinaryType, DataType, StringType, StructField, StructType

BUCKETS = 512
NOT_KNOWN = -(1 << 63)


def _state(**fields: DataType) -> StructType:
    """A state schema, built without the JVM (workers have none)."""
    out = StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


def run_processor(df: DataFrame, keys: Sequence[str], ts: str, watermark: str, columns: dict[str, Column],
                  processor: _Bucketed, out: str) -> DataFrame:
    """``processor`` on the rows of each key, given the event time ``us`` (whole
    microseconds) and ``columns``; rows without an event time are left out.
    ``out`` (DDL) follows the keys."""
    keys = list(keys)
    # keys travel as text: a NULL among whole numbers would make them floats in pandas
    d = df.where(F.col(ts).isNotNull()).withWatermark(ts, watermark) \
        .select(F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket"),
                *[F.col(k).cast("string").alias(f"key{i}") for i, k in enumerate(keys)],
                ts, F.unix_micros(ts).alias("us"), *[c.alias(n) for n, c in columns.items()])
    processor.keys = [f"key{i}" for i in range(len(keys))]
    schema = StructType([*(StructField(k, StringType()) for k in processor.keys), *StructType.fromDDL(out).fields])
    processor.out = schema.names
    r = d.groupBy("bucket").transformWithStateInPandas(processor, schema, "Update", "EventTime")
    return r.select(*[F.col(f"key{i}").cast(df.schema[k].dataType).alias(k) for i, k in enumerate(keys)],
                    *schema.names[len(keys):])


def _codes(columns: Sequence[np.ndarray], n: int) -> np.ndarray:
    """Small numbers of the keys of ``n`` rows: equal for equal keys, NULL like a value."""
    code = np.zeros(n, np.int64)
    for c in columns:
        own, values = pd.factorize(c)
        code = pd.factorize(code * (len(values) + 1) + own + 1)[0].astype(np.int64)
    return code


def _starts(code: np.ndarray) -> np.ndarray:
    """Marks the first row of each key (rows are sorted by key)."""
    return np.append(True, code[1:] != code[:-1])


def _last_marked(mark: np.ndarray) -> np.ndarray:
    """For each place the nearest marked place at or before it (the first is marked)."""
    return np.maximum.accumulate(np.where(mark, np.arange(len(mark)), 0))


def _since_new(code: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Marks each key's rows from its first new one on."""
    n = np.cumsum(new)
    return n > (n - new)[_last_marked(_starts(code))]


class _Bucketed(StatefulProcessor):
    """Base of operators over the rows of all keys of a bucket.

    A subclass gives ``columns`` (their types, and the value in a new row of
    those that only the state has), the ``order`` of a key's rows and ``step``:
    from the rows sorted by key, the marks of new ones and the watermark it makes
    the results with their rows' places, the places to keep with what changes in
    them, and the event time after which it wants to be called (or None)."""

    keys: list[str] = []
    out: list[str] = []
    columns: dict[str, tuple] = {}
    order: tuple[str, ...] = ("us",)

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", _state(rows=BinaryType()))

    def _held(self) -> dict[str, np.ndarray] | None:
        held = self.state.get() if self.state.exists() else None
        if held is None:
            return None
        t = pa.ipc.open_stream(bytes(held[0])).read_all()
        return {c: t.column(c).to_numpy() for c in t.column_names}

    def _keep(self, rows: dict[str, np.ndarray]) -> None:
        if not len(rows["us"]):
            self.state.clear()
            return
        t = pa.table({c: pa.array(v, pa.string()) if v.dtype == object else pa.array(v) for c, v in rows.items()})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema) as w:
            w.write_table(t)
        self.state.update((sink.getvalue().to_pybytes(),))

    def _run(self, frames: list[pd.DataFrame], now: int) -> Iterator[pd.DataFrame]:
        held = self._held()
        n_held, n_new = len(held["us"]) if held else 0, sum(len(f) for f in frames)
        if not n_held + n_new:
            return
        rows = {}
        for c, (kind, own) in {**{k: (object, None) for k in self.keys}, **self.columns}.items():
            parts = [held[c]] if held else []
            parts += [f[c].to_numpy() for f in frames] if own is None else [np.full(n_new, own, kind)]
            rows[c] = np.concatenate([p.astype(kind) for p in parts])
        code, new = _codes([rows[k] for k in self.keys], n_held + n_new), np.arange(n_held + n_new) >= n_held
        # the sort is stable: what was held comes first among equals
        order = np.lexsort((*(rows[c] for c in reversed(self.order)), code))
        rows, code, new = {c: v[order] for c, v in rows.items()}, code[order], new[order]
        at, results, keep, changed, call = self.step(rows, code, new, now)
        if len(at):
            yield pd.DataFrame({**{k: rows[k][at] for k in self.keys}, **results})[self.out]
        self._keep({c: changed.get(c, v)[keep] for c, v in rows.items()})
        if call is not None:
            self.handle.registerTimer(int(call) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        yield from self._run(list(rows), timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._run([], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


class MovingStats(_Bucketed):
    """Mean and sample deviation of each reading and the ``n`` - 1 before it."""

    columns = {"us": (np.int64, None), "id": (np.int64, None), "x": (float, None)}
    order = ("us", "id")

    def __init__(self, n: int):
        self.n = n

    def step(self, rows, code, new, now):
        us, x, first = rows["us"], rows["x"], _last_marked(_starts(code))
        at = np.flatnonzero(_since_new(code, new))
        # the window of a key's first rows is filled up with values that count for nothing
        back = at[:, None] - np.arange(self.n - 1, -1, -1)
        w = np.where(back >= first[at, None], x[np.maximum(back, 0)], np.nan)
        count = (~np.isnan(w)).sum(axis=1)
        mean = np.divide(np.nansum(w, axis=1), count, out=np.full(len(w), np.nan), where=count > 0)
        away = np.nansum((w - mean[:, None]) ** 2, axis=1)
        std = np.sqrt(np.divide(away, count - 1, out=np.full(len(w), np.nan), where=count > 1))
        # a key's last n - 1 rows behind the watermark are in windows to come
        passed = np.add.reduceat(us < now, np.flatnonzero(_starts(code)), dtype=np.int64)[np.cumsum(_starts(code)) - 1]
        keep = (us >= now) | (np.arange(len(us)) - first > passed - self.n)
        return (at, {"id": rows["id"][at], "us": us[at], "value": x[at], "ma": mean, "mstd": std}, keep, {},
                us.max() if us.max() >= now else None)


class Bursts(_Bucketed):
    """Rows that are at least the ``least``-th of their key within ``span`` us."""

    columns = {"us": (np.int64, None), "id": (np.int64, None)}
    order = ("us", "id")

    def __init__(self, span: int, least: int):
        self.span, self.least = span, least

    def step(self, rows, code, new, now):
        us = rows["us"]
        # places of (key, time) and of (key, time - span) among the rows' own, both by rank of the time
        times = np.unique(np.concatenate([us, us - self.span]))
        line, low = (code * len(times) + np.searchsorted(times, t) for t in (us, us - self.span))
        n = np.searchsorted(line, line, "right") - np.searchsorted(line, low, "left")
        at = np.flatnonzero(_since_new(code, new) & (n >= self.least))
        keep = us >= now - self.span
        return (at, {"us": us[at], "id": rows["id"][at], "n_in_window": n[at].astype(np.int32)}, keep, {},
                us.max() + self.span if keep.any() else None)


class Transitions(_Bucketed):
    """Changes of a state: previous and new one, and the time in the previous.

    Of the rows behind the watermark each key's last one stays, with the time
    ``since`` when its state holds."""

    columns = {"us": (np.int64, None), "id": (np.int64, None), "x": (object, None), "since": (np.int64, NOT_KNOWN)}
    order = ("us", "id")

    def step(self, rows, code, new, now):
        us, x, first = rows["us"], rows["x"], _starts(code)
        before = np.append(np.array([None], object), x[:-1])
        before[first] = None
        change = ~first & (before != x)
        begun = np.where(first & (rows["since"] != NOT_KNOWN), rows["since"], us)
        since = begun[_last_marked(first | change)]
        # a row that was given out before may be no change any more
        at = np.flatnonzero(_since_new(code, new) & ~first & (change | ~new))
        held = {"id": rows["id"][at], "us": us[at], "previous_state": before[at], "new_state": x[at],
                "seconds_in_previous": (us[at] - since[at - 1]) // 1_000_000, "deleted": ~change[at]}
        waits = us >= now
        last_passed = ~waits & np.append(waits[1:] | first[1:], True)
        return (at, held, waits | last_passed, {"since": np.where(last_passed, since, NOT_KNOWN)},
                us.max() if waits.any() else None)


class Sessions(_Bucketed):
    """Sessions of a key: rows no more than ``gap`` us apart.  State: open
    sessions only; a session is known by its start."""

    columns = {"us": (np.int64, None), "length": (np.int64, 0), "n": (np.int64, 1)}

    def __init__(self, gap: int):
        self.gap = gap

    def step(self, rows, code, new, now):
        start, n = rows["us"], rows["n"]
        last = start + rows["length"]
        # how far a key's rows up to each place reach: a running maximum of (key, rank of the end)
        ends, rank = np.unique(last, return_inverse=True)
        reach = ends[np.maximum.accumulate(code * len(ends) + rank) - code * len(ends)]
        opens = _starts(code)
        opens[1:] |= start[1:] - reach[:-1] > self.gap
        at = np.flatnonzero(opens)
        # by the places of their starts
        end, total, touched = last.copy(), n.copy(), new.copy()
        end[at], total[at] = np.maximum.reduceat(last, at), np.add.reduceat(n, at)
        touched[at] = np.logical_or.reduceat(new, at)
        gone = ~new & ~opens
        out = np.flatnonzero(gone | opens & touched)
        keep = opens & (end + self.gap >= now)
        return (out, {"start": start[out], "last": end[out], "n_events": total[out], "deleted": gone[out]},
                keep, {"length": end - start, "n": total}, end[keep].max() + self.gap if keep.any() else None)


class AckTimer(_Bucketed):
    """Alarms without an answer within ``wait`` us, once the watermark has passed
    that time.  Answers that arrive before their alarm wait for it."""

    columns = {"us": (np.int64, None), "ack": (bool, None)}
    order = ("us", "ack")

    def __init__(self, wait: int):
        self.wait = wait

    def step(self, rows, code, new, now):
        us, ack = rows["us"], rows["ack"]
        # the next answer at or after each row (alarms stand before answers of the same time)
        n = len(us)
        after = np.minimum.accumulate(np.where(ack, np.arange(n), n)[::-1])[::-1]
        some = np.minimum(after, n - 1)
        answered = (after < n) & (code[some] == code) & (us[some] <= us + self.wait)
        waiting = ~ack & ~answered
        at = np.flatnonzero(waiting & (us + self.wait < now))
        waiting &= us + self.wait >= now
        keep = waiting | ack & (us >= now)
        # the first deadline, or when the last answer has no use any more
        calls = [f(v) for f, v in ((np.min, us[waiting] + self.wait), (np.max, us[ack & keep])) if len(v)]
        return at, {"alert_us": us[at], "deadline_us": us[at] + self.wait}, keep, {}, min(calls, default=None)
