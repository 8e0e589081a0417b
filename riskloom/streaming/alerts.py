"""Alerts on a stream: state per series, event-time timers, notifications that fall due by themselves.

A gauge holds its last value until the next reading, so an alert can fall due, repeat and end
between readings. What happens when is a matter of event time alone: a timer stands at the next
moment at which something is due, and fires once the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.alerts import (
    GROUP_INTERVAL_S,
    GROUP_WAIT_S,
    REPEAT_INTERVAL_S,
    RESOLVE_TIMEOUT_S,
    gauge_rule_match,
)
from riskloom.streaming.jobs import WATERMARK, event_time, gauge_readings

US = 1_000_000
#: How long a silent series holds its last reading: until its first repeat, and a timeout more.
SILENCE_S = REPEAT_INTERVAL_S + RESOLVE_TIMEOUT_S

FIRING, RESOLVED = "firing", "resolved"


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


class TimedState:
    """One struct of numbers per key, and one timer at the moment it has to be looked at again."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, *names: str) -> None:
        self._handle = handle
        self._value = handle.getValueState(name, _longs(*names, "timer_ms"))

    def get(self) -> list[int] | None:
        return list(self._value.get()[:-1]) if self._value.exists() else None

    def put(self, row: list[int] | None, due_us: int = 0) -> None:
        """Keep ``row`` and wake up once the watermark has passed ``due_us``; None ends the state."""
        before = self._value.get()[-1] if self._value.exists() else None
        # a timer fires when the watermark is beyond it
        timer = None if row is None else -(-int(due_us) // 1000) - 1
        if before is not None and before != timer and before in [int(t) for t in self._timers()]:
            self._handle.deleteTimer(before)
        if row is None:
            self._value.clear()
            return
        if before != timer:
            self._handle.registerTimer(timer)
        self._value.update((*map(int, row), timer))

    def _timers(self) -> Iterator[int]:
        for batch in self._handle.listTimers():
            yield from batch if isinstance(batch, (tuple, list)) else [batch]


class AlertProcessor(StatefulProcessor):
    """Keeps when a series began to breach, what was sent last, and when it was last heard of.

    Input are closed gauge windows of ``width_s``: readings up to the watermark less that width are
    all known. Within a batch they are put in order of time.
    """

    def __init__(self, keys: list[str], repeat_s: int, silence_s: int, width_s: int) -> None:
        self._names = ["alert", *keys, "severity", "status", "run_start_us", "repeat_no", "sent_at_us"]
        self._repeat, self._silence, self._width = repeat_s * US, silence_s * US, width_s * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._run = TimedState(handle, "run", "start", "next_no", "last", "held", "fired")
        self._severity = handle.getValueState("severity", T.StructType([T.StructField("s", T.StringType())]))

    def _due(self, run: list[int]) -> int:
        start, number, _, held, _ = run
        return start + max(held, number * self._repeat)

    def _until(self, key: tuple, run: list[int] | None, moment: int, out: list[tuple]) -> list[int] | None:
        """What falls due before ``moment``, if no reading comes until then."""
        if run is None:
            return None
        end = run[2] + self._silence
        while (due := self._due(run)) < min(moment, end):
            out.append((*key, self._severity.get()[0], FIRING, run[0], run[1], due))
            run[1], run[4] = run[1] + 1, 1
        return run if end >= moment else self._ended(key, run, end, out)

    def _ended(self, key: tuple, run: list[int], end: int, out: list[tuple]) -> None:
        if run[4]:
            out.append((*key, self._severity.get()[0], RESOLVED, run[0], run[1] - 1, end))

    def _keep(self, run: list[int] | None) -> None:
        if run is None:
            self._severity.clear()
            self._run.put(None)
        else:
            self._run.put(run, min(self._due(run), run[2] + self._silence) + self._width)

    def handleInputRows(  # noqa: N802
        self,
        key: tuple,
        rows: Iterator[pd.DataFrame],
        timerValues: object,  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        readings = pd.concat(list(rows)).sort_values("ts_us")
        run, out = self._run.get(), []
        for r in readings.itertuples():
            ts, held = int(r.ts_us), int(r.for_s) * US
            run = self._until(key, run, ts, out)
            if r.breach and run is None:
                run = [ts, held // self._repeat, ts, held, 0]
                self._severity.update((r.severity,))
            elif r.breach:
                run[2] = ts
            elif run is not None:
                run = self._ended(key, run, ts, out)
        self._keep(run)
        yield pd.DataFrame(out, columns=self._names)

    def handleExpiredTimer(  # noqa: N802
        self,
        key: tuple,
        timerValues: object,  # noqa: N803
        expiredTimerInfo: object,  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        known = timerValues.getCurrentWatermarkInMs() * 1000 - self._width
        out: list[tuple] = []
        self._keep(self._until(key, self._run.get(), known + 1, out))
        yield pd.DataFrame(out, columns=self._names)

    def close(self) -> None:
        pass


def alert_stream(
    readings: DataFrame,
    rules: DataFrame,
    keys: list[str],
    repeat_s: int = REPEAT_INTERVAL_S,
    silence_s: int = SILENCE_S,
    width_s: int = 15,
) -> DataFrame:
    """(alert, keys, severity, status, run_start, repeat_no, sent_at): what is sent, and when.

    ``readings`` are closed gauge windows (ts, keys, metric, value) of ``width_s`` seconds, handed on in
    order of the watermark. An alert is sent when its condition has held for the rule's time, again
    after every ``repeat_s`` from the start of the run, and as resolved when a reading says
    otherwise; each at the moment it is due, also where no reading comes. A series that is silent
    for ``silence_s`` has ended then, and leaves no state. State and work of a series are bounded by
    the clock, whatever the traffic. The state needs the RocksDB store:
    ``jobs.start(..., rocksdb=True)``.
    """
    matched = gauge_rule_match(readings, rules).select(
        "alert",
        *keys,
        "severity",
        "for_s",
        F.coalesce("breach", F.lit(False)).alias("breach"),
        F.unix_micros("ts").alias("ts_us"),
    )
    schema = T.StructType(
        [
            T.StructField("alert", T.StringType()),
            *[matched.schema[k] for k in keys],
            T.StructField("severity", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("run_start_us", T.LongType()),
            T.StructField("repeat_no", T.LongType()),
            T.StructField("sent_at_us", T.LongType()),
        ]
    )
    sent = matched.groupBy("alert", *keys).transformWithStateInPandas(
        AlertProcessor(keys, repeat_s, silence_s, width_s), schema, outputMode="append", timeMode="EventTime"
    )
    return sent.select(
        "alert",
        *keys,
        "severity",
        "status",
        F.timestamp_micros("run_start_us").alias("run_start"),
        "repeat_no",
        F.timestamp_micros("sent_at_us").alias("sent_at"),
    )


def stream_alerts(
    windows: DataFrame,
    rules: DataFrame,
    keys: list[str],
    repeat_s: int = REPEAT_INTERVAL_S,
    silence_s: int = SILENCE_S,
    width_s: int = 15,
) -> DataFrame:
    """``alert_stream`` over the closed windows of ``stream_gauges``, which are ``width_s`` wide."""
    return alert_stream(gauge_readings(windows, keys), rules, keys, repeat_s, silence_s, width_s)


def stream_ratio(
    part: DataFrame,
    whole: DataFrame,
    keys: list[str],
    metric: str,
    ts: str = "ts",
    scale: float = 100.0,
    delay: str = WATERMARK,
    width_s: int = 15,
) -> DataFrame:
    """(ts, keys, metric, value): ``part / whole * scale`` of two streams of readings (ts, keys, value).

    Each side's last value of a window stands for it; closed windows of both sides are then joined,
    and the join keeps a window only until the watermark has passed it, so a series that one
    side does not have leaves no state. A window that only one side has, and a whole of zero, gives no
    reading or a NULL one. Of values at one time the largest counts.
    """

    def last(side: DataFrame, name: str) -> DataFrame:
        timed = event_time(side, ts).withWatermark(ts, delay)
        return timed.groupBy(F.window(ts, f"{width_s} seconds").alias("_w"), *keys).agg(
            F.max(F.struct(ts, "value")).getField("value").alias(name)
        )

    both = last(part, "_part").join(last(whole, "_whole"), ["_w", *keys])
    ratio = F.try_divide("_part", "_whole") * F.lit(float(scale))
    return both.select(F.col("_w.start").alias("ts"), *keys, F.lit(metric).alias("metric"), ratio.alias("value"))


class IncidentProcessor(StatefulProcessor):
    """Keeps the open incident of a series and closes it after its silence."""

    def __init__(self, keys: list[str], timeout_s: int, width_s: int) -> None:
        self._names = [*keys, "first_us", "last_us", "readings"]
        self._timeout, self._width = timeout_s * US, width_s * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = TimedState(handle, "open", "first", "last", "n")

    def _keep(self, now: list[int] | None) -> None:
        self._open.put(now, 0 if now is None else now[1] + self._timeout + self._width)

    def handleInputRows(  # noqa: N802
        self,
        key: tuple,
        rows: Iterator[pd.DataFrame],
        timerValues: object,  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        now, out = self._open.get(), []
        for r in pd.concat(list(rows)).sort_values("first_us").itertuples():
            first, last, n = int(r.first_us), int(r.last_us), int(r.n)
            if now is not None and first - now[1] <= self._timeout:
                now = [now[0], max(now[1], last), now[2] + n]
                continue
            if now is not None:
                out.append((*key, *now))
            now = [first, last, n]
        self._keep(now)
        yield pd.DataFrame(out, columns=self._names)

    def handleExpiredTimer(  # noqa: N802
        self,
        key: tuple,
        timerValues: object,  # noqa: N803
        expiredTimerInfo: object,  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        now, out = self._open.get(), []
        known = timerValues.getCurrentWatermarkInMs() * 1000 - self._width
        if now is not None and now[1] + self._timeout <= known:
            out, now = [(*key, *now)], None
        self._keep(now)
        yield pd.DataFrame(out, columns=self._names)

    def close(self) -> None:
        pass


def stream_incidents(
    firing: DataFrame,
    keys: list[str],
    ts: str = "ts",
    timeout_s: int = RESOLVE_TIMEOUT_S,
    delay: str = WATERMARK,
    width_s: int = 60,
) -> DataFrame:
    """(keys, first_ts, last_ts, readings) of incidents that have closed.

    Readings at most ``timeout_s`` apart are one incident. They are first counted in windows of
    ``width_s``, where a busy series is added up by all tasks; only closed windows, a number bounded
    by the clock, meet in the series' state. An incident is handed on when the watermark has passed
    its last reading by the timeout and a window. Needs the RocksDB store.
    """
    if not 0 < width_s <= timeout_s:
        raise ValueError("windows must not be wider than the timeout")
    windows = (
        event_time(firing, ts)
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{width_s} seconds").alias("_w"), *keys)
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("n"))
        .select(*keys, F.unix_micros("_first").alias("first_us"), F.unix_micros("_last").alias("last_us"), "n")
    )
    schema = T.StructType(
        [*[windows.schema[k] for k in keys], *_longs("first_us", "last_us", "readings").fields]
    )
    closed = windows.groupBy(*keys).transformWithStateInPandas(
        IncidentProcessor(keys, timeout_s, width_s), schema, outputMode="append", timeMode="EventTime"
    )
    return closed.select(
        *keys,
        F.timestamp_micros("first_us").alias("first_ts"),
        F.timestamp_micros("last_us").alias("last_ts"),
        "readings",
    )


class GroupProcessor(StatefulProcessor):
    """Keeps the last interval in which a group had alerts, while the next one can follow it."""

    def __init__(self, keys: list[str], interval_s: int, wait_s: int) -> None:
        self._names = [*keys, "window_us", "first_us", "n", "notify_us"]
        self._interval, self._wait = interval_s * US, wait_s * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._busy = TimedState(handle, "busy", "window")

    def handleInputRows(  # noqa: N802
        self,
        key: tuple,
        rows: Iterator[pd.DataFrame],
        timerValues: object,  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        before = self._busy.get()
        last, out = None if before is None else before[0], []
        for r in pd.concat(list(rows)).sort_values("window_us").itertuples():
            window, first = int(r.window_us), int(r.first_us)
            follows = last is not None and window - last == self._interval
            out.append((*key, window, first, int(r.n), window + self._interval if follows else first + self._wait))
            last = window
        # the interval after the last is known when the watermark has passed its end
        self._busy.put([last], last + 2 * self._interval)
        yield pd.DataFrame(out, columns=self._names)

    def handleExpiredTimer(  # noqa: N802
        self,
        key: tuple,
        timerValues: object,  # noqa: N803
        expiredTimerInfo: object,  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        before = self._busy.get()
        if before is not None and before[0] + 2 * self._interval <= timerValues.getCurrentWatermarkInMs() * 1000:
            self._busy.put(None)
        yield pd.DataFrame([], columns=self._names)

    def close(self) -> None:
        pass


def stream_groups(
    firing: DataFrame,
    keys: list[str],
    ts: str = "ts",
    interval_s: int = GROUP_INTERVAL_S,
    wait_s: int = GROUP_WAIT_S,
    delay: str = WATERMARK,
) -> DataFrame:
    """(keys, window_start, first_ts, n, notify_at): what ``alert_group`` gives, for closed intervals.

    Alerts are counted in intervals by all tasks; a group's state is its last busy interval, and
    ends with the next one. ``keys`` include the alert's name. Needs the RocksDB store.
    """
    windows = (
        event_time(firing, ts)
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{interval_s} seconds").alias("_w"), *keys)
        .agg(F.min(ts).alias("_first"), F.count("*").alias("n"))
        .select(*keys, F.unix_micros("_w.start").alias("window_us"), F.unix_micros("_first").alias("first_us"), "n")
    )
    schema = T.StructType(
        [*[windows.schema[k] for k in keys], *_longs("window_us", "first_us", "n", "notify_us").fields]
    )
    out = windows.groupBy(*keys).transformWithStateInPandas(
        GroupProcessor(keys, interval_s, wait_s), schema, outputMode="append", timeMode="EventTime"
    )
    return out.select(
        *keys,
        F.timestamp_micros("window_us").alias("window_start"),
        F.timestamp_micros("first_us").alias("first_ts"),
        "n",
        F.timestamp_micros("notify_us").alias("notify_at"),
    )
