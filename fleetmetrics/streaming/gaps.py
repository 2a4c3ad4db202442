"""Windowed status as a stream, with the windows in which nothing came (S-3 with A-6 and A-8)."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from fleetmetrics.functions.timegrid import from_minutes, minute_index
from fleetmetrics.operators.status import BUCKET, OK_SHARE_WINDOWED
from fleetmetrics.streaming.status import LATE

_SERIES = ["DeviceId", "LocationId", "SensorTyId", "_sensor_type"]
_OUT = "DeviceId string, LocationId string, SensorTyId string, _sensor_type string, h int, MeasurementValue double, total_sensors long, is_okay long, StatusCode int, Anomalies long"
#: Timers and values of :class:`_Closing` need this store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR = 60


class Series:
    """What is known of a series' hours that are still open: the largest value of each sensor and five minutes, readings and bad ones of each window, and the next hour to close."""

    def __init__(self, lo: float, hi: float | None, window: int, state: dict | None) -> None:
        self.lo, self.hi, self.window = lo, hi, window
        self.state = state or {"next": None, "maxima": {}, "windows": {}, "last": None}

    def add(self, sensor: str, minute: int, value: float, n: int, bad: int) -> None:
        """Sums of a sensor's readings from a minute on, of a stretch that lies in one bucket and one window."""
        s, at = self.state, minute - minute % self.window
        if s["next"] is None or at < s["next"]:
            s["next"] = at - at % HOUR
        key = f"{minute - minute % BUCKET} {sensor}"
        s["maxima"][key] = max(value, s["maxima"].get(key, -math.inf))
        have = s["windows"].get(str(at), [0, 0])
        s["windows"][str(at)] = [have[0] + n, have[1] + bad]
        s["first"] = min(at, s.get("first", at))
        s["last"] = max(minute, s["last"] or minute)

    def _starts(self, hour: int) -> range:
        """The windows that begin in an hour."""
        first = -(-hour // self.window) * self.window
        return range(first, hour + HOUR, self.window)

    def closes_at(self, hour: int) -> int:
        """The minute from which nothing of an hour, and of the windows that begin in it, can change."""
        return max([hour + HOUR, *[at + self.window for at in self._starts(hour)]])

    def closed(self, now: int) -> Iterator[tuple]:
        """Rows of the hours that can no longer change, which are then forgotten."""
        s = self.state
        while s["next"] is not None and self.closes_at(s["next"]) <= now:
            hour = s["next"]
            mine = {k: v for k, v in s["maxima"].items() if hour <= int(k.split(" ", 1)[0]) < hour + HOUR}
            device: dict[str, float] = {}
            for k, v in mine.items():
                b = k.split(" ", 1)[0]
                device[b] = max(v, device.get(b, -math.inf))
            okay = sum(v > self.lo and (self.hi is None or v <= self.hi) for v in device.values())
            raw = 0
            for at in self._starts(hour):
                n, bad = s["windows"].pop(str(at), (0, 0))
                raw += at >= s["first"] and (n == 0 or bad == n or (n < self.lo and bad > 0))
            for k in mine:
                del s["maxima"][k]
            hours = self.window // HOUR
            anomalies = int(raw == hours) if hours > 1 else min(raw, 3)
            status = 1 if okay / (HOUR // BUCKET) >= OK_SHARE_WINDOWED else 3
            yield hour, sum(mine.values()) / len(mine) if mine else None, len(mine), okay, status, anomalies
            s["next"] = hour + HOUR


class _Closing(StatefulProcessor):
    """A series' hours, closed by timers of event time."""

    def __init__(self, lo: float, hi: float | None, window: int, quiet_hours: int | None) -> None:
        self.given, self.window, self.quiet = (lo, hi, window), window, quiet_hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("series", "series string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        series, began = self._series()
        for frame in rows:
            for sensor, minute, v, n, b in zip(frame["SensorId"], frame["minute"], frame["v"], frame["n"], frame["bad"], strict=True):
                if v == v:  # a null is no value
                    series.add(sensor, int(minute), float(v), int(n), int(b))
        yield self._advance(key, series, began, timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._advance(key, *self._series(), timerValues)

    def _series(self) -> tuple[Series, int | None]:
        series = Series(*self.given, json.loads(self.kept.get()[0]) if self.kept.exists() else None)
        return series, series.state["next"]

    def _advance(self, key: tuple, series: Series, began: int | None, times: TimerValues) -> pd.DataFrame:
        now = times.getCurrentWatermarkInMs() // 60000
        out = [(*key, *row) for row in series.closed(now)]
        s = series.state
        if s["next"] is None or (self.quiet is not None and not s["maxima"] and s["next"] > s["last"] + self.quiet * HOUR):
            self.kept.clear()
        else:
            self.kept.update((json.dumps(s),))
            self.handle.registerTimer(max(series.closes_at(s["next"]), now + 1) * 60000)
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])
        return frame.astype({"MeasurementValue": "float64"})


def streaming_status_with_gaps(stream: DataFrame, lo: float, hi: float | None = None, window: int = 20, late: str = LATE, quiet_hours: int | None = None) -> DataFrame:
    """Hourly status of each series by five-minute maxima, with window anomalies, once an hour can no longer change.

    Columns as those of A-2 at the grain of the sensor type: the mean and number of the sensors' maxima, is_okay, StatusCode
    and Anomalies. An hour in which nothing came is a row too, without a value and with its windows as anomalies, as soon as
    event time has passed it; ``quiet_hours`` ends that, and forgets the series, after so many hours without a reading. Where
    batch ends a series' grid with its last window, the stream goes on, as it cannot know that no more will come.

    Readings are added up by sensor and minutes within Spark's own state first; a series' state holds those sums of its
    open hours only, as many as sensors and buckets, not readings. Later readings than ``late`` are dropped.
    """
    step, value = math.gcd(BUCKET, window), F.col("Value").cast("double")
    bad = (value <= lo) | (F.lit(False) if hi is None else value > hi)
    known = stream.withWatermark("LocalTimeSpan", late).where("DeviceId is not null")
    sums = known.groupBy(F.window("LocalTimeSpan", f"{step} minutes").alias("w"), *_SERIES, "SensorId").agg(F.max(value).alias("v"), F.count("*").alias("n"), F.count_if(bad).alias("bad"))
    rows = sums.select(*_SERIES, "SensorId", minute_index(F.col("w.start")).alias("minute"), "v", "n", "bad")

    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    hours = rows.groupBy(*_SERIES).transformWithStateInPandas(_Closing(lo, hi, window, quiet_hours), _OUT, "Append", "EventTime")
    return hours.select(*_SERIES, from_minutes(F.col("h")).cast("timestamp").alias("LocalTimeSpan"), F.when(F.col("total_sensors") > 0, F.col("MeasurementValue")).alias("MeasurementValue"), "total_sensors", "is_okay", "StatusCode", "Anomalies")
