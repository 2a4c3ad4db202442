"""Hourly status of sensors: by the share of good readings, or by five-minute maxima and gap-filled windows.

Every operator works on all rules at once: bounds and window lengths are columns ``lo``, ``hi`` and ``win`` beside the
readings, and ``rule`` is part of every key. ``hourly`` reads its input once: readings are added up by sensor and five
minutes, which is before any shuffle; all that hours and windows need is a sum of that. What belongs to an hour of a
device comes together by grouping, not by joins of branches that each read the input again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmetrics.functions.keys import operation_id
from fleetmetrics.functions.schemas import conform
from fleetmetrics.functions.timegrid import floor_to, from_minutes, minute_index
from fleetmetrics.operators.rules import FAMILIES, rule_table

BUCKET = 5
OK_SHARE_THRESHOLD, OK_SHARE_WINDOWED = 0.5, 0.3
_SERIES = ["DeviceId", "LocationId", "SensorTyId", "_sensor_type"]


def _with_bounds(df: DataFrame, sensor_type: str | None, lo: float, hi: float | None, win: int | None) -> DataFrame:
    df = df if sensor_type is None else df.where(F.col("_sensor_type") == sensor_type)
    return df.withColumns({"rule": F.lit(0), "lo": F.lit(float(lo)), "hi": F.lit(hi).cast("double"), "win": F.lit(win).cast("int")})


def _within(value: Column, strict: bool) -> Column:
    return ((value > F.col("lo")) if strict else (value >= F.col("lo"))) & (F.col("hi").isNull() | (value <= F.col("hi")))


def threshold(df: DataFrame, period: int = 60) -> DataFrame:
    """Per rule and series and hour: mean, count of readings in bounds (inclusive), count outside, ok share, status (A-1)."""
    value = F.col("Value").cast("double")
    ok = _within(value, strict=False)
    out = df.groupBy("rule", *_SERIES, floor_to(minute_index(F.col("LocalTimeSpan")), period).alias("h")).agg(
        F.avg("Value").cast("double").alias("MeasurementValue"), F.count_if(ok).alias("is_okay"), F.count("*").alias("total_readings"), F.count_if(~ok).alias("Anomalies")
    )
    share = F.col("is_okay") / F.col("total_readings")
    return out.withColumns({"Promedio": share, "StatusCode": F.when(share >= OK_SHARE_THRESHOLD, 1).otherwise(3)})


def sensor_maxima(df: DataFrame) -> DataFrame:
    """Largest value of each sensor in each five-minute bucket (A-3)."""
    at = floor_to(minute_index(F.col("LocalTimeSpan")), BUCKET).alias("b")
    return df.groupBy("rule", *_SERIES, "SensorId", at).agg(F.max("Value").cast("double").alias("v"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))


def device_maxima(maxima: DataFrame) -> DataFrame:
    """Largest of a device's sensors in each bucket (A-4)."""
    return maxima.groupBy("rule", *_SERIES, "b").agg(F.max("v").alias("v"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))


def duty(device: DataFrame, keys: list[str], period: int = 60) -> DataFrame:
    """Buckets above the lower bound (strictly) and within the upper one, out of all that the period has; missing ones count as not ok (A-5)."""
    out = device.groupBy("rule", *keys, floor_to(F.col("b"), period).alias("h")).agg(F.count_if(_within(F.col("v"), strict=True)).alias("is_okay"))
    return out.withColumn("StatusCode", F.when(F.col("is_okay") / F.lit(period // BUCKET) >= OK_SHARE_WINDOWED, 1).otherwise(3))


def mean_of_maxima(maxima: DataFrame, period: int = 60) -> DataFrame:
    """Mean and number of the sensors' bucket maxima (A-6)."""
    return maxima.groupBy("rule", *_SERIES, floor_to(F.col("b"), period).alias("h")).agg(F.avg("v").alias("MeasurementValue"), F.count("*").alias("total_sensors"))


def window_counts(df: DataFrame) -> DataFrame:
    """Readings and bad readings of each series in each window of ``win`` minutes (A-7)."""
    value = F.col("Value").cast("double")
    bad = (value <= F.col("lo")) | F.coalesce(value > F.col("hi"), F.lit(False))
    return df.groupBy("rule", "DeviceId", "LocationId", "SensorTyId", "win", "lo", floor_to(minute_index(F.col("LocalTimeSpan")), F.col("win")).alias("xw")).agg(F.count("*").alias("row_count"), F.count_if(bad).alias("zero_count"))


def filled(counts: DataFrame) -> DataFrame:
    """Every window from a series' first to its last, with zero counts where nothing was read (A-10, G-1, J-3)."""
    keys = ["rule", "DeviceId", "LocationId", "SensorTyId"]
    span = counts.groupBy(*keys, "win", "lo").agg(F.min("xw").alias("from_"), F.max("xw").alias("to_"))
    every = span.select(*keys, "win", "lo", F.explode(F.sequence("from_", "to_", "win")).alias("xw"))
    found = every.join(counts.drop("win", "lo"), [*keys, "xw"], "left")
    return found.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("row_count", "zero_count")})


def window_anomalies(windows: DataFrame, period: int = 60, long_windows: str = "reference") -> DataFrame:
    """Anomalous windows of each device, sensor type and hour (A-8): empty, all bad, or few with any bad.

    Of windows shorter than two hours at most 3 count. Of longer ones the result is 1 only if as many are anomalous as
    the window has hours; ``long_windows="flag"`` gives 1 for any.
    """
    few = F.col("row_count") < F.col("lo")
    bad = (F.col("row_count") == 0) | (F.col("zero_count") == F.col("row_count")) | (few & (F.col("zero_count") > 0))
    raw = windows.groupBy("rule", "DeviceId", "SensorTyId", "win", floor_to(F.col("xw"), period).alias("h")).agg(F.count_if(bad).alias("raw"))
    return raw.select("rule", "DeviceId", "SensorTyId", "h", _capped(F.col("raw"), F.col("win"), long_windows).alias("Anomalies"))


def _capped(raw: Column, win: Column, long_windows: str) -> Column:
    hours = F.floor(win / 60)
    long = F.least(raw, F.lit(1)) if long_windows == "flag" else (raw == hours).cast("long")
    return F.when(hours > 1, long).otherwise(F.least(raw, F.lit(3))).cast("long")


def _step() -> Column:
    """Minutes of the buckets that readings are added up by first: the greatest common divisor of five and the window's length."""
    return F.when(F.coalesce(F.col("win") % BUCKET, F.lit(0)) == 0, BUCKET).otherwise(1)


def hourly(df: DataFrame, period: int = 60, join_grain: str = "device", long_windows: str = "reference", any_window: bool = True) -> DataFrame:
    """Status of all rules by hour, in one pass: by five-minute maxima and windows where ``win`` is given (A-2), else by share (A-1).

    Columns: rule, series, h, is_okay, total_readings, total_sensors, Promedio, StatusCode, MeasurementValue, Anomalies.
    The period is a multiple of five minutes; windows are of any length, unless ``any_window`` is False, which says that
    they are multiples of five minutes too and saves a grouping. See :func:`windowed` for the grain; devices are not null.

    Three shuffles: of sums by sensor and bucket, which are added up before it; of those to a task for each device and
    day, where buckets, hours and windows come from them; and of hours and windows to a task a device, for gaps.
    """
    return hourly_of(bucket_sums(df, any_window), period, join_grain, long_windows, any_window)


def bucket_sums(df: DataFrame, any_window: bool = True) -> DataFrame:
    """Readings added up by rule, series, sensor and bucket: all that :func:`hourly_of` needs. Sums of disjoint sets of readings add up to those of all."""
    keys, value = ["rule", *_SERIES], F.col("Value").cast("double")
    at, bounds = minute_index(F.col("LocalTimeSpan")), [F.first(c).alias(c) for c in ("lo", "hi", "win")]
    bad = (value <= F.col("lo")) | F.coalesce(value > F.col("hi"), F.lit(False))
    step = _step() if any_window else F.lit(BUCKET)
    return df.where("DeviceId is not null").groupBy(*keys, "SensorId", floor_to(at, step).cast("int").alias("b")).agg(
        F.max("Value").cast("double").alias("v"), F.sum("Value").alias("total"), F.count("*").alias("n"), F.count_if(_within(value, strict=False)).alias("ok"), F.count_if(bad).alias("bad"), *bounds
    )


def hourly_of(sensors: DataFrame, period: int = 60, join_grain: str = "device", long_windows: str = "reference", any_window: bool = True, anchors: DataFrame | None = None) -> DataFrame:
    """:func:`hourly` from sums of buckets. ``anchors`` are windows (rule, DeviceId, LocationId, SensorTyId, lo, hi, win, at) that are known to lie between a series' first and last reading: gaps are filled from and to them too."""
    bounds, totals = [F.first(c).alias(c) for c in ("lo", "hi", "win")], [F.sum(c).alias(c) for c in ("total", "n", "ok", "bad")]
    # A device's day is one task's: no sum below shuffles until hours and windows are all that is left.
    sensors = sensors.withColumn("day", F.floor(F.col("b") / 1440)).repartition("DeviceId", "day")
    at_home, windowed_ = ["rule", "DeviceId", "day", "LocationId", "SensorTyId"], F.col("win").isNotNull()
    place = lambda window, step: F.struct(F.lit(window).alias("window"), floor_to(F.col("b"), step).cast("int").alias("at"))
    both = lambda step: F.explode(F.when(windowed_, F.array(place(False, step), place(True, F.col("win")))).otherwise(F.array(place(False, step))))
    unless_window = lambda c: F.when(~F.col("p.window"), F.col(c)).alias(c)
    if any_window:  # windows from the finer buckets, five minutes from them too
        sensors = sensors.withColumn("p", both(F.lit(BUCKET))).groupBy(*at_home, unless_window("_sensor_type"), unless_window("SensorId"), "p.window", F.col("p.at").alias("b")).agg(F.max("v").alias("v"), *totals, *bounds)
        devices = sensors.groupBy(*at_home, "_sensor_type", "window", "b").agg(F.max("v").alias("v"), F.sum("v").alias("sum_v"), F.count("*").alias("n_v"), *totals, *bounds)
        spans = devices.groupBy(*at_home, "_sensor_type", "window", F.when(F.col("window"), F.col("b")).otherwise(floor_to(F.col("b"), period)).cast("int").alias("at"))
    else:
        devices = sensors.groupBy(*at_home, "_sensor_type", "b").agg(F.max("v").alias("v"), F.sum("v").alias("sum_v"), F.count("*").alias("n_v"), *totals, *bounds)
        spans = devices.withColumn("p", both(F.lit(period))).groupBy(*at_home, unless_window("_sensor_type"), "p.window", "p.at")
    sums = [*totals, F.sum("sum_v").alias("sum_v"), F.sum("n_v").alias("n_v")]
    spans = spans.agg(*sums, F.count_if(_within(F.col("v"), strict=True)).alias("full"), *bounds)
    if anchors is not None:
        empty = {f.name: F.lit(0).cast(f.dataType) for f in spans.schema if f.name in ("total", "n", "ok", "bad", "sum_v", "n_v", "full")}
        anchors = anchors.withColumns(empty | {"day": F.lit(None).cast("long"), "_sensor_type": F.lit(None).cast("string"), "window": F.lit(True)})
        spans = spans.unionByName(anchors.select(*spans.columns))
    # From here on a row is a series' hour or window, so a device's rows are few, however many its readings are. Those that cross midnight come together.
    spans = spans.repartition("DeviceId").groupBy("rule", "DeviceId", "LocationId", "SensorTyId", "_sensor_type", "window", "at").agg(*sums, F.sum("full").alias("full"), *bounds)
    following = F.lead("at").over(Window.partitionBy("rule", "DeviceId", "LocationId", "SensorTyId", "window").orderBy("at"))
    gaps = F.when(F.col("window"), F.sequence("at", F.coalesce(F.col("following") - F.col("win"), "at"), F.col("win"))).otherwise(F.array("at"))
    every = spans.withColumn("following", following).select("*", F.posexplode(gaps).alias("gap", "x")).withColumns({c: F.when(F.col("gap") == 0, F.col(c)).otherwise(0) for c in ("n", "bad")})
    odd = (F.col("n") == 0) | (F.col("bad") == F.col("n")) | ((F.col("n") < F.col("lo")) & (F.col("bad") > 0))
    hours = every.groupBy("rule", "DeviceId", floor_to(F.col("x"), period).alias("h"), "window", "SensorTyId", F.when(~F.col("window"), F.col("LocationId")).alias("LocationId"), "_sensor_type").agg(
        F.count_if(odd & F.col("window")).alias("raw"), *[F.first(c).alias(c) for c in ("total", "n", "ok", "sum_v", "n_v", "full", "win")]
    )
    series = F.collect_list(F.when(~F.col("window"), F.struct("LocationId", "SensorTyId", "_sensor_type", "total", "n", "ok", "sum_v", "n_v", "full")))
    windows = F.collect_list(F.when(F.col("window"), F.struct("SensorTyId", _capped(F.col("raw"), F.col("win"), long_windows).alias("a"))))
    one = hours.groupBy("rule", "DeviceId", "h").agg(series.alias("series"), windows.alias("windows"), F.first("win").alias("win"))
    one = one.select("*", F.explode("series").alias("s"))
    by_device = join_grain == "device"
    mine = F.col("windows") if by_device else F.filter("windows", lambda w: w["SensorTyId"] == F.col("s.SensorTyId"))
    full = F.aggregate("series", F.lit(0).cast("long"), lambda sum_, x: sum_ + x["full"]) if by_device else F.col("s.full")
    one = one.withColumns({"full": full, "w": mine}).select("*", F.explode_outer("w").alias("a"))
    by_share, share = F.col("win").isNull(), F.col("s.ok") / F.col("s.n")
    return one.select(
        "rule", "DeviceId", "h", "s.LocationId", "s.SensorTyId", "s._sensor_type",
        F.when(by_share, F.col("s.ok")).otherwise(F.col("full")).alias("is_okay"),
        F.when(by_share, F.col("s.n")).otherwise(period // BUCKET).alias("total_readings"),
        F.when(~by_share, F.col("s.n_v")).alias("total_sensors"),
        F.when(by_share, share).alias("Promedio"),
        F.when(F.when(by_share, share >= OK_SHARE_THRESHOLD).otherwise(F.col("full") / F.lit(period // BUCKET) >= OK_SHARE_WINDOWED), 1).otherwise(3).alias("StatusCode"),
        F.when(by_share, F.col("s.total").cast("double") / F.col("s.n")).otherwise(F.col("s.sum_v") / F.col("s.n_v")).alias("MeasurementValue"),
        F.when(by_share, F.col("s.n") - F.col("s.ok")).otherwise(F.coalesce("a.a", F.lit(0).cast("long"))).alias("Anomalies"),
    )


def windowed(df: DataFrame, period: int = 60, join_grain: str = "device", long_windows: str = "reference", any_window: bool = True) -> DataFrame:
    """Status by five-minute maxima (A-2): mean of maxima, duty status and window anomalies of each series and hour.

    ``join_grain="device"`` joins status and anomalies on device and hour only, which repeats rows if a device has
    several sensor types under one name; ``"sensor_type"`` keeps the grain.
    """
    out = hourly(df, period, join_grain, long_windows, any_window).drop("Promedio")
    return out.withColumn("total_readings", F.col("total_readings").cast("int"))


def threshold_status(base: DataFrame, sensor_type: str | None = "Corriente", lo: float = 0, hi: float | None = None, period: int = 60) -> DataFrame:
    """A-1 for one sensor type (None: all) and one pair of bounds."""
    out = threshold(_with_bounds(base, sensor_type, lo, hi, None), period)
    return out.withColumn("LocalTimeSpan", from_minutes(F.col("h"))).drop("rule", "h")


def windowed_status(base: DataFrame, sensor_type: str | None = "Corriente", lo: float = 0, hi: float | None = None, window: int = 20, period: int = 60, **options: str) -> DataFrame:
    """A-2 for one sensor type (None: all), one pair of bounds and one window length in minutes. The period is a multiple of the five-minute bucket."""
    if window <= 0 or period <= 0 or period % BUCKET:
        raise ValueError(f"the window must be positive, and the period a multiple of {BUCKET} minutes")
    out = windowed(_with_bounds(base, sensor_type, lo, hi, window), period, any_window=window % BUCKET > 0, **options)
    return out.withColumn("LocalTimeSpan", from_minutes(F.col("h"))).drop("rule", "h")


def ruled(readings: DataFrame, families: list[str] | None = None) -> DataFrame:
    """Enriched readings with the bounds of the rule that each falls under; others are left out. The rule table has a row a rule and device type."""
    kept = readings.join(F.broadcast(rule_table(readings.sparkSession, families)), ["_device_type", "_sensor_type"])
    return kept.where(~F.col("no_defrost") | (F.col("_sensor_name") != "Resistencia de deshielo"))


def statuses(hours: DataFrame, families: list[str] | None = None) -> DataFrame:
    """What :func:`hourly` gives in the columns of the reading status."""
    flags = rule_table(hours.sparkSession, families).select("rule", "as_share", "keep_anomalies").distinct()
    out = hours.join(F.broadcast(flags), "rule").select(
        *_SERIES, "StatusCode", F.when(F.col("as_share"), F.col("Promedio")).otherwise(F.col("MeasurementValue")).alias("MeasurementValue"),
        F.when(F.col("keep_anomalies"), F.col("Anomalies")).alias("Anomalies"), from_minutes(F.col("h")).alias("LocalTimeSpan"),
    )
    return conform(out.withColumn("OperationId", operation_id()), "reading_status")


def hourly_reading_status(readings: DataFrame, families: list[str] | None = None) -> DataFrame:
    """Status of every device, sensor type and hour by the rule table, in one pass over enriched readings (F-1 to F-7)."""
    return statuses(hourly(ruled(readings, families), any_window=False), families)


def family_status(readings: DataFrame, family: str) -> DataFrame:
    """Status of one equipment family."""
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}; known: {', '.join(FAMILIES)}")
    return hourly_reading_status(readings, [family])
