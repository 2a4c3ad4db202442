"""Device status from sensor statuses, and runs of bad readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmetrics.functions.timegrid import floor_to, minute_index
from fleetmetrics.operators.rules import CURRENT, DECISIONS, OTHERWISE, POWER, PRESSURE, TEMPERATURE, THERMOSTAT

FLAGS = dict(zip("APTEH", (CURRENT, PRESSURE, TEMPERATURE, POWER, THERMOSTAT), strict=True))


def decide() -> Column:
    """Status code from the five flag columns, by the decision table; nulls match nulls."""
    out = F.when(F.lit(False), 0)
    for flags, status in DECISIONS:
        match = F.lit(True)
        for name, flag in zip(FLAGS, flags, strict=True):
            match = match & (F.col(name).isNull() if flag is None else F.coalesce(F.col(name) == flag, F.lit(False)))
        out = out.when(match, status)
    return out.otherwise(OTHERWISE)


def device_status(readings: DataFrame) -> DataFrame:
    """One status a device and hour: flags of its sensor types (status 1: good, 3: bad) through the decision table; anomalies add up, all null stays null (A-9)."""
    flag = lambda sensor: F.max(F.when(F.col("_sensor_type") == sensor, F.when(F.col("StatusCode") == 1, 1).when(F.col("StatusCode") == 3, 0)))
    grouped = readings.groupBy("OperationId", "DeviceId", "LocationId", "LocalTimeSpan").agg(F.sum("Anomalies").alias("Anomalies"), *[flag(s).alias(n) for n, s in FLAGS.items()])
    return grouped.select("DeviceId", "OperationId", "LocalTimeSpan", decide().alias("StatusCode"), "Anomalies")


def bad_runs(readings: DataFrame, lo: float = 0, hi: float | None = None, keys: tuple[str, ...] = ("DeviceId", "SensorId"), ts: str = "LocalTimeSpan") -> DataFrame:
    """Runs of consecutive bad readings (gaps and islands) within an hour: keys, hour, run_start, run_end, run_length (W-1).

    Ordered by time, ties by ReadId. The reference works on all devices of an hour together; :func:`bad_runs_chunked` does
    that, and runs over many hours, without a task that holds all their readings.
    """
    value = F.col("Value").cast("double")
    bad = (value <= lo) | (F.lit(False) if hi is None else value > hi)
    rows = readings.select(*keys, "ReadId", F.col(ts).alias("ts_"), F.date_trunc("hour", ts).cast("timestamp_ntz").alias("HourStart"), bad.cast("int").alias("bad"))
    order = Window.partitionBy(*keys, "HourStart").orderBy("ts_", "ReadId")
    begun = rows.withColumn("starts", ((F.col("bad") == 1) & (F.coalesce(F.lag("bad").over(order), F.lit(0)) == 0)).cast("int"))
    numbered = begun.withColumn("run", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0))).where("bad = 1")
    return numbered.groupBy(*keys, "HourStart", "run").agg(F.min("ts_").alias("run_start"), F.max("ts_").alias("run_end"), F.count("*").alias("run_length")).drop("run")


def bad_runs_chunked(readings: DataFrame, lo: float = 0, hi: float | None = None, keys: tuple[str, ...] = ("DeviceId", "SensorId"), ts: str = "LocalTimeSpan", within_hour: bool = True, chunk_minutes: int = 60) -> DataFrame:
    """The runs of :func:`bad_runs` in two passes over chunks of time: for few or no keys, and with ``within_hour=False`` across hours.

    Columns: keys, HourStart (if ``within_hour``), run_start, run_end, run_length. The first pass finds the runs inside each
    chunk of ``chunk_minutes`` of a group, in parallel. A run that ends with its chunk's last reading goes on with one that
    begins the next chunk: the second pass joins those, over a few rows a chunk, by groups and days. Chunks that are bad
    throughout carry a run on. An hour of all devices is so many chunks, and a task holds the readings of one at a time.
    """
    if chunk_minutes <= 0 or (within_hour and 60 % chunk_minutes):
        raise ValueError("chunks must divide the hour")
    value = F.col("Value").cast("double")
    bad = (value <= lo) | (F.lit(False) if hi is None else value > hi)
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    groups = [*keys, *(["HourStart"] if within_hour else [])]
    at = floor_to(minute_index(F.col(ts)), chunk_minutes).alias("chunk")
    rows = readings.select(*keys, "ReadId", F.col(ts).alias("ts_"), *([hour.alias("HourStart")] if within_hour else []), at, F.coalesce(bad, F.lit(False)).cast("int").alias("bad"))
    order = Window.partitionBy(*groups, "chunk").orderBy("ts_", "ReadId")
    # The number of good readings so far is the same for all of a run: it numbers the runs of a chunk.
    ranked = rows.withColumn("good", F.sum(1 - F.col("bad")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = F.sum(1 - F.col("bad")).over(Window.partitionBy(*groups, "chunk"))
    parts = ranked.withColumn("goods", sizes).groupBy(*groups, "chunk", "good").agg(
        F.min(F.when(F.col("bad") == 1, F.col("ts_"))).alias("run_start"), F.max(F.when(F.col("bad") == 1, F.col("ts_"))).alias("run_end"), F.sum("bad").alias("run_length"), F.first("goods").alias("goods")
    )
    inner = (F.col("good") > 0) & (F.col("good") < F.col("goods"))
    shape = [*groups, "run_start", "run_end", "run_length"]
    whole = parts.where(inner & (F.col("run_length") > 0)).select(*shape)
    # A chunk's head runs from its start, its tail to its end; one without a good reading is both.
    head = lambda c: F.max(F.when(F.col("good") == 0, F.col(c))).alias(f"head_{c}")
    tail = lambda c: F.max(F.when(F.col("good") == F.col("goods"), F.col(c))).alias(f"tail_{c}")
    fields = ("run_start", "run_end", "run_length")
    edges = parts.where(~inner).groupBy(*groups, "chunk").agg(F.first("goods").alias("goods"), *[f(c) for c in fields for f in (head, tail)])
    return whole.unionByName(_carried(edges, groups).select(*shape))


def _carried(edges: DataFrame, groups: list[str]) -> DataFrame:
    """Runs that touch the ends of chunks: a segment is a tail, the chunks behind it that are bad throughout, and the next head.

    A row a chunk comes here. Each chunk with a good reading closes the segment before it with its head and opens one with
    its tail.
    """
    order = Window.partitionBy(*groups).orderBy("chunk")
    broken = (F.col("goods") > 0).cast("int")
    opened = edges.withColumn("segment", F.coalesce(F.sum(broken).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    part = lambda side, segment: F.struct(segment.alias("segment"), *[F.col(f"{side}_{c}").alias(c) for c in ("run_start", "run_end", "run_length")])
    both = F.when(F.col("goods") > 0, F.array(part("head", F.col("segment") - 1), part("tail", F.col("segment")))).otherwise(F.array(part("head", F.col("segment"))))
    parts = opened.select(*groups, F.explode(both).alias("p")).select(*groups, "p.*").where("run_length > 0")
    return parts.groupBy(*groups, "segment").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), F.sum("run_length").alias("run_length"))
