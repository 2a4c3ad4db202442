"""Structured Streaming: ingestion, hourly status, and range replacement by micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetmetrics.operators.status import OK_SHARE_THRESHOLD, OK_SHARE_WINDOWED
from fleetmetrics.sources.incremental import delete_range
from fleetmetrics.sources.readings import replace_windows
from fleetmetrics.sources.swap import Journal

LATE = "2 hours"
#: From a micro-batch and its number to the half-open windows of time for which it has all readings.
Windows = Callable[[DataFrame, int], list[tuple[datetime, datetime]]]
_SERIES = ["DeviceId", "LocationId", "SensorTyId", "_sensor_type"]


def once(stream: DataFrame, key: str, ts: str, late: str = LATE) -> DataFrame:
    """Each key once within the time that data may be late."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def readings_stream(spark: SparkSession, root: str, schema: StructType, ts: str = "TimeSpan", late: str = LATE, **options: str) -> DataFrame:
    """New readings of a parquet folder, each ReadId once (S-1): one that comes again while its id is known is dropped, and so is one that is later than ``late``. Options are those of the file source."""
    return once(spark.readStream.schema(schema).options(**options).parquet(root), "ReadId", ts, late)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what has come since the last run, then stop; the checkpoint is the watermark."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def streaming_threshold(stream: DataFrame, lo: float, hi: float | None = None, late: str = LATE) -> DataFrame:
    """Hourly status by the share of good readings; an hour is emitted once it can no longer change (S-2)."""
    value = F.col("Value").cast("double")
    ok = (value >= lo) & (F.lit(True) if hi is None else value <= hi)
    out = stream.withWatermark("LocalTimeSpan", late).groupBy(F.window("LocalTimeSpan", "1 hour").alias("w"), *_SERIES).agg(
        F.avg("Value").cast("double").alias("MeasurementValue"), F.count_if(ok).alias("is_okay"), F.count(F.lit(1)).alias("total_readings"), F.count_if(~ok).alias("Anomalies")
    )
    share = F.col("is_okay") / F.col("total_readings")
    return out.select(*_SERIES, F.col("w.start").alias("LocalTimeSpan"), "MeasurementValue", "is_okay", "total_readings", "Anomalies", F.when(share >= OK_SHARE_THRESHOLD, 1).otherwise(3).alias("StatusCode"))


def streaming_windowed(stream: DataFrame, lo: float, hi: float | None = None, late: str = LATE) -> DataFrame:
    """Hourly duty status: five-minute maxima of a device, then the hour's buckets in bounds (S-3). Gap anomalies need the whole grid and stay in batch."""
    five = stream.withWatermark("LocalTimeSpan", late).groupBy(F.window("LocalTimeSpan", "5 minutes").alias("b"), *_SERIES).agg(F.max("Value").cast("double").alias("v"))
    ok = (F.col("v") > lo) & (F.lit(True) if hi is None else F.col("v") <= hi)
    hour = five.groupBy(F.window(F.window_time("b"), "1 hour").alias("w"), *_SERIES).agg(F.count_if(ok).alias("is_okay"))
    return hour.select(*_SERIES, F.col("w.start").alias("LocalTimeSpan"), "is_okay", F.when(F.col("is_okay") / F.lit(12) >= OK_SHARE_WINDOWED, 1).otherwise(3).alias("StatusCode"))


def replacing(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], ts: str, complete: Windows) -> Callable[[DataFrame, int], None]:
    """For foreachBatch, on a table that is a frame: replace the windows that are declared complete for a micro-batch; other rows of it are added (S-4)."""

    def apply(batch: DataFrame, number: int) -> None:
        out = read()
        for since, until in complete(batch, number):
            out = delete_range(out, ts, since, until)
        write(out.unionByName(batch))

    return apply


def replacing_lake(root: str, complete: Windows, stream: str = "readings", key: str = "ReadId") -> Callable[[DataFrame, int], None]:
    """For foreachBatch: replace the windows that are declared complete for a micro-batch in a lake (S-4).

    ``complete`` gives the half-open windows for which the source says that the batch has all readings, such as whole
    days or hours. Only those are deleted. A reading outside of them, however late, deletes nothing and is added once.
    Only the days concerned are rewritten, together. Each batch is on record by the stream's name and its number, so a
    batch that comes again after a crash changes nothing, and one that was cut short is finished first.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark, run = batch.sparkSession, f"{stream}-{number:012d}"
        journal = Journal(spark, f"{root}/_journal")
        journal.recover([root])
        if journal.is_done(run):
            return
        batch = batch.persist()  # its days are looked up before its rows are written
        try:
            replace_windows(spark, root, batch, complete(batch, number), key, journal, run)
        finally:
            batch.unpersist()

    return apply


def declared(windows: DataFrame, ts: str = "TimeSpan") -> Windows:
    """Windows from a table of declarations (columns since, until): those in which the batch has a reading. They are few, as days or hours are."""

    hour = F.expr("INTERVAL 1 HOUR")
    since, until = (F.col(c).cast("timestamp") for c in ("since", "until"))
    by_hour = windows.select(since.alias("since"), until.alias("until")).where("since < until")
    by_hour = by_hour.withColumn("hour_", F.explode(F.sequence(F.date_trunc("hour", "since"), F.date_trunc("hour", F.col("until") - F.expr("INTERVAL 1 MICROSECOND")), hour)))

    def complete(batch: DataFrame, number: int) -> list[tuple[datetime, datetime]]:
        t = F.col(ts).cast("timestamp")
        seen = batch.groupBy(F.date_trunc("hour", t).alias("hour_")).agg(F.min(t).alias("first_"), F.max(t).alias("last_"))
        hit = by_hour.join(seen, "hour_").where("last_ >= since and first_ < until").select("since", "until")
        return [tuple(r) for r in hit.distinct().collect()]

    return complete
