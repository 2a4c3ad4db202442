"""Streams over tables that are folders of part files, and their gaps."""

import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetmetrics.operators import status
from fleetmetrics.plans import registry
from fleetmetrics.streaming import gaps
from fleetmetrics.streaming import status as streaming

SF = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["S-1", "S-2", "S-3-duty"])
def test_events_in_a_folder(name, spark, tmp_path):
    for path in SF.glob("*.parquet"):
        if path.name != "events.parquet" and path.name.split(".")[0] in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
            shutil.copy(path, tmp_path)
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got, want = (sorted(map(str, registry.queries()[name](spark, str(sf)).collect())) for sf in (tmp_path, SF))
    assert got == want and (got or name != "S-1"), (len(got), len(want))


def readings(spark, rows):
    """(minute, value) of one sensor, or (minute, value, sensor)."""
    rows = [(r[0], float(r[1]), r[2] if len(r) > 2 else "s") for r in rows]
    df = spark.createDataFrame(rows, "m int, Value double, SensorId string")
    at = F.lit("2025-10-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("m"))
    return df.select("SensorId", "Value", at.alias("LocalTimeSpan"), F.lit("d").alias("DeviceId"), F.lit("L").alias("LocationId"), F.lit("t").alias("SensorTyId"), F.lit("Corriente").alias("_sensor_type"))


def streamed(spark, folder, batches, **options):
    for b in batches:
        readings(spark, b).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(readings(spark, batches[0]).schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    out = gaps.streaming_status_with_gaps(stream, 10.0, **options)
    streaming.ingest(out, f"{folder}/out", f"{folder}/state").awaitTermination()
    return {r.LocalTimeSpan.hour + 24 * (r.LocalTimeSpan.day - 1): r for r in spark.read.schema(out.schema).parquet(f"{folder}/out").collect()}


@pytest.mark.parametrize("window", [20, 7, 240])
def test_gaps_equal_batch(spark, tmp_path, window):
    """Several micro-batches, several sensors, hours without a reading, and a window that is no multiple of five: as batch has them up to the last window."""
    rng = random.Random(window)
    rows = sorted((m, rng.choice([5, 9, 11, 50]), rng.choice("ab")) for m in rng.sample([m for m in range(40 * 60) if m // 60 % 5 != 3], 400))
    batches = [rows[:150], rows[150:151], rows[151:300], rows[300:]]
    got = streamed(spark, str(tmp_path), batches, window=window)
    batch = status.windowed_status(readings(spark, rows), None, 10.0, None, window, join_grain="sensor_type").collect()
    limit = max(rows)[0] - 120
    closed = [r for r in batch if (h := r.LocalTimeSpan.hour + 24 * (r.LocalTimeSpan.day - 1)) * 60 + 60 + window <= limit]
    assert len(closed) > 20
    for r in closed:
        g = got[r.LocalTimeSpan.hour + 24 * (r.LocalTimeSpan.day - 1)]
        assert (g.total_sensors, g.is_okay, g.StatusCode, g.Anomalies) == (r.total_sensors, r.is_okay, r.StatusCode, r.Anomalies), (g, r)
        assert abs(g.MeasurementValue - r.MeasurementValue) < 1e-9
    empty = [g for h, g in got.items() if h % 5 == 3]
    assert len(empty) > 3 and all(g.MeasurementValue is None and g.total_sensors == 0 and g.StatusCode == 3 for g in empty)
    assert window == 240 or all(g.Anomalies == 3 for g in empty)


def test_quiet_series_are_forgotten(spark, tmp_path):
    """Another sensor type moves time on; a series that says nothing has rows for three hours more, or for ever."""
    both = lambda df: df.withColumn("SensorTyId", F.col("SensorId"))
    for quiet in (3, None):
        folder = f"{tmp_path}/{quiet}"
        for b in ([(5, 20, "x"), (5, 20, "y")], [(20 * 60, 20, "y")]):
            both(readings(spark, b)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(readings(spark, [(1, 1)]).schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
        out = gaps.streaming_status_with_gaps(stream, 10.0, quiet_hours=quiet)
        streaming.ingest(out, f"{folder}/out", f"{folder}/state").awaitTermination()
        hours = [r.LocalTimeSpan.hour for r in spark.read.schema(out.schema).parquet(f"{folder}/out").where("SensorTyId = 'x'").collect()]
        assert sorted(hours) == list(range(len(hours))) and (len(hours) == 18 if quiet is None else 4 <= len(hours) <= 18)


@pytest.mark.parametrize(("name", "arrivals"), [("S-1", 3), ("S-4", 6)])
def test_arrivals_are_written_by_many_tasks(name, arrivals, spark, tmp_path):
    """Each arrival comes as files of all tasks that read the events, not of one that reads them all."""
    for path in SF.glob("*.parquet"):
        if path.name != "events.parquet":
            shutil.copy(path, tmp_path)
    spark.read.parquet(f"{SF}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    known = set(shared.glob("arriving-*"))
    at_once = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        got = registry.queries()[name](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", at_once)
    assert len(got) == spark.read.parquet(f"{SF}/events.parquet").count()
    (source,) = set(shared.glob("arriving-*")) - known
    assert [len(list(source.glob(f"{k}/*.parquet"))) for k in range(arrivals)] == [4] * arrivals
