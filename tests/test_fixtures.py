"""Small cases worked by hand (FIXTURES.md), defined results of edge cases, and plans."""

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetmetrics.functions.schemas import conform, empty
from fleetmetrics.operators import measures, status
from fleetmetrics.operators.rollup import bad_runs, decide, device_status
from fleetmetrics.operators.rules import DECISIONS
from fleetmetrics.plans import registry, tables
from fleetmetrics.sources import incremental, readings as lake
from fleetmetrics.streaming.status import replacing

DAY = "2025-10-01 "
SERIES = "ReadId string, SensorId string, LocalTimeSpan string, Value double"


def base(spark, rows, sensor_type="Corriente"):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], SERIES)
    return df.select("ReadId", "SensorId", F.col("LocalTimeSpan").cast("timestamp_ntz").alias("LocalTimeSpan"), F.col("Value").cast("decimal(19,9)").alias("Value"), F.lit("d1").alias("DeviceId"), F.lit("L1").alias("LocationId"), F.lit("st1").alias("SensorTyId"), F.lit(sensor_type).alias("_sensor_type"))


F1 = [("s1", DAY + "10:00", 1.0), ("s1", DAY + "10:05", 0.2), ("s2", DAY + "10:06", 0.9), ("s1", DAY + "10:12", 0.5), ("s1", DAY + "10:47", 0.3), ("s2", DAY + "10:50", 0.55), ("s1", DAY + "11:05", 2.0)]


@pytest.mark.parametrize(("window", "anomalies"), [(20, [2, 0]), (240, [0, 0])])
def test_windowed_status(spark, window, anomalies):
    rows = status.windowed_status(base(spark, F1), "Corriente", 0.55, None, window).orderBy("LocalTimeSpan").collect()
    assert [(round(r.MeasurementValue, 6), r.total_sensors, r.is_okay, r.StatusCode) for r in rows] == [(0.575, 6, 2, 3), (2.0, 1, 1, 3)]
    assert [r.Anomalies for r in rows] == anomalies


@pytest.mark.parametrize(("values", "hi", "expected"), [([1, 0], None, (1, 2, 1, 1)), ([1, 0, 0], None, (1, 3, 2, 3)), ([0], None, (0, 1, 1, 3)), ([2, 2.1], 2.0, (1, 2, 1, 1))])
def test_threshold_status(spark, values, hi, expected):
    rows = [("s", DAY + f"10:0{i}", float(v)) for i, v in enumerate(values)]
    r = status.threshold_status(base(spark, rows), "Corriente", 1, hi).first()
    assert (r.is_okay, r.total_readings, r.Anomalies, r.StatusCode) == expected


def test_all_decisions(spark):
    cases = list(itertools.product([None, 0, 1], repeat=5))
    known = dict(DECISIONS)
    got = spark.createDataFrame(cases, "A int, P int, T int, E int, H int").select("*", decide().alias("s")).collect()
    assert all(r.s == known.get(tuple(r)[:5], 3) for r in got) and len(got) == 243


def test_device_anomalies(spark):
    rows = [("o1", "d", "L", None, 1), ("o1", "d", "L", None, 1), ("o2", "e", "L", None, 1), ("o2", "e", "L", 2, 1)]
    df = spark.createDataFrame(rows, "OperationId string, DeviceId string, LocationId string, Anomalies bigint, StatusCode int").withColumns({"LocalTimeSpan": F.lit(DAY + "10:00"), "_sensor_type": F.lit("Corriente")})
    assert {r.DeviceId: r.Anomalies for r in device_status(df).collect()} == {"d": None, "e": 2}


def test_runs(spark):
    r = bad_runs(base(spark, F1), 0.55).orderBy("SensorId", "run_start").collect()
    assert [(x.SensorId, x.run_start.minute, x.run_end.minute, x.run_length) for x in r] == [("s1", 5, 47, 3), ("s2", 50, 50, 1)]


def test_range_ends(spark):
    times = ["09:59:59", "10:00:00", "11:00:00", "12:00:00", "12:00:01"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select("t", F.to_timestamp(F.concat(F.lit(DAY), "t")).alias("ts"))
    lo, hi = datetime(2025, 10, 1, 10), datetime(2025, 10, 1, 12)
    assert [r.t for r in lake.between(df, "ts", F.lit(lo), F.lit(hi)).orderBy("ts").collect()] == times[1:4]
    assert [r.t for r in incremental.delete_range(df, "ts", lo, hi).orderBy("ts").collect()] == [times[0], *times[3:]]
    for bad in ((None, hi), (hi, lo), (lo, lo)):
        with pytest.raises(ValueError, match="range"):
            incremental.delete_range(df, "ts", *bad)
    with pytest.raises(ValueError, match="no time column"):
        incremental.delete_range(df, "t", lo, hi)
    twice = incremental.replace_range(incremental.replace_range(df, df.where("false"), "ts", lo, hi), df.where("false"), "ts", lo, hi)
    assert twice.count() == 3


def test_watermark(spark):
    old, top, end = (datetime(2025, 10, d) for d in (1, 2, 3))
    df = spark.createDataFrame([(False, top), (True, top), (True, None)], "ok boolean, latest timestamp")
    got = [r[0] for r in df.select(incremental.advance(F.lit(old), F.col("ok"), F.col("latest"), F.lit(end))).collect()]
    assert got == [old, top, end]


def test_ledger_needs_an_active_row(spark):
    with pytest.raises(ValueError, match="no active"):
        incremental.mark_started(empty(spark, "ingestion_control"), "x", datetime(2025, 1, 1))


def test_write_new_counts_and_ignores_known_keys(spark, tmp_path):
    schema = "k string, ts timestamp"
    first = spark.createDataFrame([("a", datetime(2025, 1, 1)), ("b", datetime(2025, 1, 2))], schema)
    path = str(tmp_path / "t")
    assert incremental.write_new(first, spark.createDataFrame([], schema), path, ["k"], ts="ts") == (2, datetime(2025, 1, 2))
    more = spark.createDataFrame([("b", datetime(2025, 1, 3)), ("c", datetime(2025, 1, 2))], schema)
    assert incremental.write_new(more, spark.read.parquet(path), path, ["k"], ts="ts")[0] == 1
    assert spark.read.parquet(path).count() == 3


def test_write_new_keeps_one_row_a_key(spark, tmp_path):
    """Rows that clash within the batch, on either key; null keys; and the same batch once more."""
    schema, path = "k string, a int, b int", str(tmp_path / "t")
    rows = [("x", 1, 5), ("x", 1, 3), ("y", 1, 2), ("z", 2, 9), (None, 4, 1), (None, 4, 2), (None, 5, 3)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    assert incremental.write_new(df, df.limit(0), path, ["k"], ["a"])[0] == 3
    table = spark.read.schema(schema).parquet(path)
    first = sorted(map(tuple, table.collect()), key=str)
    assert first == sorted([(None, 4, 1), ("x", 1, 3), ("z", 2, 9)], key=str)
    assert incremental.write_new(df, table, path, ["k"], ["a"])[0] == 0
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == first
    plan = incremental.new_rows(df, table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # a hot key is cut to one row before the shuffle


def test_alarm_interval(spark):
    alert = spark.createDataFrame([(1, "x", datetime(2025, 10, 1, 22))], "Id int, Imei string, FechaAbierto timestamp_ntz")
    times = [datetime(2025, 10, 1, 23), datetime(2025, 10, 2, 0, 30), datetime(2025, 10, 2, 4, 59, 59), datetime(2025, 10, 2, 5)]
    events = spark.createDataFrame([("x", t) for t in times], "Imei string, Fecha timestamp_ntz")
    found = measures.alarm_events_of_alerts(alert, events)
    assert sorted(r.Fecha for r in found.collect()) == times[1:3]
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_calendar(spark):
    e = spark.createDataFrame([(1, 5, datetime(2025, 10, 1), datetime(2025, 10, 7), 14.0)], "Id int, Fk_Tienda int, FechaInicio timestamp, FechaFin timestamp, Oportunidad double")
    m = spark.createDataFrame([(1, "SEG", 14.0), (1, "MTO", 7.0)], "Fk_EvaluacionGeneral int, Fk_ModuloEvaluable string, Oportunidad double")
    assert [r.Oportunidad for r in measures.daily_opportunity(e, m, "SEG").collect()] == [2.0] * 7
    assert measures.daily_opportunity(e, m, "SEG", since="2025-10-03", until="2025-10-04").count() == 2
    with pytest.raises(ValueError, match="source"):
        measures.daily_opportunity(e, m, "SEG", "other")


def test_blank_totals(spark):
    none = spark.createDataFrame([], "Fk_Solucion int")
    assert tuple(measures.not_armed_total(none, none).first()) == (None, None, None)


def test_empty_inputs(spark):
    from fleetmetrics.operators.dimensions import enrich

    out = status.hourly_reading_status(enrich(empty(spark, "readings"), empty(spark, "dimensions")))
    assert out.count() == 0 and len(out.columns) == 9
    with pytest.raises(ValueError, match="missing"):
        conform(spark.range(1), "readings")
    with pytest.raises(ValueError, match="unknown family"):
        status.family_status(out, "none")


def test_families_equal_the_single_pass(spark):
    rows = tables.enriched(spark, "/root/testdata/sf0.001")
    whole = sorted(map(str, status.hourly_reading_status(rows).collect()))
    parts = sorted(str(r) for f in ("maquinas_nieve", "maquinas_soda", "cuartos_refrigeracion", "cuartos_congelacion", "luces", "termostatos") for r in status.family_status(rows, f).collect())
    assert whole == parts


@pytest.mark.parametrize(("name", "scans"), [("A-2", 1), ("A-2-long", 1), ("A-2-7-minutes", 1), ("A-2-12-minutes", 1), ("A-9", 1), ("F-1", 1), ("F-7", 1), ("F-8", 1), ("F-8-readings", 1), ("M-11", 1), ("U-1", 2)])
def test_readings_are_scanned_once(spark, name, scans):
    """Counted on the plan that was run: nothing is persisted, and no branch reads the events again."""
    df = registry.queries()[name](spark, "/root/testdata/sf0.01")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert plan.count("events.parquet") == scans and "InMemoryTableScan" not in plan


def test_windows_equal_their_parts(spark):
    """The single pass against the operators that it is made of, with gaps, several sensors and types."""
    rows = tables.enriched(spark, "/root/testdata/sf0.01").where("DeviceId is not null")
    for window, hi, grain, long_windows in ((20, None, "device", "reference"), (240, 60.0, "sensor_type", "flag"), (15, None, "device", "reference"), (35, 80.0, "sensor_type", "reference"), (7, None, "device", "reference"), (12, 60.0, "sensor_type", "flag"), (1, None, "device", "reference"), (150, 60.0, "device", "flag")):
        df = status._with_bounds(rows, None, 10.0, hi, window)
        maxima = status.sensor_maxima(df)
        keys = ["DeviceId"] if grain == "device" else ["DeviceId", "LocationId", "SensorTyId", "_sensor_type"]
        anomalies = status.window_anomalies(status.filled(status.window_counts(df)), 60, long_windows)
        anomalies = anomalies.drop("SensorTyId") if grain == "device" else anomalies
        parts = status.mean_of_maxima(maxima).join(status.duty(status.device_maxima(maxima), keys), ["rule", "h", *keys]).join(anomalies, ["rule", "h", *keys[:1], *keys[2:3]], "left")
        columns = ["DeviceId", "LocationId", "SensorTyId", "h", "is_okay", "StatusCode", "total_sensors", "round(MeasurementValue, 9)", "coalesce(Anomalies, 0L)"]
        got = status.windowed(df, 60, grain, long_windows, window % 5 > 0).selectExpr(*columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, parts.selectExpr(*columns).collect())), window
    for bad in ({"window": 0}, {"period": 7}):
        with pytest.raises(ValueError, match="positive"):
            status.windowed_status(rows, None, 0, None, **bad)


def test_lake_prunes_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_readings(tables.readings(spark, "/root/testdata/sf0.001"), root)
    df = lake.read_readings_range(spark, root, datetime(2024, 1, 10), datetime(2024, 1, 12))
    assert "PartitionFilters: [isnotnull(event_date" in df._jdf.queryExecution().toString()
    assert {r[0].day for r in df.select("event_date").distinct().collect()} <= {10, 11, 12}


def test_lake_replaces_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = tables.readings(spark, "/root/testdata/sf0.001")
    lake.write_readings(rows, root)
    files = lambda day: sorted(p.name for p in (tmp_path / "lake" / f"event_date={day}").glob("*.parquet"))
    since, until = datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 6)
    before, t = files("2024-01-09"), F.col("TimeSpan").cast("timestamp_ntz")
    inside = (t >= F.lit(since).cast("timestamp_ntz")) & (t < F.lit(until).cast("timestamp_ntz"))
    assert before and files("2024-01-11")
    incoming = rows.where(inside & (F.col("Value") > 50)).withColumn("Value", -F.col("Value"))
    lake.replace_readings(spark, root, incoming, since, until)
    got = spark.read.parquet(root).drop("event_date")
    kept = conform(rows.where(~inside).unionByName(incoming), "readings")
    assert sorted(map(str, got.collect())) == sorted(map(str, kept.select(got.columns).collect()))
    assert files("2024-01-09") == before  # other days are not rewritten
    lake.replace_readings(spark, root, rows.limit(0), since, until)
    assert not files("2024-01-11") and spark.read.parquet(root).where(inside).isEmpty()


def test_jdbc_round_trip(spark):
    url, driver = "jdbc:derby:memory:fleet;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.createDataFrame([(i, float(i)) for i in range(100)], "ID int, V double")
    lake.write_jdbc(rows, url, "T", driver)
    back = lake.read_jdbc(spark, url, "T", driver, "ID", (0, 100), 4)
    assert back.rdd.getNumPartitions() == 4 and back.where("ID >= 90").agg(F.sum("V")).first()[0] == 945.0


def test_replace_by_micro_batch(spark):
    old = spark.createDataFrame([(datetime(2025, 1, 1, h), "old") for h in range(4)], "ts timestamp, v string")
    batch = spark.createDataFrame([(datetime(2025, 1, 1, 1), "new"), (datetime(2025, 1, 1, 2), "new")], "ts timestamp, v string")
    kept = []
    replacing(lambda: old, kept.append, "ts", lambda b, n: [(datetime(2025, 1, 1, 1), datetime(2025, 1, 1, 3))])(batch, 0)
    assert [r.v for r in kept[0].orderBy("ts").collect()] == ["old", "new", "new", "old"]
