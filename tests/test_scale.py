"""Forms that hold no group in one task against the plain ones, and what their plans shuffle."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetmetrics.operators import measures, status
from fleetmetrics.operators.rollup import bad_runs, bad_runs_chunked
from fleetmetrics.plans import tables

START = datetime(2025, 10, 1)


def series(spark, rng, n, hours=30):
    rows = []
    while len(rows) < n:  # stretches of bad and good readings, with ties
        bad, at = rng.random() < 0.5, rng.uniform(0, hours * 60)
        rows += [(str(len(rows) + i), rng.choice("ab"), START + timedelta(minutes=int(at + i * rng.choice([0, 1, 7]))), 0.0 if bad else 20.0) for i in range(rng.randint(1, 40))]
    return spark.createDataFrame(rows, "ReadId string, SensorId string, LocalTimeSpan timestamp, Value double").withColumn("DeviceId", F.lit("d")).withColumn("LocalTimeSpan", F.col("LocalTimeSpan").cast("timestamp_ntz"))


def plain(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("chunk", [1, 5, 60])
@pytest.mark.parametrize("keys", [("DeviceId", "SensorId"), ()])
def test_chunked_runs_equal_windows(spark, chunk, keys):
    df = series(spark, random.Random(chunk), 800).cache()
    assert plain(bad_runs_chunked(df, 10.0, keys=keys, chunk_minutes=chunk)) == plain(bad_runs(df, 10.0, keys=keys))
    with pytest.raises(ValueError, match="divide"):
        bad_runs_chunked(df, chunk_minutes=7)


def test_runs_across_hours(spark):
    """By hand: bad from 10:50 to 13:10 with a silent hour in between, and one good reading at 13:11."""
    at = [650, 655, 700, 705, 790, 791, 792]
    df = spark.createDataFrame([(str(m), "s", START + timedelta(minutes=m), 5.0 if m != 791 else 50.0) for m in at], "ReadId string, SensorId string, LocalTimeSpan timestamp, Value double").withColumn("DeviceId", F.lit("d"))
    got = bad_runs_chunked(df, 10.0, within_hour=False, chunk_minutes=30).orderBy("run_start").collect()
    assert [((r.run_start - START).seconds // 60, (r.run_end - START).seconds // 60, r.run_length) for r in got] == [(650, 790, 5), (792, 792, 1)]
    rng = random.Random(5)
    df = series(spark, rng, 600).cache()
    one = bad_runs_chunked(df, 10.0, within_hour=False, chunk_minutes=1)
    assert plain(one) == plain(bad_runs_chunked(df, 10.0, within_hour=False, chunk_minutes=100_000))


def test_an_hour_of_all_devices_is_many_tasks(spark):
    df = spark.range(0, 60_000, 1, 8).select(F.col("id").cast("string").alias("ReadId"), F.lit("s").alias("SensorId"), (F.lit(START) + F.make_dt_interval(secs=F.col("id") * 3 / 50)).cast("timestamp_ntz").alias("LocalTimeSpan"), (F.col("id") % 3).cast("double").alias("Value"))
    df = df.withColumn("DeviceId", F.lit("d"))
    chunks = df.groupBy(F.floor(F.minute("LocalTimeSpan") / 5)).count().agg(F.max("count")).first()[0]
    assert chunks == 5000 and bad_runs_chunked(df, 1.0, keys=(), chunk_minutes=5).count() == 20000


def by_days(evaluations, modules, module, value, since=None, until=None):
    """A row a day, in Python."""
    days = {}
    for i, store, a, b, x in evaluations:
        for k, m, y in modules:
            d = a
            while k == i and m == module and d <= b:
                if (since is None or d >= since) and (until is None or d <= until):
                    days.setdefault((d.date(), store), []).append(x if value == "evaluation" else y)
                d += timedelta(days=1)
    return days


def test_sweep_line_equals_days(spark):
    rng = random.Random(9)
    evaluations = [(i, rng.randrange(4), (a := START + timedelta(days=rng.randrange(60))), a + timedelta(days=rng.randrange(-2, 25)), rng.randrange(700) * 7.0) for i in range(60)]
    modules = [(rng.randrange(70), rng.choice(["SEG", "MTO"]), str(rng.randrange(700) * 7) if rng.random() < 0.8 else "none") for _ in range(150)]
    e = spark.createDataFrame(evaluations, "Id int, Fk_Tienda int, FechaInicio timestamp, FechaFin timestamp, Oportunidad double")
    m = spark.createDataFrame(modules, "Fk_EvaluacionGeneral int, Fk_ModuloEvaluable string, Oportunidad string")
    for source in ("module", "evaluation"):
        for since, until in ((None, None), (START + timedelta(days=10), START + timedelta(days=40))):
            text = lambda d: d and str(d.date())
            got = {(r.Fecha, r.Fk_Tienda): r.Oportunidad for r in measures.daily_opportunity(e, m, "SEG", source, text(since), text(until)).collect()}
            want = by_days(evaluations, modules, "SEG", source, since, until)
            assert got.keys() == want.keys() and len(got) > 20
            for k, xs in want.items():
                numbers = [float(x) / 7 for x in xs if x != "none"]
                assert got[k] is None if not numbers else abs(got[k] - sum(numbers) / len(numbers)) < 1e-9


def test_long_evaluations_shuffle_no_days(spark):
    """The rows that meet in the running sums are two changes an evaluation, be it a week or ten years long."""
    e = spark.range(100).select("id", F.lit(1).alias("Fk_Tienda"), F.lit(START).alias("FechaInicio"), F.lit(START + timedelta(days=3650)).alias("FechaFin"), F.lit(7.0).alias("Oportunidad")).withColumnRenamed("id", "Id")
    m = spark.range(100).select(F.col("id").alias("Fk_EvaluacionGeneral"), F.lit("SEG").alias("Fk_ModuloEvaluable"), F.lit(7.0).alias("Oportunidad"))
    df = measures.daily_opportunity(e, m, "SEG")
    assert df.count() == 3651
    plan = df._jdf.queryExecution().executedPlan().toString()
    tree = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
    assert tree.index("explode(sequence") < tree.index("Exchange")  # days are laid out after all shuffles


@pytest.mark.parametrize("salts", [1, 16])
def test_a_hot_imei(spark, salts):
    """One Imei has half of all events in one night: with salts they are dealt to several tasks, with the same pairs."""
    night = START + timedelta(hours=22)
    events = [("hot", night + timedelta(seconds=3 * i)) for i in range(4000)] + [(f"m{i % 500}", night + timedelta(seconds=i)) for i in range(4000)]
    e = spark.createDataFrame(events, "Imei string, Fecha timestamp").withColumn("Fecha", F.col("Fecha").cast("timestamp_ntz")).repartition(4)
    a = spark.createDataFrame([(k, "hot" if k < 3 else f"m{k}", START + timedelta(hours=9)) for k in range(20)], "Id int, Imei string, FechaAbierto timestamp").withColumn("FechaAbierto", F.col("FechaAbierto").cast("timestamp_ntz"))
    got = measures.alarm_events_of_alerts(a, e, salts=salts)
    want = sorted((k, i, f) for k in range(20) for i, f in events if i == ("hot" if k < 3 else f"m{k}") and START.date() != f.date() and START + timedelta(hours=12) < f < START + timedelta(hours=29))
    assert sorted((r.Id, r.Imei, r.Fecha) for r in got.collect()) == want and len(want) > 3000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = measures.alarm_events_of_alerts(a, e, salts=salts).where("Imei = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks == 1 if salts == 1 else tasks > 2


def test_hourly_shuffles_three_times(spark):
    rows = tables.enriched(spark, "/root/testdata/sf0.001")
    base = rows.limit(0).union(rows).withColumns({"rule": F.lit(0), "lo": F.lit(1.0), "hi": F.lit(None).cast("double"), "win": F.lit(20)})
    plan = status.hourly(base.select(*base.columns))._jdf.queryExecution().executedPlan().toString()
    below = plan.index("LocalTimeSpan")
    assert plan[:below].count("Exchange hash") + plan[below:].count("REPARTITION_BY_COL") <= 3 and plan.count("REPARTITION_BY_COL") == 2
