"""Replacement by windows and days, key summaries, the durable ledger, and runs that are cut short."""

import threading
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetmetrics.plans import runs, tables
from fleetmetrics.sources import files, incremental, keyindex, ledger, swap
from fleetmetrics.sources import readings as lake
from fleetmetrics.streaming import status as streaming

SCHEMA = "ReadId string, SensorId string, TimeSpan timestamp, LocalTimeSpan timestamp, Value decimal(19,9)"
START = datetime(2025, 10, 1)


def some(spark, n, value=0, first=0, step=timedelta(minutes=1)):
    t = F.lit(START) + F.make_dt_interval(secs=F.col("id") * int(step.total_seconds()))
    return spark.range(first, first + n).select(F.col("id").cast("string").alias("ReadId"), F.lit("s").alias("SensorId"), t.alias("TimeSpan"), t.alias("LocalTimeSpan"), F.lit(value).cast("decimal(19,9)").alias("Value"))


def values(spark, root):
    return {r.ReadId: int(r.Value) for r in spark.read.parquet(root).collect()}


def test_a_late_reading_deletes_nothing(spark, tmp_path):
    """The verdict's case: a lake of 10,000 readings, and a batch with the first and the last of them only."""
    root = str(tmp_path / "lake")
    lake.write_readings(some(spark, 10000), root)
    apply = streaming.replacing_lake(root, lambda batch, n: [])
    batch = some(spark, 10000).where("ReadId in ('0', '9999')").unionByName(some(spark, 1, 7, 20000))
    apply(batch, 0)
    assert values(spark, root) == {str(i): 0 for i in range(10000)} | {"20000": 7}
    apply(batch.withColumn("Value", F.lit(9).cast("decimal(19,9)")), 0)  # the same batch again
    assert values(spark, root)["20000"] == 7


def test_declared_windows(spark, tmp_path):
    """Whole hours of a day are replaced, a reading of another hour is added, and what the day has besides stays."""
    root = str(tmp_path / "lake")
    lake.write_readings(some(spark, 3 * 1440), root)
    hour = spark.createDataFrame([(START + timedelta(hours=30), START + timedelta(hours=31)), (START + timedelta(hours=60), START + timedelta(hours=61))], "since timestamp, until timestamp")
    batch = some(spark, 10, 5, 30 * 60).unionByName(some(spark, 1, 6, 90000, timedelta(seconds=1)).withColumn("ReadId", F.lit("late")))
    streaming.replacing_lake(root, streaming.declared(hour))(batch, 3)
    want = {str(i): 0 for i in range(3 * 1440) if not 1800 <= i < 1860} | {str(i): 5 for i in range(1800, 1810)} | {"late": 6}
    assert values(spark, root) == want
    other = sorted(p.name for p in (tmp_path / "lake" / "event_date=2025-10-03").glob("*.parquet"))
    streaming.replacing_lake(root, streaming.declared(hour))(some(spark, 1, 8, 1800), 4)
    assert sorted(p.name for p in (tmp_path / "lake" / "event_date=2025-10-03").glob("*.parquet")) == other
    with pytest.raises(ValueError, match="empty"):
        lake.replace_windows(spark, root, batch, [(START, START)])


def test_many_batches_equal_one(spark, tmp_path):
    """A stream of several files, stopped after its second micro-batch by a failure and started again, equals batch."""
    root, source = str(tmp_path / "lake"), str(tmp_path / "source")
    lake.write_readings(some(spark, 5 * 1440, 1), root)
    rows = some(spark, 5 * 1440, 2).where("ReadId % 7 != 0")
    for k in range(5):
        rows.where(F.col("ReadId").cast("int").between(k * 1440, k * 1440 + 1439)).coalesce(1).write.mode("append").parquet(source)
    days = [(START + timedelta(days=k), START + timedelta(days=k + 1)) for k in range(5)]
    declared = streaming.declared(spark.createDataFrame(days, "since timestamp, until timestamp"))
    done = []

    def failing(batch, n):
        if n == 2 and not done:
            done.append(n)
            streaming.replacing_lake(root, declared)(batch, n)  # written, but Spark does not learn of it
            raise RuntimeError("killed")
        streaming.replacing_lake(root, declared)(batch, n)

    def start():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(source)
        stream.writeStream.foreachBatch(failing).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="killed"):
        start()
    start()
    assert values(spark, root) == {str(i): 2 for i in range(5 * 1440) if i % 7}


class Killed(BaseException):
    pass


@pytest.mark.parametrize("at", range(9))
def test_tables_change_together(spark, tmp_path, monkeypatch, at):
    """Killed at any move or deletion: after the next run's start both tables are old or both are new."""
    day = lambda n: date(2025, 10, n)
    frame = lambda rows: spark.createDataFrame(rows, "k int, day date")
    paths = [str(tmp_path / "parent"), str(tmp_path / "child")]
    for p in paths:
        frame([(1, day(1)), (2, day(2)), (3, day(3))]).write.partitionBy("day").parquet(p)
    state = lambda: [sorted(map(tuple, spark.read.parquet(p).collect())) for p in paths]
    old, new = [(1, day(1)), (2, day(2)), (3, day(3))], [(1, day(1)), (20, day(2)), (40, day(4))]
    changes = [swap.Change(p, frame([(20, day(2)), (40, day(4))]), "day", [(day(2), day(4))]) for p in paths]
    count = {"n": 0}

    def counted(f):
        def run(*args):
            count["n"] += 1
            if count["n"] == at + 1:
                raise Killed
            return f(*args)

        return run

    with monkeypatch.context() as m:
        for name in ("move", "delete", "publish"):
            m.setattr(swap.files, name, counted(getattr(files, name)))
        try:
            swap.Journal(spark, str(tmp_path / "journal")).replace("run", changes)
        except Killed:
            pass
    swap.Journal(spark, str(tmp_path / "journal")).recover(paths)
    assert state() in ([old, old], [new, new]) and (at or state() == [old, old])
    assert not [n for p in paths for n in files.names(spark, p) if n.startswith("_staged")]
    swap.Journal(spark, str(tmp_path / "journal")).replace("run", changes)
    assert state() == [new, new]
    with pytest.raises(ValueError, match="days that are not"):
        swap.Journal(spark, str(tmp_path / "journal")).replace("bad", [swap.Change(paths[0], frame([(9, day(9))]), "day", [(day(2), day(4))])])
    assert state() == [new, new]


def test_key_summaries(spark, tmp_path):
    """Known keys of other days are found, only days that may have them are read, and changed days are summed up anew."""
    root = str(tmp_path / "lake")
    lake.write_readings(some(spark, 4 * 1440), root)
    index = keyindex.KeyIndex(spark, root, lake.DAY, "ReadId")
    assert len(index.refresh()) == 4 and index.refresh() == []
    incoming = some(spark, 100, 1, 10000).unionByName(some(spark, 5, 2, 1500)).unionByName(some(spark, 5, 3, 1500)).repartition(3)
    got = index.new_rows(incoming)
    assert sorted(int(r.ReadId) for r in got.collect()) == list(range(10000, 10100))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "event_date IN (2025-10-02)" in plan or "event_date#" in plan and "2025-10-02" in plan and "2025-10-03" not in plan, plan
    assert "lake" not in index.new_rows(some(spark, 10, 1, 20000))._jdf.queryExecution().optimizedPlan().toString().replace("lake/_keys", "")
    lake.write_readings(got, root)
    assert index.refresh() == [date(2025, 10, 7), date(2025, 10, 8)] or len(index.refresh()) == 0
    assert index.new_rows(incoming).count() == 0


def test_a_false_hit_loses_no_row(spark, tmp_path, monkeypatch):
    """A filter that has every key: all days are read, and the result is the same. So it is without any summary."""
    root = str(tmp_path / "lake")
    lake.write_readings(some(spark, 3 * 1440), root)
    index = keyindex.KeyIndex(spark, root, lake.DAY, "ReadId")
    incoming = some(spark, 50, 1, 4300)
    want = list(range(4320, 4350))
    assert sorted(int(r.ReadId) for r in index.new_rows(incoming).collect()) == want
    with monkeypatch.context() as m:
        m.setattr(keyindex, "_bits", lambda h: F.lit(0).cast("long"))
        index.refresh()
        assert len(index.suspected(incoming.select("ReadId"))[1]) == 3
        assert sorted(int(r.ReadId) for r in index.new_rows(incoming).collect()) == want


def test_two_runs_that_start_at_once(spark, tmp_path):
    """Exactly one is given the window; the other once the first has ended, or is taken for dead."""
    store = ledger.Ledger(spark, str(tmp_path / "ledger"), stale=timedelta(hours=1))
    now, got = datetime(2026, 1, 1), []

    def begin():
        try:
            got.append(ledger.Ledger(spark, store.root, store.stale).begin("readings", now))
        except ledger.Busy:
            got.append(None)

    threads = [threading.Thread(target=begin) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(map(bool, got)) == [False, False, False, True]
    with pytest.raises(ledger.Busy):
        store.begin("readings", now + timedelta(minutes=59))
    assert store.begin("other", now)  # another pipeline may run
    assert store.begin("readings", now + timedelta(hours=1))
    store.finish("readings", now, True, now, None)
    row = store.frame.where("IngestionName = 'readings'").first()
    assert (row.LastLoadedAt, row.LastRunStatus) == (now, "SUCCESS") and store.frame.count() == 2
    assert store.begin("readings", now + timedelta(hours=2))[0] == now
    version = store.load()[0]
    assert not store.store(store.frame, version - 1)
    store.prune(1)
    assert store.load()[0] == version


def test_a_failed_run_says_so(spark, tmp_path, monkeypatch):
    store = ledger.Ledger(spark, str(tmp_path / "ledger"))
    root, table = str(tmp_path / "lake"), str(tmp_path / "readings")
    lake.write_readings(some(spark, 100), root)
    now = datetime(2025, 11, 1)
    with monkeypatch.context() as m:
        m.setattr(runs, "replace_readings", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.ingest_readings(spark, store, root, table, now)
    row = store.frame.first()
    assert row.LastRunStatus == "FAILED" and "ZeroDivisionError" in row.LastRunError and row.LastLoadedAt is None
    assert runs.ingest_readings(spark, store, root, table, now).written == {table: 100}
    assert store.frame.first().LastRunStatus == "SUCCESS" and store.frame.first().LastRunError is None
    assert runs.ingest_readings(spark, store, root, table, now).written == {table: 1}  # the latest once more
    assert spark.read.parquet(table).count() == 100


def test_a_fact_run_reads_the_readings_once(spark, tmp_path):
    """Counted by an accumulator in the readings' own plan."""
    sf = "/root/testdata/sf0.001"
    seen = spark.sparkContext.accumulator(0)
    path = str(tmp_path / "r")
    rows = tables.readings(spark, sf)
    rows.withColumns({c: F.col(c) + F.make_dt_interval(days=F.lit(700)) for c in ("TimeSpan", "LocalTimeSpan")}).write.parquet(path)

    def tick(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table = spark.read.parquet(path)
    counted = table.mapInArrow(tick, table.schema)
    devices, sensors = str(tmp_path / "devices"), str(tmp_path / "sensors")
    run = runs.write_facts(spark, runs.new_ledger(spark), counted, tables.dimensions(spark, sf), devices, sensors, datetime(2027, 6, 1))
    assert run.written[devices] > 0 and seen.value == table.count()
    keys = lambda p: {r[0] for r in spark.read.parquet(p).select("OperationId").collect()}
    assert keys(devices) == keys(sensors) and run.written[sensors] == spark.read.parquet(sensors).count()


def test_jdbc_stretches_of_skewed_keys(spark):
    """Nine rows in ten in a tenth of the keys, and some without a key: no partition has twice the mean, and no row is lost."""
    url, driver, name = "jdbc:derby:memory:skew;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver", "SKEWED"
    rows = spark.range(20000).select(F.when(F.col("id") % 10 > 0, F.col("id") / 20).otherwise(F.col("id") * 50 + 1000).cast("long").alias("K"), F.col("id").alias("V"))
    rows = rows.unionByName(spark.createDataFrame([(None, -1), (None, -2)], "K long, V long"))
    lake.write_jdbc(rows.coalesce(2), url, name, driver)
    back = lake.read_jdbc(spark, url, name, driver, "K", partitions=8)
    sizes = [r[0] for r in back.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * 20000 / 8 and sum(sizes) == 20002
    assert sorted(r.V for r in back.select("V").collect()) == sorted(r.V for r in rows.select("V").collect())
    with pytest.raises(Exception, match="NOPE"):
        lake.read_jdbc(spark, url, "NOPE", driver, "K")
    spark.createDataFrame([], "K long, V long").coalesce(1).write.jdbc(url, "EMPTY1", properties={"driver": driver})
    assert lake.read_jdbc(spark, url, "EMPTY1", driver, "K").count() == 0


def test_keys_within_an_incoming_batch(spark, tmp_path):
    rows = some(spark, 5).unionByName(some(spark, 5, 3)).withColumn("ReadId", F.when(F.col("ReadId") == "1", None).otherwise(F.col("ReadId")))
    index = keyindex.KeyIndex(spark, str(tmp_path / "none"), lake.DAY, "ReadId")
    got = index.new_rows(rows).collect()
    assert sorted(map(str, got)) == sorted(map(str, incremental.new_rows(rows, rows.limit(0), ["ReadId"]).collect())) and len(got) == 5
