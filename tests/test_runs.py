"""Runs from window to watermark, made twice."""

import random
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from fleetmetrics.plans import partials, runs, tables
from fleetmetrics.plans.facts import build_facts
from fleetmetrics.sources import readings as lake

SF = "/root/testdata/sf0.001"


def plain(df):
    return sorted(map(str, df.select(sorted(c for c in df.columns if c not in ("ModifiedAt", "Fecha"))).collect()))


def test_ingestion_twice(spark, tmp_path):
    root, table = str(tmp_path / "lake"), str(tmp_path / "readings")
    rows = tables.readings(spark, SF)
    moved = rows.withColumns({c: F.col(c) + F.make_dt_interval(days=F.lit(700)) for c in ("TimeSpan", "LocalTimeSpan")})  # behind the first load
    lake.write_readings(moved, root)
    now = datetime(2027, 6, 1)
    first = runs.ingest_readings(spark, runs.new_ledger(spark), root, table, now)
    entry = first.ledger.first()
    expected = moved.where(F.col("TimeSpan") >= F.lit("2025-10-01 00:00:00").cast("timestamp_ntz"))
    assert first.written[table] == expected.count() > 0
    assert entry.LastRunStatus == "SUCCESS" and entry.LastLoadedAt == expected.agg(F.max("TimeSpan")).first()[0]
    stored = plain(spark.read.parquet(table))
    again = runs.ingest_readings(spark, first.ledger, root, table, now)  # reads the latest once more
    assert again.written[table] == expected.where(F.col("TimeSpan") == F.lit(entry.LastLoadedAt)).count()
    assert plain(spark.read.parquet(table)) == stored and again.ledger.count() == 1
    assert again.ledger.first().LastRunStatus == "SUCCESS" and again.ledger.first().LastLoadedAt == entry.LastLoadedAt
    # What has come into the lake behind the watermark since, and a reading that is there already.
    late = expected.limit(1).withColumns({c: F.lit("2027-01-01 10:00:00").cast("timestamp_ntz") for c in ("TimeSpan", "LocalTimeSpan")})
    lake.write_readings(late.unionByName(late.withColumn("ReadId", F.lit("new"))), root)
    third = runs.ingest_readings(spark, again.ledger, root, table, now)
    got = spark.read.parquet(table)
    assert got.count() == len(stored) + 1 and got.where("ReadId = 'new'").count() == 1
    assert third.ledger.first().LastLoadedAt == datetime(2027, 1, 1, 10)


def test_facts_twice(spark, tmp_path):
    devices, sensors = str(tmp_path / "devices"), str(tmp_path / "sensors")
    rows = tables.readings(spark, "/root/testdata/sf0.01").where(F.col("TimeSpan") < F.lit("2024-01-05").cast("timestamp_ntz"))
    moved = rows.withColumns({c: F.col(c) + F.make_dt_interval(days=F.lit(700)) for c in ("TimeSpan", "LocalTimeSpan")})
    dims, now = tables.dimensions(spark, "/root/testdata/sf0.01"), datetime(2027, 6, 1)
    first = runs.write_facts(spark, runs.new_ledger(spark), moved, dims, devices, sensors, now)
    expected = build_facts(moved, dims, now)
    assert first.written[devices] == expected.devices.count() > 0 and first.written[sensors] == expected.readings.count()
    stored = plain(spark.read.parquet(devices)), plain(spark.read.parquet(sensors))
    assert stored[0] == plain(expected.devices)
    again = runs.write_facts(spark, first.ledger, moved, dims, devices, sensors, now)
    assert (plain(spark.read.parquet(devices)), plain(spark.read.parquet(sensors))) == stored
    assert again.ledger.first().LastLoadedAt == first.ledger.first().LastLoadedAt


def test_incremental_facts_equal_a_rebuild(spark, tmp_path):
    """Four runs with what is new in random order, some readings days late, one run given twice and one cut short: as if all had come at once. Each reading is read once."""
    sf, rng = "/root/testdata/sf0.01", random.Random(4)
    rows = tables.readings(spark, sf).where(F.col("TimeSpan") < F.lit("2024-01-05").cast("timestamp_ntz")).cache()
    dims, now = tables.dimensions(spark, sf), datetime(2027, 6, 1)
    root, devices, sensors = (str(tmp_path / x) for x in ("root", "devices", "sensors"))
    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    part = F.crc32(F.concat("ReadId", F.lit("x"))) % 4
    order = rng.sample(range(4), 4)
    for k in order:
        fresh = rows.where(part == k).mapInArrow(tick, rows.schema)
        update = lambda k=k, fresh=fresh: partials.update_facts(spark, fresh, dims, root, devices, sensors, f"run-{k}", now)
        if k == order[2]:
            with pytest.MonkeyPatch.context() as m:
                m.setattr(partials.Journal, "_apply", lambda self, run: 1 / 0)  # on record, but not in place
                with pytest.raises(ZeroDivisionError):
                    update()
        assert bool(update()) == (k != order[2])
    assert update() == {} and seen.value == rows.count()
    expected = build_facts(rows, dims, now)
    assert plain(spark.read.parquet(devices)) == plain(expected.devices)
    assert plain(spark.read.parquet(sensors).drop("LocalTimeSpan")) == plain(expected.readings)
    assert partials.update_facts(spark, rows.limit(0), dims, root, devices, sensors, "none", now) == {}
    rows.unpersist()


def test_only_stored_days_are_merged(spark, tmp_path, monkeypatch):
    """A second run shares one day with the first: sums of its other day, and those of the first run, are not merged again."""
    rows = tables.readings(spark, SF).where(F.col("TimeSpan") < F.lit("2024-01-04").cast("timestamp_ntz"))
    dims, now, merging, given = tables.dimensions(spark, SF), datetime(2027, 6, 1), partials.merged, []
    monkeypatch.setattr(partials, "merged", lambda sums: given.append({str(r[0]) for r in sums.select("Fecha").distinct().collect()}) or merging(sums))
    root, devices, sensors = (str(tmp_path / x) for x in ("root", "devices", "sensors"))
    noon = F.col("TimeSpan") < F.lit("2024-01-02 12:00:00").cast("timestamp_ntz")
    for k, part in enumerate((noon, ~noon)):
        partials.update_facts(spark, rows.where(part), dims, root, devices, sensors, f"run-{k}", now)
    assert len(given) == 1 and "2024-01-02" in given[0] and "2024-01-03" not in given[0], given
    assert plain(spark.read.parquet(devices)) == plain(build_facts(rows, dims, now).devices)
