"""End-to-end runs: load window, replace, write, move the watermark. Each can be repeated: a second run changes nothing.

A run that fails marks itself so in the ledger and leaves the watermark where it was. What it writes is put in place all
at once (:class:`Journal`); the next run finishes or throws away what one that was killed has left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from fleetmetrics.functions.schemas import empty
from fleetmetrics.operators.dimensions import enrich
from fleetmetrics.operators.status import hourly_reading_status
from fleetmetrics.plans.facts import facts_of
from fleetmetrics.sources import incremental, keyindex
from fleetmetrics.sources.files import delete, scratch
from fleetmetrics.sources.ledger import FrameLedger, Ledger
from fleetmetrics.sources.readings import DAY, hand_off, read_readings_range, replace_readings, table
from fleetmetrics.sources.swap import Change, Journal

Work = Callable[[datetime, datetime], tuple[datetime | None, dict[str, int]]]


@dataclass
class Run:
    """The ledger after a run, and how many rows it wrote to each table."""

    ledger: DataFrame
    written: dict[str, int]


def _tracked(ledger: DataFrame | FrameLedger | Ledger, name: str, now: datetime, lookback: int, work: Work) -> Run:
    """``work`` on the window of a run, which the ledger knows as started, and then as ended well or not."""
    book = FrameLedger(ledger) if isinstance(ledger, DataFrame) else ledger
    since, until = book.begin(name, now, lookback)
    try:
        latest, written = work(since, until)
    except BaseException as failed:
        book.finish(name, now, False, error=f"{type(failed).__name__}: {failed}"[:1000])
        raise
    book.finish(name, now, True, latest or until)
    return Run(book.frame, written)


def ingest_readings(spark: SparkSession, ledger: DataFrame | FrameLedger | Ledger, lake: str, table_path: str, now: datetime, name: str = "readings") -> Run:
    """Readings of the lake from the watermark to ``now``, both included, replace those of the table; the watermark moves to the latest of them, else to the window's end.

    The table is parquet by day, as the lake is; only the window's days are rewritten. Of readings with one id one is
    written, and none whose id the table has outside the window: summaries of the other days' keys, kept beside the
    table, tell which of those days may have one, and no others are read.
    """

    def work(since: datetime, until: datetime) -> tuple[datetime | None, dict[str, int]]:
        end = until + timedelta(microseconds=1)
        journal = Journal(spark, f"{table_path}/_journal")
        journal.recover([table_path])
        rows = read_readings_range(spark, lake, since, until).drop(DAY)
        index = keyindex.KeyIndex(spark, table_path, DAY, "ReadId")
        index.refresh()
        there = table(spark, table_path, StructType([*rows.schema, StructField(DAY, DateType())]))
        outside = incremental.delete_range(there, "TimeSpan", since, end)
        fresh = index.new_rows(rows, outside)
        replace_readings(spark, table_path, fresh, since, end, journal)
        index.refresh()
        n, latest = read_readings_range(spark, table_path, since, until).agg(F.count("*"), F.max("TimeSpan")).first()
        return latest, {table_path: n}

    return _tracked(ledger, name, now, 0, work)


def write_facts(spark: SparkSession, ledger: DataFrame | FrameLedger | Ledger, readings: DataFrame, dimensions: DataFrame, devices_table: str, readings_table: str, now: datetime, name: str = "facts", bound: DataFrame | None = None) -> Run:
    """Facts of the readings since the watermark less the lookback: the device fact of those hours is replaced, day by day, its sensor-type rows with it.

    Both tables are parquet with a partition a day (``Fecha``), and change together. Statuses are computed once, in one
    pass over the readings, and handed off to both. The window is closed at both ends and its first hour is computed
    whole: so the hour that begins at the window's end is replaced too, which a half-open range would leave. ``bound`` as
    in :func:`enrich`.
    """

    def work(since: datetime, until: datetime) -> tuple[datetime | None, dict[str, int]]:
        since = since.replace(minute=0, second=0, microsecond=0)
        t = F.col("LocalTimeSpan")
        inside = (t >= F.lit(since).cast("timestamp_ntz")) & (t <= F.lit(until).cast("timestamp_ntz"))
        stage = scratch(spark, "status")
        facts = facts_of(hand_off(hourly_reading_status(enrich(readings.where(inside), dimensions, bound)), stage), now)
        journal = Journal(spark, f"{devices_table}/_journal")
        journal.recover([devices_table, readings_table])
        changes = []
        for path, rows in ((devices_table, facts.devices), (readings_table, facts.readings.withColumn("Fecha", F.to_date("LocalTimeSpan")))):
            days = table(spark, path, rows.schema).where((F.col("Fecha") >= F.lit(since.date())) & (F.col("Fecha") <= F.lit(until.date())))
            mine = {"mine": F.count_if(inside), "latest": F.max(F.when(inside, t)).cast("timestamp")}
            changes.append(Change(path, days.where(~inside).unionByName(rows), "Fecha", [(since.date(), until.date())], mine))
        seen = journal.replace(f"{name}-{stage.rsplit('-', 1)[1]}", changes)
        delete(spark, stage)
        return seen[devices_table]["latest"], {path: seen[path]["mine"] for path in seen}

    return _tracked(ledger, name, now, incremental.LOOKBACK_HOURS, work)


def new_ledger(spark: SparkSession) -> DataFrame:
    return empty(spark, "ingestion_control")
