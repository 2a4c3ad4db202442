"""Facts kept up to date by what is new: stored sums of five minutes merge with those of new readings (F-8, A-3 to A-8).

A run is given the readings that no run before had, late ones too. It adds them up by sensor and five minutes in one scan,
merges that with the stored sums of the same days, and makes those days' facts anew from the sums alone. So no reading is
read twice, however late another one comes. Sums, spans and both fact tables change together (:class:`Journal`).

A day's facts hang on other days in one thing: empty windows count as anomalies only between a series' first and last
reading. So the ends of each series are stored as well; where new readings move one, the day of the old end is made anew.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.functions.timegrid import EPOCH, floor_to
from fleetmetrics.operators import status
from fleetmetrics.operators.dimensions import enrich
from fleetmetrics.plans.facts import facts_of
from fleetmetrics.sources.files import delete, scratch
from fleetmetrics.sources.readings import hand_off, table
from fleetmetrics.sources.swap import Change, Journal, days_of

DAY = 1440
_SERIES = ["rule", "DeviceId", "LocationId", "SensorTyId"]
_PARTITION = "Fecha"


def _date(minute: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), F.floor(minute / DAY).cast("int"))


def merged(sums: DataFrame) -> DataFrame:
    """Sums of the same sensor and five minutes as one."""
    keys = ["rule", "DeviceId", "LocationId", "SensorTyId", "_sensor_type", "SensorId", "b", _PARTITION]
    bounds = [F.first(c, True).alias(c) for c in ("lo", "hi", "win")]
    return sums.groupBy(*keys).agg(F.max("v").alias("v"), F.sum("total").cast("decimal(38,9)").alias("total"), *[F.sum(c).alias(c) for c in ("n", "ok", "bad")], *bounds)


def _sums(readings: DataFrame, dimensions: DataFrame, bound: DataFrame | None) -> DataFrame:
    out = status.bucket_sums(status.ruled(enrich(readings, dimensions, bound)), any_window=False)
    return out.withColumns({"total": F.col("total").cast("decimal(38,9)"), _PARTITION: _date(F.col("b"))})


def _with_stored(spark: SparkSession, new: DataFrame, partials: str, days: list[date], stage: str) -> DataFrame:
    """The sums of days: new ones as they are, which have a row a sensor and five minutes, but merged with the stored ones on days that have some. Only the latter are shuffled."""
    stored = sorted(set(days) & set(days_of(spark, partials, _PARTITION)))
    if not stored:
        return new
    again = F.col(_PARTITION).isin(stored)
    old = table(spark, partials, new.schema).where(again).select(*new.columns)
    return new.where(~again).unionByName(hand_off(merged(old.unionByName(new.where(again))), stage))


def _spans(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*_SERIES).agg(F.min("b").alias("first"), F.max("b").alias("last"))


def _joined_spans(old: DataFrame, new: DataFrame) -> DataFrame:
    """The ends of each series after the new sums, and the old ones as first_ and last_."""
    old = old.select(*_SERIES, F.col("first").alias("first_"), F.col("last").alias("last_"))
    same = [old[c].eqNullSafe(new[c]) for c in _SERIES]
    cond = same[0] & same[1] & same[2] & same[3]
    both = new.join(old, cond, "full_outer")
    pick = [F.coalesce(new[c], old[c]).alias(c) for c in _SERIES]
    return both.select(*pick, F.least("first", "first_").alias("first"), F.greatest("last", "last_").alias("last"), "first_", "last_")


def _anchors(sums: DataFrame, spans: DataFrame) -> DataFrame:
    """Empty windows just before and just behind each day of a series, where it has readings beyond: from and to them gaps are filled."""
    days = sums.where("win is not null").select(*_SERIES, "lo", "hi", "win", _PARTITION).distinct()
    both = spans.select(*[F.col(c).alias(f"{c}_s") for c in _SERIES], "first", "last")
    same = F.lit(True)
    for c in _SERIES:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_s"))
    start = F.datediff(_PARTITION, F.lit(EPOCH).cast("date")) * DAY
    win = F.col("win")
    first, last = floor_to(F.col("first"), win), floor_to(F.col("last"), win)
    before, behind = floor_to(start - 1, win), floor_to(start + DAY, win)
    ends = F.array(F.when(before >= first, before), F.when(behind <= last, behind))
    rows = days.join(both, same).select(*_SERIES, "lo", "hi", "win", F.explode(F.array_compact(ends)).alias("at"))
    return rows.withColumn("at", F.col("at").cast("int")).distinct()


def update_facts(spark: SparkSession, fresh: DataFrame, dimensions: DataFrame, root: str, devices_table: str, readings_table: str, run: str, now: datetime, bound: DataFrame | None = None) -> dict[str, dict]:
    """Bring both fact tables up to date with readings that no run had before, and return what was observed of each table.

    Sums and spans are kept below ``root``. A run of a name that is done changes nothing; one that was cut short is
    finished by the next. ``bound`` as in :func:`enrich`. The facts are those that all readings together would give.
    """
    partials, ends = f"{root}/sums", f"{root}/spans"
    tables = [partials, ends, devices_table, readings_table]
    journal = Journal(spark, f"{root}/journal")
    journal.recover(tables)
    if journal.is_done(run):
        return {}
    stage = scratch(spark, "partials")
    try:
        new = hand_off(_sums(fresh, dimensions, bound), f"{stage}/new")  # the one scan of the readings
        old_spans = table(spark, ends, _spans(new).withColumn(_PARTITION, F.lit(EPOCH).cast("date")).schema).drop(_PARTITION)
        spans = hand_off(_joined_spans(old_spans, _spans(new)), f"{stage}/spans")
        moved = F.array_compact(F.array(F.when(F.col("last") > F.col("last_"), F.col("last_")), F.when(F.col("first") < F.col("first_"), F.col("first_"))))
        touched = new.select(_PARTITION).unionByName(spans.select(F.explode(moved).alias("b")).select(_date(F.col("b")).alias(_PARTITION))).distinct()
        days = sorted(r[0] for r in touched.collect())  # days, not rows
        if not days:
            return {}
        sums = _with_stored(spark, new, partials, days, f"{stage}/sums")
        hours = status.hourly_of(sums.drop(_PARTITION), any_window=False, anchors=_anchors(sums, spans))
        rows = hand_off(status.statuses(hours.where(_date(F.col("h")).isin(days))), f"{stage}/status")
        facts = facts_of(rows, now)
        each = [(d, d) for d in days]
        epoch = date.fromisoformat(EPOCH)
        changes = [
            Change(partials, sums, _PARTITION, each),
            Change(ends, spans.drop("first_", "last_").withColumn(_PARTITION, F.lit(EPOCH).cast("date")), _PARTITION, [(epoch, epoch)]),
            Change(devices_table, facts.devices, _PARTITION, each, {"latest": F.max("LocalTimeSpan").cast("timestamp")}),
            Change(readings_table, facts.readings.withColumn(_PARTITION, F.to_date("LocalTimeSpan")), _PARTITION, each),
        ]
        return journal.replace(run, changes)
    finally:
        delete(spark, stage)
