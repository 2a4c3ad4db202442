"""Incremental loading: keys, ranges, watermarks and the ledger of runs, as frames in and frames out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_LOAD = "2025-10-01 00:00:00"
LOOKBACK_HOURS = 2


def dedup(df: DataFrame, keys: list[str], latest: str, *ties: str) -> DataFrame:
    """One row a key: the latest, ties by the other columns, ascending (L-8)."""
    order = Window.partitionBy(*keys).orderBy(F.col(latest).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return df.withColumn("rank_", F.row_number().over(order)).where("rank_ = 1").drop("rank_")


def new_rows(incoming: DataFrame, target: DataFrame, *key_sets: list[str]) -> DataFrame:
    """Incoming rows whose keys are not in the target yet, one a key (L-9); with several unique keys, those that clash on none.

    Of incoming rows with the same key the least by the other columns, in their order, is kept. A null key is a key like
    any other. Rows are cut to one a key before they are shuffled.
    """
    out = incoming
    for keys in key_sets:
        others = [F.col(f"`{c}`").asc_nulls_last() for c in out.columns if c not in keys] or [F.lit(0)]
        order = Window.partitionBy(*keys).orderBy(*others)
        out = out.withColumn("rank_", F.row_number().over(order)).where("rank_ = 1").drop("rank_")
        known = target.select(*keys).distinct().alias("known_")
        out = out.alias("new_")
        out = out.join(known, _same_named(keys), "left_anti")
    return out


def _same_named(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"new_.`{k}`").eqNullSafe(F.col(f"known_.`{k}`"))
    return out


def write_new(incoming: DataFrame, target: DataFrame, path: str, *key_sets: list[str], ts: str | None = None) -> tuple[int, datetime | None]:
    """Append the new rows; returns their count and latest ``ts``, observed in the write itself (L-4 to L-6, L-12). Insert-ignore: a second run adds nothing."""
    from pyspark.sql import Observation

    seen = Observation()
    rows = new_rows(incoming, target, *key_sets)
    latest = F.max(ts) if ts else F.lit(None).cast("timestamp")
    rows.observe(seen, F.count(F.lit(1)).alias("n"), latest.alias("latest")).write.mode("append").parquet(path)
    return int(seen.get["n"]), seen.get["latest"]


def from_high_water(incoming: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Rows not older than the target's latest; all if the target is empty (L-7). The latest is one row."""
    top = target.agg(F.max(ts).alias("top_"))
    return incoming.join(F.broadcast(top), F.col("top_").isNull() | (F.col(ts) >= F.col("top_"))).drop("top_")


def _range(df: DataFrame, ts: str, lo: datetime | None, hi: datetime | None) -> Column:
    if lo is None or hi is None:
        raise ValueError("both ends of the range are needed")
    if lo >= hi:
        raise ValueError("the range must not be empty")
    if ts not in df.columns or not isinstance(df.schema[ts].dataType, T.TimestampType | T.TimestampNTZType | T.DateType):
        raise ValueError(f"{ts} is no time column")
    kind = df.schema[ts].dataType
    return F.coalesce((F.col(ts) >= F.lit(lo).cast(kind)) & (F.col(ts) < F.lit(hi).cast(kind)), F.lit(False))


def delete_range(target: DataFrame, ts: str, lo: datetime | None, hi: datetime | None) -> DataFrame:
    """Rows outside ``lo <= ts < hi``; those without a time stay (L-10)."""
    return target.where(~_range(target, ts, lo, hi))


def replace_range(target: DataFrame, incoming: DataFrame, ts: str, lo: datetime | None, hi: datetime | None) -> DataFrame:
    """The target with its rows of a half-open range replaced."""
    return delete_range(target, ts, lo, hi).unionByName(incoming)


def is_empty(df: DataFrame) -> DataFrame:
    """One row: whether there are no rows (L-21); at most one row of each partition is read."""
    return df.limit(1).agg((F.count("*") == 0).alias("is_empty"))


def cascade(children: DataFrame, parents: DataFrame, key: str, ts: str, lo: datetime, hi: datetime) -> DataFrame:
    """Child rows whose parent is not deleted with the range (L-11)."""
    return children.join(parents.where(_range(parents, ts, lo, hi)).select(key), key, "left_anti")


def load_window(ledger: DataFrame, now: datetime, lookback_hours: int = 0, first: str = FIRST_LOAD) -> DataFrame:
    """Adds from_utc and to_utc, in whole seconds: from the watermark, or the first load, less the lookback, to ``now`` (L-13)."""
    start = F.date_trunc("second", F.coalesce("LastLoadedAt", F.lit(first).cast("timestamp")))
    return ledger.withColumn("from_utc", start - F.make_dt_interval(hours=F.lit(lookback_hours))).withColumn("to_utc", F.date_trunc("second", F.lit(now)))


def advance(old: Column, succeeded: Column, latest: Column, until: Column, align: str | None = None) -> Column:
    """The next watermark (L-14): unchanged after a failure, else the latest row's time, else the window's end (``align="hour"``: its hour)."""
    end = F.date_trunc("hour", until) if align == "hour" else until
    return F.when(~succeeded, old).otherwise(F.coalesce(latest, end))


def get_watermark(ledger: DataFrame, names: DataFrame, now: datetime) -> DataFrame:
    """The ledger with a running row for each name that has no active one (L-15)."""
    missing = names.join(ledger.where("IsActive"), "IngestionName", "left_anti").distinct()
    fresh = missing.select("IngestionName", F.lit(None).cast("timestamp").alias("LastLoadedAt"), F.lit("RUNNING").alias("LastRunStatus"), F.lit(now).alias("LastRunStartedAt"), F.lit(None).cast("timestamp").alias("LastRunFinishedAt"), F.lit("created on first read").alias("LastRunError"), F.lit(True).alias("IsActive"), F.lit(now).alias("UpdatedAt"))
    return ledger.unionByName(fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ledger.schema.fields]))


def _active(ledger: DataFrame, name: str) -> Column:
    if ledger.where((F.col("IngestionName") == name) & F.col("IsActive")).isEmpty():
        raise ValueError(f"no active ingestion {name!r}")
    return (F.col("IngestionName") == name) & F.col("IsActive")


def _changed(ledger: DataFrame, hit: Column, values: dict[str, Column]) -> DataFrame:
    return ledger.withColumns({c: F.when(hit, v.cast(ledger.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


def mark_started(ledger: DataFrame, name: str, now: datetime) -> DataFrame:
    """The ledger after a run has begun (L-16)."""
    none = F.lit(None)
    return _changed(ledger, _active(ledger, name), {"LastRunStatus": F.lit("RUNNING"), "LastRunStartedAt": F.lit(now), "LastRunFinishedAt": none, "LastRunError": none, "UpdatedAt": F.lit(now)})


def mark_completed(ledger: DataFrame, name: str, now: datetime, succeeded: bool, loaded_at: datetime | None = None, error: str | None = None) -> DataFrame:
    """The ledger after a run has ended (L-17): the watermark moves on success only."""
    moved = F.coalesce(F.lit(loaded_at).cast("timestamp"), "LastLoadedAt") if succeeded else F.col("LastLoadedAt")
    return _changed(ledger, _active(ledger, name), {"LastLoadedAt": moved, "LastRunStatus": F.lit("SUCCESS" if succeeded else "FAILED"), "LastRunFinishedAt": F.lit(now), "LastRunError": F.lit(error), "UpdatedAt": F.lit(now)})


def merge_dimension(target: DataFrame, incoming: DataFrame, key: str = "SensorId", latest: str = "ModifiedAt", mode: str = "ignore") -> DataFrame:
    """The dimension with new keys added (L-19); known ones stay as they are, or with ``mode="upsert"`` take the incoming values."""
    rows = dedup(incoming, [key], latest, *[c for c in incoming.columns if c not in (key, latest)])
    if mode == "ignore":
        return target.unionByName(rows.join(target.select(key), key, "left_anti").select(*target.columns))
    if mode != "upsert":
        raise ValueError("mode must be ignore or upsert")
    return target.join(rows.select(key), key, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def changed_since(df: DataFrame, column: str, cursor) -> DataFrame:
    """One row: the largest value of a column, and whether it differs from a cursor (L-20)."""
    top = F.max(column)
    return df.agg(top.alias("latest"), (~top.eqNullSafe(F.lit(cursor).cast(df.schema[column].dataType))).alias("changed"))
