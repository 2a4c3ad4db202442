"""Time on a grid of minutes since 1970-01-01, as whole numbers: independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def minute_index(ts: Column) -> Column:
    ts = ts.cast("timestamp_ntz")
    return (F.datediff(F.to_date(ts), F.lit(EPOCH).cast("date")) * 1440 + F.hour(ts) * 60 + F.minute(ts)).cast("int")


def from_minutes(minutes: Column) -> Column:
    return F.lit(f"{EPOCH} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))


def floor_to(minutes: Column, step: Column | int) -> Column:
    return minutes - F.pmod(minutes, step if isinstance(step, Column) else F.lit(step))


def bucket(ts: Column, minutes: int) -> Column:
    """Start of the epoch-aligned bucket of so many minutes (G-2)."""
    return from_minutes(floor_to(minute_index(ts), minutes))


def hour(ts: Column) -> Column:
    """Start of the hour (G-3)."""
    return bucket(ts, 60)


def date_parts(df: DataFrame, ts: str) -> DataFrame:
    """Adds Fecha (date) and Hora (HH:mm:ss) of a timestamp column (C-4)."""
    return df.withColumn("Fecha", F.to_date(ts)).withColumn("Hora", F.date_format(F.col(ts), "HH:mm:ss"))


def grid(df: DataFrame, keys: list[str], index: str, step: Column | int) -> DataFrame:
    """Every step between the first and last ``index`` of each group of ``keys`` over the whole input (A-10, G-1)."""
    step = step if isinstance(step, Column) else F.lit(step)
    span = df.groupBy(*keys).agg(F.min(index).alias("lo_"), F.max(index).alias("hi_"))
    return span.select(*keys, F.explode(F.sequence("lo_", "hi_", step.cast("int"))).alias(index))
