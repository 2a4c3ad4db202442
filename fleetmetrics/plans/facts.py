"""Fact tables built from readings and dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from fleetmetrics.functions.schemas import conform, schema
from fleetmetrics.functions.timegrid import date_parts
from fleetmetrics.operators.dimensions import decode_status, enrich
from fleetmetrics.operators.rollup import device_status
from fleetmetrics.operators.status import hourly_reading_status


@dataclass
class Facts:
    """Frames of one fact build; each is computed when it is written."""

    readings: DataFrame
    devices: DataFrame
    watermark: DataFrame


def build_facts(readings: DataFrame, dimensions: DataFrame, modified_at: datetime | None = None, bound: DataFrame | None = None) -> Facts:
    """Device fact, sensor-type fact and watermark from raw readings (F-8), in the schemas of the fact tables.

    ``modified_at`` is the time of the build, now if not given. Keys are hashes, so the two facts agree without being
    written together. ``bound`` as in :func:`enrich`.
    """
    facts = facts_of(hourly_reading_status(enrich(readings, dimensions, bound)), modified_at)
    return Facts(conform(facts.readings, "fact_hourly_reading_status"), facts.devices, facts.watermark)


def facts_of(status: DataFrame, modified_at: datetime | None = None) -> Facts:
    """Facts from statuses that are there already. The sensor-type fact keeps the hour as LocalTimeSpan, by which its table is cut into days."""
    stamp = F.current_timestamp() if modified_at is None else F.lit(modified_at).cast("timestamp")
    devices = conform(date_parts(device_status(status), "LocalTimeSpan").withColumn("ModifiedAt", stamp), "fact_hourly_device_status")
    to = StructType([*schema("fact_hourly_reading_status"), StructField("LocalTimeSpan", TimestampNTZType())])
    return Facts(conform(status.withColumn("ModifiedAt", stamp), to), devices, devices.agg(F.max("LocalTimeSpan").alias("LocalTimeSpan")))


def operations_view(status: DataFrame) -> DataFrame:
    """LocationId, LocalTimeSpan, Estatus, Valor, Anomalias, Fecha and Hora of each sensor type and hour (M-11)."""
    named = date_parts(decode_status(status), "LocalTimeSpan")
    return named.select("OperationId", "DeviceId", "LocationId", "SensorTyId", "LocalTimeSpan", F.col("Description").alias("Estatus"), F.col("MeasurementValue").alias("Valor"), F.col("Anomalies").alias("Anomalias"), "Fecha", "Hora")
