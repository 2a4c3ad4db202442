"""The flattened dimension and its use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmetrics.operators.rules import status_table

#: A dimension of more rows than this is not broadcast by hint; Spark then chooses by size.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Broadcast a side that a count shows to be small; any other is shuffled or sorted as Spark sees fit.

    ``bound`` has at least as many rows and is counted instead, as the sensors' table for a dimension of a row a sensor:
    a parquet table's rows are counted from its footers.
    """
    return F.broadcast(df) if (df if bound is None else bound).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def flatten(sensors: DataFrame, sensor_types: DataFrame, devices: DataFrame, device_types: DataFrame, sublocations: DataFrame, sublocation_types: DataFrame) -> DataFrame:
    """Sensor -> type, device -> type, sublocation -> type by left joins: 13 columns, one row a sensor (J-1)."""
    named = lambda df, name, *cols: df.select(*cols, F.col("Name").alias(name))
    out = named(sensors, "_sensor_name", "SensorId", "SensorTyId", "DeviceId")
    out = out.join(named(sensor_types, "_sensor_type", "SensorTyId"), "SensorTyId", "left")
    out = out.join(named(devices, "_device_name", "DeviceId", "DeviceTyId", "SubLocationId"), "DeviceId", "left")
    out = out.join(named(device_types, "_device_type", "DeviceTyId"), "DeviceTyId", "left")
    out = out.join(named(sublocations, "_sublocation_name", "SubLocationId", "SubLocationTyId", "LocationId"), "SubLocationId", "left")
    out = out.join(named(sublocation_types, "_sublocation_type", "SubLocationTyId"), "SubLocationTyId", "left")
    return out.select("SensorId", "SensorTyId", "DeviceId", "_sensor_name", "_sensor_type", "DeviceTyId", "SubLocationId", "_device_name", "_device_type", "SubLocationTyId", "_sublocation_name", "LocationId", "_sublocation_type")


def enrich(readings: DataFrame, dimensions: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Readings with the dimension's 13 columns; of a reading whose sensor is unknown all of them, SensorId too, are null (J-2). ``bound`` as in :func:`small`."""
    r = readings.select("ReadId", F.col("SensorId").alias("sensor_"), "TimeSpan", "LocalTimeSpan", "Value")
    return r.join(small(dimensions, bound), F.col("sensor_") == dimensions["SensorId"], "left").drop("sensor_")


def decode_status(df: DataFrame) -> DataFrame:
    """Adds the description of each StatusCode (C-7); the table has four rows."""
    return df.join(F.broadcast(status_table(df.sparkSession)), "StatusCode", "left")
