"""Fixed schemas, and bringing frames to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS = {
    "readings": "ReadId string not null, SensorId string not null, TimeSpan timestamp not null, LocalTimeSpan timestamp, Value decimal(19,9) not null",
    "dimensions": "SensorId string not null, SensorTyId string not null, DeviceId string not null, _sensor_name string, _sensor_type string, DeviceTyId string not null, SubLocationId string not null, _device_name string, _device_type string, SubLocationTyId string not null, _sublocation_name string, LocationId string not null, _sublocation_type string",
    "reading_status": "OperationId string, DeviceId string, LocationId string, SensorTyId string, StatusCode int, MeasurementValue double, Anomalies bigint, LocalTimeSpan timestamp_ntz, _sensor_type string",
    "fact_hourly_device_status": "OperationId string not null, DeviceId string not null, LocalTimeSpan timestamp_ntz not null, StatusCode smallint not null, Anomalies int, ModifiedAt timestamp not null, Fecha date, Hora string",
    "fact_hourly_reading_status": "OperationId string not null, SensorTyId string not null, StatusCode smallint not null, MeasurementValue decimal(9,4), Anomalies int, ModifiedAt timestamp not null",
    "derived_status": "StatusCode smallint not null, Description string not null",
    "ingestion_control": "IngestionName string not null, LastLoadedAt timestamp, LastRunStatus string not null, LastRunStartedAt timestamp, LastRunFinishedAt timestamp, LastRunError string, IsActive boolean not null, UpdatedAt timestamp not null",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def empty(spark: SparkSession, name: str) -> DataFrame:
    """A typed frame without rows (L-21, U-3)."""
    return spark.createDataFrame([], schema(name))


def conform(df: DataFrame, to: T.StructType | str) -> DataFrame:
    """The columns of a schema, in its order and types (C-3); one that is missing becomes null, others are dropped. Columns that must not be null but are missing raise ValueError."""
    to = schema(to) if isinstance(to, str) else to
    for f in to.fields:
        if not f.nullable and f.name not in df.columns:
            raise ValueError(f"column {f.name} is missing")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in to.fields])
