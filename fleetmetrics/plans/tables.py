"""The registered queries' inputs: telemetry and store tables drawn from the given ones, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.operators.dimensions import enrich, flatten
from fleetmetrics.operators.rules import FAMILIES

DEVICE_TYPES = [d for devices in FAMILIES.values() for d in devices]
SENSOR_TYPES = {"AUTOMOBILE": "Corriente", "BUILDING": "Presión", "FURNITURE": "Temperatura", "HOUSEHOLD": "Encendido", "MACHINERY": "On/Off Termostato"}
DESCRIPTIONS = ["Retraso de cierre", "Retraso de apertura", "Movimiento detectado", "Otro", "Sin tipo"]
MODULES = {"A": "SEG", "N": "MTO", "R": "ADM"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: F.Column, names: dict) -> F.Column:
    out = None
    for k, v in names.items():
        out = F.when(column == k, v) if out is None else out.when(column == k, v)
    return out


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp_ntz")
    return load(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("ReadId"), F.col("user_id").cast("string").alias("SensorId"), ts.alias("TimeSpan"), ts.alias("LocalTimeSpan"), F.col("value").cast("decimal(19,9)").alias("Value"))


def sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The six source tables of the dimension."""
    customer, nation, region = (load(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    text = lambda c: F.col(c).cast("string")
    sensors = customer.select(text("c_custkey").alias("SensorId"), F.col("c_mktsegment").alias("SensorTyId"), text("c_nationkey").alias("DeviceId"), F.col("c_name").alias("Name"))
    sensor_types = customer.select(F.col("c_mktsegment").alias("SensorTyId"), _choose(F.col("c_mktsegment"), SENSOR_TYPES).alias("Name")).distinct()
    kind = F.pmod(F.col("n_nationkey"), F.lit(len(DEVICE_TYPES)))
    devices = nation.select(text("n_nationkey").alias("DeviceId"), kind.cast("string").alias("DeviceTyId"), text("n_regionkey").alias("SubLocationId"), F.col("n_name").alias("Name"))
    device_types = nation.select(kind.cast("string").alias("DeviceTyId"), F.element_at(F.array(*map(F.lit, DEVICE_TYPES)), kind + 1).alias("Name")).distinct()
    even = F.pmod(F.col("r_regionkey"), F.lit(2)).cast("string")
    sublocations = region.select(text("r_regionkey").alias("SubLocationId"), even.alias("SubLocationTyId"), F.concat(F.lit("loc"), text("r_regionkey")).alias("LocationId"), F.col("r_name").alias("Name"))
    sublocation_types = region.select(even.alias("SubLocationTyId"), F.when(even == "0", "Interior").otherwise("Exterior").alias("Name")).distinct()
    return [sensors, sensor_types, devices, device_types, sublocations, sublocation_types]


def dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(*sources(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(readings(spark, sf_dir), dimensions(spark, sf_dir), load(spark, sf_dir, "customer"))  # a row a sensor


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of stores from orders."""
    k = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(k.alias("Id"), F.col("o_custkey").alias("Fk_Tienda"), (k % 5).alias("Fk_TipoAlerta"), (k % 7).alias("Fk_EstatusAlerta"), (k % 100).alias("Fk_Solucion"))


def alert_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    return load(spark, sf_dir, "orders").select(k.alias("Id"), F.element_at(F.array(*map(F.lit, DESCRIPTIONS)), (k + 1).cast("int")).alias("Descripcion")).distinct()


def open_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts from error events: each store has one communicator, of the same number."""
    e = load(spark, sf_dir, "events").where("event_type = 'error'")
    return e.select(F.col("event_id").alias("Id"), F.col("user_id").alias("Fk_Tienda"), F.lit(23).alias("Fk_TipoAlerta"), (F.col("event_id") % 7).cast("int").alias("Fk_EstatusAlerta"), (F.col("event_id") % 3).cast("int").alias("Fk_Origen"), F.col("ts").cast("timestamp_ntz").alias("FechaAbierto"), F.col("props").alias("Anotacion"), (F.col("event_id") % 100).alias("Fk_Solucion"))


def communicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Fk_Tienda"), F.col("c_custkey").cast("string").alias("Imei"))


def alarm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").where("event_type = 'purchase'")
    code = F.when(F.col("event_id") % 3 == 0, 401).when(F.col("event_id") % 3 == 1, 407).otherwise(500)
    return e.select(F.col("user_id").cast("string").alias("Imei"), code.alias("Fk_Code"), F.lit(3).alias("Fk_Zona"), F.col("ts").cast("timestamp_ntz").alias("Fecha"))


def event_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(401, 3, "Apertura"), (407, 3, "Cierre")], "Codigo int, Zona int, Evento string")


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderdate").cast("timestamp_ntz")
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("Fk_Tienda"), start.alias("FechaInicio"), (start + F.make_dt_interval(days=F.lit(6))).alias("FechaFin"), F.col("o_totalprice").alias("Oportunidad"))


def modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("Fk_EvaluacionGeneral"), _choose(F.col("l_returnflag"), MODULES).alias("Fk_ModuloEvaluable"), F.col("l_extendedprice").alias("Oportunidad"))


def _case(column: str, names: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


#: The same tables as DuckDB common table expressions.
SQL = f"""
readings AS (SELECT CAST(event_id AS VARCHAR) AS ReadId, CAST(user_id AS VARCHAR) AS SensorId, ts AS TimeSpan, ts AS LocalTimeSpan, CAST(value AS DECIMAL(19,9)) AS Value FROM events),
dims AS (
  SELECT CAST(c_custkey AS VARCHAR) AS SensorId, c_mktsegment AS SensorTyId, CAST(c_nationkey AS VARCHAR) AS DeviceId, c_name AS _sensor_name,
    {_case("c_mktsegment", SENSOR_TYPES)} AS _sensor_type, CAST(n_nationkey % {len(DEVICE_TYPES)} AS VARCHAR) AS DeviceTyId, CAST(n_regionkey AS VARCHAR) AS SubLocationId,
    n_name AS _device_name, ({DEVICE_TYPES})[n_nationkey % {len(DEVICE_TYPES)} + 1] AS _device_type, CAST(r_regionkey % 2 AS VARCHAR) AS SubLocationTyId,
    r_name AS _sublocation_name, 'loc' || r_regionkey AS LocationId, CASE WHEN r_regionkey % 2 = 0 THEN 'Interior' WHEN r_regionkey % 2 = 1 THEN 'Exterior' END AS _sublocation_type
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
ext AS (SELECT r.ReadId, r.TimeSpan, r.LocalTimeSpan, r.Value, d.* FROM readings r LEFT JOIN dims d ON r.SensorId = d.SensorId),
open_alerts AS (
  SELECT event_id AS Id, user_id AS Fk_Tienda, CAST(event_id % 7 AS INTEGER) AS Fk_EstatusAlerta, CAST(event_id % 3 AS INTEGER) AS Fk_Origen, ts AS FechaAbierto, props AS Anotacion, event_id % 100 AS Fk_Solucion
  FROM events WHERE event_type = 'error'),
alarms AS (
  SELECT CAST(user_id AS VARCHAR) AS Imei, CASE event_id % 3 WHEN 0 THEN 401 WHEN 1 THEN 407 ELSE 500 END AS Fk_Code, ts AS Fecha FROM events WHERE event_type = 'purchase'),
not_armed AS (
  SELECT DISTINCT a.Id AS IdAlerta, a.Fk_Tienda AS IdTienda, e.Imei, a.Anotacion, a.FechaAbierto, e.Fecha AS FechaAlarma, CASE e.Fk_Code WHEN 401 THEN 'Apertura' ELSE 'Cierre' END AS Evento, a.Fk_Origen
  FROM open_alerts a JOIN customer c ON a.Fk_Tienda = c.c_custkey JOIN alarms e ON e.Imei = CAST(c.c_custkey AS VARCHAR)
    AND e.Fecha > date_trunc('day', a.FechaAbierto) + INTERVAL 12 HOUR AND e.Fecha < date_trunc('day', a.FechaAbierto) + INTERVAL 29 HOUR
  WHERE a.Fk_EstatusAlerta <> 6 AND e.Fk_Code IN (401, 407) AND CAST(a.FechaAbierto AS DATE) <> CAST(e.Fecha AS DATE))"""
