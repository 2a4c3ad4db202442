"""Every registered query of the library, with its SQL. Names are those of the operator inventory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.functions.keys import operation_id
from fleetmetrics.functions.schemas import conform
from fleetmetrics.functions.timegrid import bucket, date_parts, floor_to, from_minutes, grid, hour, minute_index
from fleetmetrics.operators import measures, status
from fleetmetrics.operators.dimensions import decode_status
from fleetmetrics.operators.rollup import bad_runs, bad_runs_chunked, device_status
from fleetmetrics.operators.rules import FAMILIES, RULES, STATUS
from fleetmetrics.plans import partials, tables as t
from fleetmetrics.plans.facts import build_facts, operations_view
from fleetmetrics.sources import files, incremental, keyindex, readings as lake, sites
from fleetmetrics.sources.ledger import Ledger
from fleetmetrics.streaming import gaps, status as streaming

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}

LO = 10.0
LO_TS, MID_TS, HI_TS = datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 12), datetime(2024, 1, 15, 18, 30)
_lo, _mid, _hi = (f"TIMESTAMP '{x}'" for x in (LO_TS, MID_TS, HI_TS))


def _query(name: str, sql: str | None = None, cte: bool = True) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _Q[name] = f
        if sql is not None:
            _SQL[name] = f"WITH {t.SQL} {sql}" if cte else sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def _series(spark: SparkSession, sf: str, windowed: bool = True) -> DataFrame:
    """Enriched readings of the current sensors with bounds, as the status operators take them."""
    return status._with_bounds(t.enriched(spark, sf), "Corriente", LO, None, 20 if windowed else None)


def _at(df: DataFrame, column: str = "h", name: str = "LocalTimeSpan") -> DataFrame:
    return df.withColumn(name, from_minutes(F.col(column))).drop(column)


_CURRENT = "cur AS (SELECT * FROM ext WHERE _sensor_type = 'Corriente')"
_B5 = "time_bucket(INTERVAL '5 minutes', LocalTimeSpan, TIMESTAMP '1970-01-01')"


def _bucket_sql(minutes: int, ts: str = "LocalTimeSpan") -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', {ts}, TIMESTAMP '1970-01-01')"


def _threshold_sql(source: str, lo: float, hi: float | None) -> str:
    ok = f"CAST(Value AS DOUBLE) >= {lo}" + (f" AND CAST(Value AS DOUBLE) <= {hi}" if hi is not None else "")
    return f"""SELECT DeviceId, LocationId, SensorTyId, _sensor_type, date_trunc('hour', LocalTimeSpan) AS h, avg(Value) AS mv,
      count(*) FILTER (WHERE {ok}) AS ok, count(*) AS total, count(*) FILTER (WHERE NOT ({ok})) AS anomalies FROM {source} GROUP BY ALL"""


def _windowed_sql(p: str, source: str, lo: float, hi: float | None, w: int) -> str:
    """Common table expressions named with a prefix; the last, ``{p}out``, has the result."""
    v = "CAST(Value AS DOUBLE)"
    bad = f"{v} <= {lo}" + (f" OR {v} > {hi}" if hi is not None else "")
    ok = f"vm > {lo}" + (f" AND vm <= {hi}" if hi is not None else "")
    long = f"CASE WHEN raw = {w // 60} THEN 1 ELSE 0 END" if w // 60 > 1 else "least(raw, 3)"
    return f"""
{p}b AS (SELECT *, {_B5} AS b5, {_bucket_sql(w)} AS xw, CASE WHEN {bad} THEN 1 ELSE 0 END AS bad FROM {source}),
{p}m AS (SELECT DeviceId, b5, date_trunc('hour', b5) AS h, SensorId, LocationId, SensorTyId, _sensor_type, max({v}) AS vm FROM {p}b GROUP BY ALL),
{p}d AS (SELECT DeviceId, h, b5, LocationId, SensorTyId, _sensor_type, max(vm) AS vm FROM {p}m GROUP BY ALL),
{p}st AS (SELECT DeviceId, h, count(*) FILTER (WHERE {ok}) AS ok FROM {p}d GROUP BY ALL),
{p}val AS (SELECT DeviceId, h, LocationId, SensorTyId, _sensor_type, avg(vm) AS mv, count(*) AS n FROM {p}m GROUP BY ALL),
{p}ag AS (SELECT DeviceId, LocationId, SensorTyId, xw, count(*) AS n, CAST(sum(bad) AS BIGINT) AS z FROM {p}b GROUP BY ALL),
{p}sp AS (SELECT DeviceId, LocationId, SensorTyId, unnest(generate_series(min(xw), max(xw), INTERVAL '{w} minutes')) AS xw FROM {p}b GROUP BY DeviceId, LocationId, SensorTyId),
{p}fill AS (SELECT s.DeviceId, s.LocationId, s.SensorTyId, s.xw, coalesce(n, 0) AS n, coalesce(z, 0) AS z FROM {p}sp s LEFT JOIN {p}ag a
  ON s.DeviceId = a.DeviceId AND s.LocationId = a.LocationId AND s.SensorTyId = a.SensorTyId AND s.xw = a.xw),
{p}raw AS (SELECT DeviceId, date_trunc('hour', xw) AS h, SensorTyId, count(*) FILTER (WHERE n = 0 OR z = n OR (n < {lo} AND z > 0)) AS raw FROM {p}fill GROUP BY ALL),
{p}an AS (SELECT DeviceId, h, SensorTyId, CAST({long} AS BIGINT) AS anomalies FROM {p}raw),
{p}out AS (SELECT v.DeviceId, v.h, v.LocationId, v.SensorTyId, v._sensor_type, mv, n, ok, CASE WHEN ok / 12.0 >= 0.3 THEN 1 ELSE 3 END AS status, coalesce(anomalies, 0) AS anomalies
  FROM {p}val v JOIN {p}st s ON v.DeviceId = s.DeviceId AND v.h = s.h LEFT JOIN {p}an a ON a.DeviceId = v.DeviceId AND a.h = v.h)"""


_W = f", {_CURRENT}, {_windowed_sql('', 'cur', LO, None, 20).strip()}"

# Lake and incremental loading


@_query("L-1", f"SELECT * FROM readings WHERE TimeSpan >= {_lo} AND TimeSpan <= {_hi}")
def _(spark, sf):
    root = _scratch(spark, "lake")
    lake.write_readings(t.readings(spark, sf), root)
    out = lake.read_readings_range(spark, root, LO_TS, HI_TS).drop("event_date")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("TimeSpan", "LocalTimeSpan")})


_scratch = files.scratch


@_query("L-3", f"SELECT * FROM readings WHERE LocalTimeSpan >= {_mid}")
def _(spark, sf):
    return lake.since_bound(t.readings(spark, sf), "LocalTimeSpan", MID_TS)


_TARGET = f"target AS (SELECT * FROM readings WHERE TimeSpan < {_mid}), incoming AS (SELECT * FROM readings WHERE TimeSpan >= {_lo} UNION ALL SELECT * FROM readings WHERE TimeSpan >= {_hi})"


def _target(spark, sf):
    r = t.readings(spark, sf)
    lit = lambda x: F.lit(x).cast("timestamp_ntz")
    return r.where(F.col("TimeSpan") < lit(MID_TS)), r.where(F.col("TimeSpan") >= lit(LO_TS)).unionByName(r.where(F.col("TimeSpan") >= lit(HI_TS)))


@_query("L-2", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer", cte=False)
def _(spark, sf):
    """Over JDBC from a source system of several databases, each in parallel by stretches of keys with as many rows each."""
    rows = t.load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    urls = sites.build(rows, _scratch(spark, "sites"), "CUSTOMER", {"c_custkey": "BIGINT", "c_nationkey": "INTEGER", "c_mktsegment": "VARCHAR(32672)"})
    parts = [lake.read_jdbc(spark, url, "CUSTOMER", sites.DRIVER, "c_custkey", partitions=2) for url in urls]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], rows.schema))


@_query("L-4", f", {_TARGET} SELECT * FROM target UNION ALL SELECT DISTINCT * FROM incoming WHERE ReadId NOT IN (SELECT ReadId FROM target)")
def _(spark, sf):
    """Written in three runs to a lake: the target, what has come in, in which some rows are there twice, and the same again. Summaries of the days' keys say which days are looked at."""
    target, incoming = _target(spark, sf)
    path = _scratch(spark, "readings")
    lake.write_readings(target, path)
    index = keyindex.KeyIndex(spark, path, lake.DAY, "ReadId")
    for again in (False, True):
        index.refresh()
        fresh = index.new_rows(incoming)
        if not again:
            lake.write_readings(fresh, path)
        elif not fresh.isEmpty():
            raise RuntimeError("a repeated run has new rows")
    return _plain(spark.read.parquet(path).drop(lake.DAY), "TimeSpan", "LocalTimeSpan")


@_query("L-7", f", {_TARGET} SELECT * FROM incoming WHERE TimeSpan >= (SELECT max(TimeSpan) FROM target)")
def _(spark, sf):
    target, incoming = _target(spark, sf)
    return incremental.from_high_water(incoming, target, "TimeSpan")


@_query("L-8", "SELECT SensorId, ReadId, TimeSpan, Value FROM (SELECT *, row_number() OVER (PARTITION BY SensorId ORDER BY TimeSpan DESC, ReadId) AS k FROM readings) WHERE k = 1")
def _(spark, sf):
    return incremental.dedup(t.readings(spark, sf), ["SensorId"], "TimeSpan", "ReadId").select("SensorId", "ReadId", "TimeSpan", "Value")


@_query("L-9", f", {_TARGET} SELECT DISTINCT * FROM incoming WHERE ReadId NOT IN (SELECT ReadId FROM target)")
def _(spark, sf):
    target, incoming = _target(spark, sf)
    return incremental.new_rows(incoming, target, ["ReadId"])


@_query("L-10", f"SELECT * FROM readings WHERE NOT (TimeSpan >= {_lo} AND TimeSpan < {_mid}) UNION ALL SELECT * FROM readings WHERE TimeSpan >= {_lo} AND TimeSpan < {_mid} AND Value > 50")
def _(spark, sf):
    """In a lake: only the range's days are read and written."""
    root, r = _scratch(spark, "lake"), t.readings(spark, sf)
    lake.write_readings(r, root)
    lake.replace_readings(spark, root, r.where(F.col("Value") > 50), LO_TS, MID_TS)
    return _plain(spark.read.parquet(root).drop("event_date"), "TimeSpan", "LocalTimeSpan")


@_query("L-10-frames", f"SELECT * FROM readings WHERE NOT (TimeSpan >= {_lo} AND TimeSpan < {_mid}) UNION ALL SELECT * FROM readings WHERE TimeSpan >= {_lo} AND TimeSpan < {_mid} AND Value > 50")
def _(spark, sf):
    r = t.readings(spark, sf)
    inside = (F.col("TimeSpan") >= F.lit(LO_TS).cast("timestamp_ntz")) & (F.col("TimeSpan") < F.lit(MID_TS).cast("timestamp_ntz"))
    return incremental.replace_range(r, r.where(inside & (F.col("Value") > 50)), "TimeSpan", LO_TS, MID_TS)


@_query("L-11", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01')", cte=False)
def _(spark, sf):
    orders = t.load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = t.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return incremental.cascade(lines, orders, "l_orderkey", "o_orderdate", datetime(1996, 1, 1), datetime(1998, 1, 1))


@_query("L-12", "SELECT count(*) AS n, max(TimeSpan) AS latest FROM readings")
def _(spark, sf):
    """As observed in the write itself."""
    rows = t.readings(spark, sf)
    n, latest = incremental.write_new(rows, rows.limit(0), _scratch(spark, "readings"), ["ReadId"], ts="TimeSpan")
    return spark.createDataFrame([(n, latest)], "n long, latest timestamp_ntz")


def _ledger(spark, sf):
    """A ledger of runs: one ingestion a nation, watermarks from its customers' latest events."""
    seen = t.readings(spark, sf).join(t.sources(spark, sf)[0].select("SensorId", "DeviceId"), "SensorId").groupBy("DeviceId").agg(F.max("TimeSpan").cast("timestamp").alias("LastLoadedAt"))
    names = t.sources(spark, sf)[2].select("DeviceId", F.col("Name").alias("IngestionName"))
    even = F.col("DeviceId").cast("int") % 2 == 0
    return names.join(seen, "DeviceId", "left").select(
        "IngestionName", F.when(even, F.col("LastLoadedAt")).alias("LastLoadedAt"), F.when(even, "SUCCESS").otherwise("FAILED").alias("LastRunStatus"), F.lit(LO_TS).alias("LastRunStartedAt"),
        F.lit(MID_TS).alias("LastRunFinishedAt"), F.lit(None).cast("string").alias("LastRunError"), F.lit(True).alias("IsActive"), F.lit(MID_TS).alias("UpdatedAt"),
    )


_LEDGER = """ledger AS (
  SELECT n_name AS IngestionName, CASE WHEN n_nationkey % 2 = 0 THEN LastLoadedAt END AS LastLoadedAt, CASE WHEN n_nationkey % 2 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS LastRunStatus
  FROM nation LEFT JOIN (SELECT DeviceId, max(TimeSpan) AS LastLoadedAt FROM readings JOIN dims USING (SensorId) GROUP BY DeviceId) s ON s.DeviceId = CAST(n_nationkey AS VARCHAR))"""


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@_query("L-13", f", {_LEDGER} SELECT IngestionName, date_trunc('second', coalesce(LastLoadedAt, TIMESTAMP '2025-10-01 00:00:00')) - INTERVAL 2 HOURS AS from_utc, {_hi} AS to_utc FROM ledger")
def _(spark, sf):
    return _plain(incremental.load_window(_ledger(spark, sf), HI_TS, incremental.LOOKBACK_HOURS).select("IngestionName", "from_utc", "to_utc"), "from_utc", "to_utc")


@_query("L-14", f", {_LEDGER} SELECT IngestionName, CASE WHEN LastRunStatus <> 'SUCCESS' THEN {_mid} ELSE coalesce(LastLoadedAt, {_hi}) END AS watermark FROM ledger")
def _(spark, sf):
    mark = incremental.advance(F.lit(MID_TS), F.col("LastRunStatus") == "SUCCESS", F.col("LastLoadedAt"), F.lit(HI_TS))
    return _plain(_ledger(spark, sf).select("IngestionName", mark.alias("watermark")), "watermark")


@_query("L-15", f", {_LEDGER} SELECT IngestionName, LastLoadedAt, LastRunStatus FROM ledger UNION ALL SELECT r_name, NULL, 'RUNNING' FROM region WHERE r_name NOT IN (SELECT IngestionName FROM ledger)")
def _(spark, sf):
    names = t.load(spark, sf, "region").select(F.col("r_name").alias("IngestionName")).unionByName(t.load(spark, sf, "nation").select(F.col("n_name").alias("IngestionName")))
    return _plain(incremental.get_watermark(_ledger(spark, sf), names, HI_TS).select("IngestionName", "LastLoadedAt", "LastRunStatus"), "LastLoadedAt")


def _stored(spark, sf) -> Ledger:
    """The ledger of runs, in a folder."""
    out = Ledger(spark, _scratch(spark, "ledger"))
    out.store(conform(_ledger(spark, sf), "ingestion_control"), 0)
    return out


_ENTRY = "SELECT IngestionName, CASE WHEN IngestionName = 'NATION_3' THEN {loaded} ELSE LastLoadedAt END AS LastLoadedAt, CASE WHEN IngestionName = 'NATION_3' THEN '{status}' ELSE LastRunStatus END AS LastRunStatus, CASE WHEN IngestionName = 'NATION_3' THEN {start} ELSE {lo} END AS LastRunStartedAt, CASE WHEN IngestionName = 'NATION_3' THEN {end} ELSE {mid} END AS LastRunFinishedAt, CASE WHEN IngestionName = 'NATION_3' THEN {error} END AS LastRunError FROM ledger"
_ENTRY_COLUMNS = ["IngestionName", "LastLoadedAt", "LastRunStatus", "LastRunStartedAt", "LastRunFinishedAt", "LastRunError"]
_ENTRY_TIMES = [c for c in _ENTRY_COLUMNS if c.endswith("At")]


@_query("L-16", f", {_LEDGER} " + _ENTRY.format(loaded="LastLoadedAt", status="RUNNING", start=_hi, end="NULL", error="CAST(NULL AS VARCHAR)", lo=_lo, mid=_mid))
def _(spark, sf):
    stored = _stored(spark, sf)
    stored.begin("NATION_3", HI_TS)
    return _plain(stored.frame.select(*_ENTRY_COLUMNS), *_ENTRY_TIMES)


@_query("L-17", f", {_LEDGER} " + _ENTRY.format(loaded=_hi, status="SUCCESS", start=_lo, end=_hi, error="CAST(NULL AS VARCHAR)", lo=_lo, mid=_mid))
def _(spark, sf):
    stored = _stored(spark, sf)
    stored.finish("NATION_3", HI_TS, True, HI_TS)
    return _plain(stored.frame.select(*_ENTRY_COLUMNS), *_ENTRY_TIMES)


@_query("L-17-failed", f", {_LEDGER} " + _ENTRY.format(loaded="LastLoadedAt", status="FAILED", start=_mid, end=_hi, error="'no space'", lo=_lo, mid=_mid))
def _(spark, sf):
    """A run that has begun and failed: the watermark stays."""
    stored = _stored(spark, sf)
    stored.begin("NATION_3", MID_TS)
    stored.finish("NATION_3", HI_TS, False, HI_TS, "no space")
    return _plain(stored.frame.select(*_ENTRY_COLUMNS), *_ENTRY_TIMES)


@_query("L-18", "SELECT * FROM readings")
def _(spark, sf):
    return lake.hand_off(t.readings(spark, sf), _scratch(spark, "stage"))


_DIMENSION = ", known AS (SELECT SensorId, DeviceId, _sensor_name FROM dims WHERE CAST(SensorId AS BIGINT) % 2 = 0), fresh AS (SELECT SensorId, DeviceId, _sensor_name || ' new' AS _sensor_name FROM dims WHERE CAST(SensorId AS BIGINT) % 3 = 0)"


def _two(spark, sf):
    d = t.dimensions(spark, sf).withColumn("ModifiedAt", F.lit(LO_TS)).select("SensorId", "DeviceId", "_sensor_name", "ModifiedAt")
    number = F.col("SensorId").cast("long")
    return d.where(number % 2 == 0), d.where(number % 3 == 0).withColumn("_sensor_name", F.concat("_sensor_name", F.lit(" new")))


@_query("L-19", f"{_DIMENSION} SELECT * FROM known UNION ALL SELECT * FROM fresh WHERE SensorId NOT IN (SELECT SensorId FROM known)")
def _(spark, sf):
    return incremental.merge_dimension(*_two(spark, sf)).drop("ModifiedAt")


@_query("L-19-upsert", f"{_DIMENSION} SELECT * FROM known WHERE SensorId NOT IN (SELECT SensorId FROM fresh) UNION ALL SELECT * FROM fresh")
def _(spark, sf):
    return incremental.merge_dimension(*_two(spark, sf), mode="upsert").drop("ModifiedAt")


@_query("L-20", f"SELECT max(ts) AS latest, max(ts) <> {_mid} AS changed FROM events", cte=False)
def _(spark, sf):
    return incremental.changed_since(t.readings(spark, sf), "TimeSpan", MID_TS).withColumnRenamed("latest", "latest")


# Projections and predicates


@_query("C-1", "SELECT ReadId, _device_type FROM ext WHERE _device_type IN ('Cuarto de conservación', 'Ambiente conservacion', 'Compresor conservación')")
def _(spark, sf):
    return t.enriched(spark, sf).where(F.col("_device_type").isin(FAMILIES["cuartos_refrigeracion"])).select("ReadId", "_device_type")


@_query("C-2", "SELECT ReadId, _device_type FROM ext WHERE _device_type <> 'Resitencia de deshielo' AND _device_type <> 'Resistencia de deshielo'")
def _(spark, sf):
    return t.enriched(spark, sf).where((F.col("_device_type") != "Resitencia de deshielo") & (F.col("_device_type") != "Resistencia de deshielo")).select("ReadId", "_device_type")


@_query("C-3", "SELECT ReadId, SensorId, Value, CAST(NULL AS BIGINT) AS Anomalies FROM readings")
def _(spark, sf):
    from pyspark.sql.types import StructType

    return conform(t.readings(spark, sf), StructType.fromDDL("ReadId string, SensorId string, Value decimal(19,9), Anomalies bigint"))


@_query("C-4", "SELECT ReadId, CAST(LocalTimeSpan AS DATE) AS Fecha, strftime(LocalTimeSpan, '%H:%M:%S') AS Hora FROM readings")
def _(spark, sf):
    return date_parts(t.readings(spark, sf), "LocalTimeSpan").select("ReadId", "Fecha", "Hora")


@_query("C-5", f"SELECT ReadId FROM readings WHERE TimeSpan >= {_lo} AND TimeSpan < {_hi}")
def _(spark, sf):
    return lake.between(t.readings(spark, sf), "TimeSpan", F.lit(LO_TS).cast("timestamp_ntz"), F.lit(HI_TS).cast("timestamp_ntz"), "left").select("ReadId")


@_query("C-6", "SELECT ReadId, coalesce(CASE WHEN Value > 20 THEN Value END, 0) AS Value FROM readings")
def _(spark, sf):
    return t.readings(spark, sf).select("ReadId", F.coalesce(F.when(F.col("Value") > 20, F.col("Value")), F.lit(0).cast("decimal(19,9)")).alias("Value"))


_DECODE = "CASE status " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in STATUS.items()) + " END"


@_query("C-7", f"{_W} SELECT DeviceId, h AS LocalTimeSpan, CAST(status AS INTEGER) AS StatusCode, {_DECODE} AS Description FROM (SELECT DISTINCT DeviceId, h, status FROM out)")
def _(spark, sf):
    rows = status.windowed_status(t.enriched(spark, sf), "Corriente", LO, None, 20)
    return decode_status(rows.select("DeviceId", "LocalTimeSpan", "StatusCode").distinct()).select("DeviceId", "LocalTimeSpan", "StatusCode", "Description")


# Joins


@_query("J-1", "SELECT * FROM dims")
def _(spark, sf):
    return t.dimensions(spark, sf)


@_query("J-2", "SELECT * FROM ext")
def _(spark, sf):
    return t.enriched(spark, sf)


@_query("J-3", f"{_W} SELECT DeviceId, LocationId, SensorTyId, xw, n AS row_count, z AS zero_count FROM fill")
def _(spark, sf):
    rows = status.filled(status.window_counts(_series(spark, sf)))
    return rows.select("DeviceId", "LocationId", "SensorTyId", from_minutes(F.col("xw")).alias("xw"), F.col("row_count").cast("long").alias("row_count"), F.col("zero_count").cast("long").alias("zero_count"))


@_query("J-4", "SELECT a.Id, e.Imei, a.FechaAbierto, e.Fecha, e.Fk_Code FROM open_alerts a JOIN alarms e ON e.Imei = CAST(a.Fk_Tienda AS VARCHAR) AND e.Fecha > date_trunc('day', a.FechaAbierto) + INTERVAL 12 HOUR AND e.Fecha < date_trunc('day', a.FechaAbierto) + INTERVAL 29 HOUR WHERE CAST(a.FechaAbierto AS DATE) <> CAST(e.Fecha AS DATE)")
def _(spark, sf):
    a = t.open_alerts(spark, sf).withColumn("Imei", F.col("Fk_Tienda").cast("string"))
    return measures.alarm_events_of_alerts(a, t.alarm_events(spark, sf)).select("Id", "Imei", "FechaAbierto", "Fecha", "Fk_Code")


@_query("J-5", "SELECT CAST(d AS DATE) AS Fecha, count(*) AS n FROM (SELECT unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate + INTERVAL 6 DAYS AS DATE), INTERVAL 1 DAY)) AS d FROM orders) GROUP BY 1", cte=False)
def _(spark, sf):
    return measures.by_day(t.evaluations(spark, sf)).groupBy("Fecha").agg(F.count("*").alias("n"))


@_query("J-7", f"{_W} SELECT DeviceId, h AS LocalTimeSpan, LocationId, SensorTyId, round(mv, 6) AS MeasurementValue, CAST(status AS INTEGER) AS StatusCode, n AS total_sensors, ok AS is_okay, anomalies AS \"Anomalies\" FROM out")
def _(spark, sf):
    return _rounded(_at(status.windowed(_series(spark, sf))).select("DeviceId", "LocalTimeSpan", "LocationId", "SensorTyId", "MeasurementValue", "StatusCode", "total_sensors", "is_okay", "Anomalies"), "MeasurementValue")


@_query("J-7-sensor-type", f"{_W} SELECT v.DeviceId, v.h AS LocalTimeSpan, v.SensorTyId, round(v.mv, 6) AS MeasurementValue, v.n AS total_sensors, coalesce(a.anomalies, 0) AS \"Anomalies\" FROM val v LEFT JOIN an a ON a.DeviceId = v.DeviceId AND a.h = v.h AND a.SensorTyId = v.SensorTyId")
def _(spark, sf):
    return _rounded(_at(status.windowed(_series(spark, sf), join_grain="sensor_type")).select("DeviceId", "LocalTimeSpan", "SensorTyId", "MeasurementValue", "total_sensors", "Anomalies"), "MeasurementValue")


@_query("J-9", "SELECT count(*) FILTER (WHERE o_orderkey % 5 = 3) AS otros FROM orders", cte=False)
def _(spark, sf):
    return measures.alerts_by_description(t.alerts(spark, sf), t.alert_types(spark, sf), {"otros": "Otro"})


# Aggregations, windows and keys


@_query("A-1", f", {_CURRENT}, s AS ({_threshold_sql('cur', LO, None)}) SELECT DeviceId, LocationId, SensorTyId, _sensor_type, h AS LocalTimeSpan, round(mv, 6) AS MeasurementValue, ok AS is_okay, total AS total_readings, anomalies AS \"Anomalies\", round(ok / total, 6) AS Promedio, CAST(CASE WHEN ok / total >= 0.5 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode FROM s")
def _(spark, sf):
    return _rounded(status.threshold_status(t.enriched(spark, sf), "Corriente", LO), "MeasurementValue", "Promedio")


@_query("A-1-bounds", f", s AS ({_threshold_sql('ext', LO, 60.0)}) SELECT DeviceId, LocationId, SensorTyId, _sensor_type, h AS LocalTimeSpan, round(mv, 6) AS MeasurementValue, ok AS is_okay, total AS total_readings, anomalies AS \"Anomalies\", round(ok / total, 6) AS Promedio, CAST(CASE WHEN ok / total >= 0.5 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode FROM s")
def _(spark, sf):
    return _rounded(status.threshold_status(t.enriched(spark, sf), None, LO, 60.0), "MeasurementValue", "Promedio")


def _out_sql(p: str = "") -> str:
    return f"SELECT DeviceId, h AS LocalTimeSpan, LocationId, SensorTyId, _sensor_type, round(mv, 6) AS MeasurementValue, n AS total_sensors, ok AS is_okay, 12 AS total_readings, CAST(status AS INTEGER) AS StatusCode, anomalies AS \"Anomalies\" FROM {p}out"


@_query("A-2", f"{_W} {_out_sql()}")
def _(spark, sf):
    return _rounded(status.windowed_status(t.enriched(spark, sf), "Corriente", LO, None, 20), "MeasurementValue")


@_query("A-2-long", f", {_CURRENT}, {_windowed_sql('', 'cur', LO, 60.0, 240).strip()} {_out_sql()}")
def _(spark, sf):
    return _rounded(status.windowed_status(t.enriched(spark, sf), "Corriente", LO, 60.0, 240), "MeasurementValue")


@_query("A-2-all-types", f", {_windowed_sql('', 'ext', LO, None, 20).strip()} {_out_sql()}")
def _(spark, sf):
    return _rounded(status.windowed_status(t.enriched(spark, sf), None, LO, None, 20), "MeasurementValue")


@_query("A-2-7-minutes", f", {_CURRENT}, {_windowed_sql('', 'cur', LO, None, 7).strip()} {_out_sql()}")
def _(spark, sf):
    """Windows that neither five minutes nor an hour hold whole."""
    return _rounded(status.windowed_status(t.enriched(spark, sf), "Corriente", LO, None, 7), "MeasurementValue")


@_query("A-2-12-minutes", f", {_windowed_sql('', 'ext', LO, 60.0, 12).strip()} {_out_sql()}")
def _(spark, sf):
    return _rounded(status.windowed_status(t.enriched(spark, sf), None, LO, 60.0, 12), "MeasurementValue")


@_query("A-3", f"{_W} SELECT DeviceId, SensorId, LocationId, SensorTyId, b5 AS b, vm AS v FROM m")
def _(spark, sf):
    return status.sensor_maxima(_series(spark, sf)).select("DeviceId", "SensorId", "LocationId", "SensorTyId", from_minutes(F.col("b")).alias("b"), "v")


@_query("A-4", f"{_W} SELECT DeviceId, LocationId, SensorTyId, b5 AS b, vm AS v FROM d")
def _(spark, sf):
    return status.device_maxima(status.sensor_maxima(_series(spark, sf))).select("DeviceId", "LocationId", "SensorTyId", from_minutes(F.col("b")).alias("b"), "v")


@_query("A-5", f"{_W} SELECT DeviceId, h AS LocalTimeSpan, ok AS is_okay, CAST(CASE WHEN ok / 12.0 >= 0.3 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode FROM st")
def _(spark, sf):
    return _at(status.duty(status.device_maxima(status.sensor_maxima(_series(spark, sf))), ["DeviceId"])).select("DeviceId", "LocalTimeSpan", "is_okay", "StatusCode")


@_query("A-6", f"{_W} SELECT DeviceId, h AS LocalTimeSpan, LocationId, SensorTyId, round(mv, 6) AS MeasurementValue, n AS total_sensors FROM val")
def _(spark, sf):
    return _rounded(_at(status.mean_of_maxima(status.sensor_maxima(_series(spark, sf)))).select("DeviceId", "LocalTimeSpan", "LocationId", "SensorTyId", "MeasurementValue", "total_sensors"), "MeasurementValue")


@_query("A-7", f"{_W} SELECT DeviceId, LocationId, SensorTyId, xw, n AS row_count, z AS zero_count FROM ag")
def _(spark, sf):
    return status.window_counts(_series(spark, sf)).select("DeviceId", "LocationId", "SensorTyId", from_minutes(F.col("xw")).alias("xw"), "row_count", "zero_count")


@_query("A-8", f"{_W} SELECT DeviceId, h AS LocalTimeSpan, SensorTyId, anomalies AS \"Anomalies\" FROM an")
def _(spark, sf):
    return _at(status.window_anomalies(status.filled(status.window_counts(_series(spark, sf))))).select("DeviceId", "LocalTimeSpan", "SensorTyId", "Anomalies")


@_query("A-10", f"{_W} SELECT DeviceId, LocationId, SensorTyId, min(xw) AS first_window, max(xw) AS last_window FROM b GROUP BY ALL")
def _(spark, sf):
    at = floor_to(minute_index(F.col("LocalTimeSpan")), 20)
    rows = _series(spark, sf).groupBy("DeviceId", "LocationId", "SensorTyId").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    return rows.select("DeviceId", "LocationId", "SensorTyId", from_minutes(F.col("a")).alias("first_window"), from_minutes(F.col("b")).alias("last_window"))


@_query("A-13", "SELECT count(*) FILTER (WHERE o_orderkey % 100 IN (87, 43, 89, 42)) AS by_solution, count(*) FILTER (WHERE o_orderkey % 7 <> 6) AS not_closed FROM orders", cte=False)
def _(spark, sf):
    return measures.count_measures(t.alerts(spark, sf), {"by_solution": F.col("Fk_Solucion").isin(87, 43, 89, 42), "not_closed": F.col("Fk_EstatusAlerta") != 6})


@_query("W-1", f""", {_CURRENT}, r AS (SELECT DeviceId, SensorId, ReadId, LocalTimeSpan, date_trunc('hour', LocalTimeSpan) AS h, CASE WHEN CAST(Value AS DOUBLE) <= {LO} THEN 1 ELSE 0 END AS bad FROM cur),
s AS (SELECT *, CASE WHEN bad = 1 AND coalesce(lag(bad) OVER w, 0) = 0 THEN 1 ELSE 0 END AS starts FROM r WINDOW w AS (PARTITION BY DeviceId, SensorId, h ORDER BY LocalTimeSpan, ReadId)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY DeviceId, SensorId, h ORDER BY LocalTimeSpan, ReadId ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s)
SELECT DeviceId, SensorId, h AS HourStart, min(LocalTimeSpan) AS run_start, max(LocalTimeSpan) AS run_end, count(*) AS run_length FROM g WHERE bad = 1 GROUP BY DeviceId, SensorId, h, run""")
def _(spark, sf):
    return bad_runs(t.enriched(spark, sf).where("_sensor_type = 'Corriente'"), LO)


@_query("W-1-hours", f""", {_CURRENT}, r AS (SELECT ReadId, LocalTimeSpan, date_trunc('hour', LocalTimeSpan) AS h, CASE WHEN CAST(Value AS DOUBLE) <= {LO} THEN 1 ELSE 0 END AS bad FROM cur),
s AS (SELECT *, CASE WHEN bad = 1 AND coalesce(lag(bad) OVER w, 0) = 0 THEN 1 ELSE 0 END AS starts FROM r WINDOW w AS (PARTITION BY h ORDER BY LocalTimeSpan, ReadId)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY h ORDER BY LocalTimeSpan, ReadId ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s)
SELECT h AS HourStart, min(LocalTimeSpan) AS run_start, max(LocalTimeSpan) AS run_end, count(*) AS run_length FROM g WHERE bad = 1 GROUP BY h, run""")
def _(spark, sf):
    """Of all devices of an hour together, as the reference has it, in chunks of five minutes."""
    return bad_runs_chunked(t.enriched(spark, sf).where("_sensor_type = 'Corriente'"), LO, keys=(), chunk_minutes=5)


@_query("W-1-across", f""", {_CURRENT}, r AS (SELECT DeviceId, SensorId, ReadId, LocalTimeSpan, CASE WHEN CAST(Value AS DOUBLE) <= {LO} THEN 1 ELSE 0 END AS bad FROM cur),
s AS (SELECT *, CASE WHEN bad = 1 AND coalesce(lag(bad) OVER w, 0) = 0 THEN 1 ELSE 0 END AS starts FROM r WINDOW w AS (PARTITION BY DeviceId, SensorId ORDER BY LocalTimeSpan, ReadId)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY DeviceId, SensorId ORDER BY LocalTimeSpan, ReadId ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM s)
SELECT DeviceId, SensorId, min(LocalTimeSpan) AS run_start, max(LocalTimeSpan) AS run_end, count(*) AS run_length FROM g WHERE bad = 1 GROUP BY DeviceId, SensorId, run""")
def _(spark, sf):
    """Runs that go on over hours and days."""
    return bad_runs_chunked(t.enriched(spark, sf).where("_sensor_type = 'Corriente'"), LO, within_hour=False)


@_query("G-1", f"{_W} SELECT DeviceId, LocationId, SensorTyId, xw FROM sp")
def _(spark, sf):
    rows = _series(spark, sf).withColumn("xw", floor_to(minute_index(F.col("LocalTimeSpan")), 20))
    return grid(rows, ["DeviceId", "LocationId", "SensorTyId"], "xw", 20).withColumn("xw", from_minutes(F.col("xw")))


@_query("G-2", f"SELECT ReadId, {_B5} AS five, {_bucket_sql(240)} AS four_hours FROM readings")
def _(spark, sf):
    return t.readings(spark, sf).select("ReadId", bucket(F.col("LocalTimeSpan"), 5).alias("five"), bucket(F.col("LocalTimeSpan"), 240).alias("four_hours"))


@_query("G-3", "SELECT ReadId, date_trunc('hour', LocalTimeSpan) AS h FROM readings")
def _(spark, sf):
    return t.readings(spark, sf).select("ReadId", hour(F.col("LocalTimeSpan")).alias("h"))


@_query("U-2", "SELECT DISTINCT DeviceId, date_trunc('hour', LocalTimeSpan) AS LocalTimeSpan FROM ext")
def _(spark, sf):
    return t.enriched(spark, sf).select("DeviceId", hour(F.col("LocalTimeSpan")).alias("LocalTimeSpan")).distinct()


_KEY = "md5(concat_ws('|', DeviceId, strftime(h, '%Y-%m-%d %H:%M:%S')))"
_UUID = f"concat_ws('-', substr({_KEY}, 1, 8), substr({_KEY}, 9, 4), substr({_KEY}, 13, 4), substr({_KEY}, 17, 4), substr({_KEY}, 21, 12))"


@_query("K-1", f"SELECT DISTINCT DeviceId, h AS LocalTimeSpan, {_UUID} AS OperationId FROM (SELECT DeviceId, date_trunc('hour', LocalTimeSpan) AS h FROM ext)")
def _(spark, sf):
    return t.enriched(spark, sf).select("DeviceId", hour(F.col("LocalTimeSpan")).alias("LocalTimeSpan")).distinct().withColumn("OperationId", operation_id())


# Equipment families, facts and measures


def _rule_sql(rule: tuple) -> tuple[str, str]:
    """Common table expressions of one rule, and the select of its rows."""
    k, family, sensor, windowed, lo, hi, window, share, kept = rule
    types = ", ".join(f"'{d}'" for d in FAMILIES[family] if not (k == 7 and "deshielo" in d))
    name = " AND _sensor_name <> 'Resistencia de deshielo'" if k == 7 else ""
    source = f"f{k} AS (SELECT * FROM ext WHERE _device_type IN ({types}) AND _sensor_type = '{sensor}'{name})"
    anomalies = "anomalies" if kept else "CAST(NULL AS BIGINT)"
    if windowed:
        return f"{source}, {_windowed_sql(f'r{k}', f'f{k}', lo, hi, window).strip()}", f"SELECT DeviceId, LocationId, SensorTyId, CAST(status AS INTEGER) AS StatusCode, round(mv, 6) AS MeasurementValue, {anomalies} AS \"Anomalies\", h, _sensor_type FROM r{k}out"
    return f"{source}, r{k}out AS ({_threshold_sql(f'f{k}', lo, hi)})", f"SELECT DeviceId, LocationId, SensorTyId, CAST(CASE WHEN ok / total >= 0.5 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode, round({'ok / total' if share else 'mv'}, 6) AS MeasurementValue, {anomalies} AS \"Anomalies\", h, _sensor_type FROM r{k}out"


def _family_sql(family: str | None) -> str:
    parts = [_rule_sql(r) for r in RULES if family in (None, r[1])]
    return ", " + ", ".join(p for p, _ in parts) + ", allrows AS (" + " UNION ALL ".join(q for _, q in parts) + ")"


_STATUS = f"SELECT {_UUID} AS OperationId, DeviceId, LocationId, SensorTyId, StatusCode, MeasurementValue, \"Anomalies\", h AS LocalTimeSpan, _sensor_type FROM allrows"


def _family(name: str | None) -> Query:
    def run(spark, sf):
        out = status.hourly_reading_status(t.enriched(spark, sf)) if name is None else status.family_status(t.enriched(spark, sf), name)
        return _rounded(out, "MeasurementValue")

    return run


for _k, _name in enumerate([*FAMILIES, None], 1):
    _query(f"F-{_k}", f"{_family_sql(_name)} {_STATUS}")(_family(_name))

_FLAG = lambda s, n: f"max(CASE WHEN _sensor_type = '{s}' THEN CASE StatusCode WHEN 1 THEN 1 WHEN 3 THEN 0 END END) AS {n}"
_DEVICES = f"""{_family_sql(None)}, flags AS (SELECT DeviceId, LocationId, h, CAST(sum("Anomalies") AS BIGINT) AS anomalies, {_FLAG('Corriente', 'a')}, {_FLAG('Presión', 'p')}, {_FLAG('Temperatura', 't')}, {_FLAG('Encendido', 'e')}, {_FLAG('On/Off Termostato', 'x')} FROM allrows GROUP BY ALL),
devices AS (SELECT DeviceId, h, anomalies, CAST(CASE concat_ws('', coalesce(CAST(a AS VARCHAR), '_'), coalesce(CAST(p AS VARCHAR), '_'), coalesce(CAST(t AS VARCHAR), '_'), coalesce(CAST(e AS VARCHAR), '_'), coalesce(CAST(x AS VARCHAR), '_'))
  WHEN '1____' THEN 1 WHEN '11___' THEN 1 WHEN '10___' THEN 2 WHEN '1_0__' THEN 4 WHEN '1_1__' THEN 1 WHEN '__1__' THEN 1 WHEN '__0__' THEN 4 WHEN '___1_' THEN 1 WHEN '1__1_' THEN 1 WHEN '0__1_' THEN 1 WHEN '__1_1' THEN 1 WHEN '__0_1' THEN 1 ELSE 3 END AS INTEGER) AS status FROM flags)"""


@_query("A-9", f"{_DEVICES} SELECT DeviceId, {_UUID} AS OperationId, h AS LocalTimeSpan, status AS StatusCode, anomalies AS \"Anomalies\" FROM devices")
def _(spark, sf):
    return device_status(status.hourly_reading_status(t.enriched(spark, sf)))


_BUILT = f"{_hi} AS \"ModifiedAt\""
_DEVICE_FACT = f"SELECT {_UUID} AS OperationId, DeviceId, h AS LocalTimeSpan, CAST(status AS SMALLINT) AS StatusCode, CAST(anomalies AS INTEGER) AS \"Anomalies\", {_BUILT}, CAST(h AS DATE) AS Fecha, strftime(h, '%H:%M:%S') AS Hora FROM devices"
_READING_FACT = f"SELECT {_UUID} AS OperationId, SensorTyId, CAST(StatusCode AS SMALLINT) AS StatusCode, CAST(MeasurementValue AS DECIMAL(9,4)) AS MeasurementValue, CAST(\"Anomalies\" AS INTEGER) AS \"Anomalies\", {_BUILT} FROM allrows"


def _facts(spark, sf):
    return build_facts(t.readings(spark, sf), t.dimensions(spark, sf), HI_TS, t.load(spark, sf, "customer"))


@_query("F-8", f"{_DEVICES} {_DEVICE_FACT}")
def _(spark, sf):
    return _plain(_facts(spark, sf).devices, "ModifiedAt")


@_query("F-8-readings", f"{_family_sql(None)} {_READING_FACT}")
def _(spark, sf):
    return _plain(_facts(spark, sf).readings, "ModifiedAt")


def _updated(spark, sf) -> tuple[str, str]:
    """The fact tables after four runs, each given what is new: three stretches of time, and one reading in ten that comes late."""
    root, r = _scratch(spark, "facts"), t.readings(spark, sf)
    late, at = F.crc32("ReadId") % 10 == 0, F.col("TimeSpan")
    lit = lambda x: F.lit(x).cast("timestamp_ntz")
    parts = [~late & (at < lit(LO_TS)), ~late & (at >= lit(LO_TS)) & (at < lit(HI_TS)), ~late & (at >= lit(HI_TS)), late]
    dimensions = lake.hand_off(t.dimensions(spark, sf), _scratch(spark, "dimensions"))  # joined once for all runs
    for k, part in enumerate(parts):
        partials.update_facts(spark, r.where(part), dimensions, root, f"{root}/devices", f"{root}/readings", f"run-{k}", HI_TS, t.load(spark, sf, "customer"))
    return f"{root}/devices", f"{root}/readings"


@_query("F-8-incremental", f"{_DEVICES} {_DEVICE_FACT}")
def _(spark, sf):
    """By stored sums of five minutes, equal to what all readings give at once."""
    return _plain(spark.read.parquet(_updated(spark, sf)[0]), "ModifiedAt")


@_query("F-8-incremental-readings", f"{_family_sql(None)} {_READING_FACT}")
def _(spark, sf):
    rows = spark.read.parquet(_updated(spark, sf)[1]).drop("LocalTimeSpan", "Fecha")
    return _plain(rows, "ModifiedAt")


@_query("M-1", "SELECT * FROM not_armed")
def _(spark, sf):
    return measures.stores_not_armed(t.open_alerts(spark, sf), t.communicators(spark, sf), t.alarm_events(spark, sf), t.event_codes(spark))


@_query("M-4", "SELECT nullif(n, 0) AS n_not_armed, nullif(m, 0) AS n_by_solution, nullif(n + m, 0) AS n_total FROM (SELECT (SELECT count(*) FROM not_armed) AS n, (SELECT count(*) FROM orders WHERE o_orderkey % 100 IN (87, 43, 89, 42)) AS m)")
def _(spark, sf):
    return measures.not_armed_total(_Q["M-1"](spark, sf), t.alerts(spark, sf))


@_query("M-2", "SELECT count(*) AS n FROM not_armed")
def _(spark, sf):
    return _Q["M-1"](spark, sf).agg(F.count("*").alias("n"))


@_query("M-3", "SELECT count(*) FILTER (WHERE o_orderkey % 100 IN (87, 43, 89, 42)) AS n FROM orders", cte=False)
def _(spark, sf):
    return measures.count_measures(t.alerts(spark, sf), {"n": F.col("Fk_Solucion").isin(87, 43, 89, 42)})


@_query("M-5", "SELECT count(*) FILTER (WHERE o_orderkey % 5 = 0) AS closing, count(*) FILTER (WHERE o_orderkey % 5 = 1) AS opening, count(*) FILTER (WHERE o_orderkey % 5 = 2) AS movement FROM orders", cte=False)
def _(spark, sf):
    return measures.alerts_by_description(t.alerts(spark, sf), t.alert_types(spark, sf), dict(zip(("closing", "opening", "movement"), t.DESCRIPTIONS, strict=False)))


def _opportunity_sql(module: str, source: str, where: str = "") -> str:
    flag = next(k for k, v in t.MODULES.items() if v == module)
    value = "l_extendedprice" if source == "module" else "o_totalprice"
    return f"""SELECT Fecha, Fk_Tienda, '{module}' AS Fk_ModuloEvaluable, round(avg(CAST(x AS DOUBLE)), 8) AS Oportunidad FROM (
      SELECT CAST(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate + INTERVAL 6 DAYS AS DATE), INTERVAL 1 DAY)) AS DATE) AS Fecha, o_custkey AS Fk_Tienda, CAST({value} / 7 AS DECIMAL(9,4)) AS x
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = '{flag}') {where} GROUP BY Fecha, Fk_Tienda"""


def _opportunity(module: str, source: str, **dates: str) -> Query:
    return lambda spark, sf: _rounded(measures.daily_opportunity(t.evaluations(spark, sf), t.modules(spark, sf), module, source, **dates), "Oportunidad", digits=8)


_query("M-8", _opportunity_sql("SEG", "evaluation", "WHERE Fecha >= DATE '1996-01-01' AND Fecha <= DATE '1997-12-31'"), cte=False)(_opportunity("SEG", "evaluation", since="1996-01-01", until="1997-12-31"))
_query("M-9", _opportunity_sql("SEG", "module"), cte=False)(_opportunity("SEG", "module"))
_query("M-10", _opportunity_sql("MTO", "module"), cte=False)(_opportunity("MTO", "module"))


@_query("M-11", f"{_family_sql(None)} SELECT {_UUID} AS OperationId, DeviceId, LocationId, SensorTyId, h AS LocalTimeSpan, {_DECODE.replace('CASE status', 'CASE StatusCode')} AS Estatus, MeasurementValue AS Valor, \"Anomalies\" AS Anomalias, CAST(h AS DATE) AS Fecha, strftime(h, '%H:%M:%S') AS Hora FROM allrows")
def _(spark, sf):
    return _rounded(operations_view(status.hourly_reading_status(t.enriched(spark, sf))), "Valor")


# Streaming


def _events(spark, sf):
    """The events table as a stream: of the part files where the table is a folder, else of the one file beside the other tables."""
    stream, path = spark.readStream.schema(t.load(spark, sf, "events").schema), f"{sf}/events.parquet"
    if files.is_folder(spark, path):
        return stream.parquet(path)
    return stream.option("pathGlobFilter", "events.parquet").parquet(sf)


def _event_stream(spark, sf):
    """The events table as a stream of enriched readings."""
    e = _events(spark, sf)
    ts = F.col("ts").cast("timestamp")
    r = e.select(F.col("event_id").cast("string").alias("ReadId"), F.col("user_id").cast("string").alias("s_"), ts.alias("LocalTimeSpan"), F.col("value").alias("Value"))
    d = t.dimensions(spark, sf).where("_sensor_type = 'Corriente'")
    return r.join(d, F.col("s_") == F.col("SensorId")).drop("s_")


def _run_stream(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    out = _scratch(spark, name)
    streaming.ingest(df, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


@_query("S-1", "SELECT CAST(event_id AS VARCHAR) AS ReadId, CAST(user_id AS VARCHAR) AS SensorId, CAST(value AS DECIMAL(19,9)) AS Value FROM events", cte=False)
def _(spark, sf):
    """Three arrivals one after another. Readings of the last hours come again in the next one an hour later, within the time for which ids are known; ones of the arrival before come again as they were, too late to count."""
    r, out, hour = _stamped(t.readings(spark, sf)), _scratch(spark, "ingest"), F.expr("INTERVAL 1 HOUR")
    third = F.when(F.col("TimeSpan") < F.lit(LO_TS), 0).when(F.col("TimeSpan") < F.lit(HI_TS), 1).otherwise(2)
    recent = F.col("TimeSpan") >= F.when(third == 0, F.lit(LO_TS)).otherwise(F.lit(HI_TS)) - hour
    come = lambda k, ts: F.struct(k.alias("arrival"), ts.alias("at"))
    again = F.when((third < 2) & recent, come(third + 1, F.col("TimeSpan") + hour)).when((third < 2) & ~recent & (F.crc32("ReadId") % 10 == 0), come(third + 1, F.col("TimeSpan")))
    rows = r.withColumn("c", F.explode(F.array_compact(F.array(come(third, F.col("TimeSpan")), again))))
    rows = rows.withColumns({"TimeSpan": F.col("c.at"), "arrival": F.col("c.arrival")}).drop("c")

    def run(source: str) -> None:
        once = streaming.readings_stream(spark, source, r.schema, recursiveFileLookup="true")
        streaming.ingest(once.select("ReadId", "SensorId", "Value"), f"{out}/rows", f"{out}/state").awaitTermination()

    _arrive(spark, rows, 3, run)
    return spark.read.schema(r.select("ReadId", "SensorId", "Value").schema).parquet(f"{out}/rows")


def _arrive(spark, rows: DataFrame, n: int, run: Callable[[str], None]) -> None:
    """Rows of ``arrival`` 0 to n - 1 come into a folder one after another; after each, ``run`` takes by a stream what is new there, as one micro-batch. They are written at once, by all tasks that read them."""
    staged, source = _scratch(spark, "staged"), _scratch(spark, "arriving")
    rows.write.partitionBy("arrival").parquet(staged)
    for k in range(n):
        if files.exists(spark, f"{staged}/arrival={k}"):
            files.move(spark, f"{staged}/arrival={k}", f"{source}/{k}")
            run(source)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("TimeSpan", "LocalTimeSpan")})


@_query("S-2", f", {_CURRENT}, s AS ({_threshold_sql('cur', LO, None)}) SELECT DeviceId, LocationId, SensorTyId, h AS LocalTimeSpan, round(mv, 6) AS MeasurementValue, CAST(CASE WHEN ok / total >= 0.5 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode, ok AS is_okay, total AS total_readings, anomalies AS \"Anomalies\" FROM s WHERE h + INTERVAL 1 HOUR <= (SELECT max(LocalTimeSpan) FROM cur) - INTERVAL 2 HOURS")
def _(spark, sf):
    rows = _run_stream(spark, streaming.streaming_threshold(_event_stream(spark, sf), LO), "threshold")
    return _rounded(_plain(rows.select("DeviceId", "LocationId", "SensorTyId", "LocalTimeSpan", "MeasurementValue", "StatusCode", "is_okay", "total_readings", "Anomalies"), "LocalTimeSpan"), "MeasurementValue")


@_query("S-3-duty")
def _(spark, sf):
    rows = _run_stream(spark, streaming.streaming_windowed(_event_stream(spark, sf), LO), "windowed")
    return _plain(rows.select("DeviceId", "LocationId", "SensorTyId", "LocalTimeSpan", "is_okay", "StatusCode"), "LocalTimeSpan")


_SQL["S-3-duty"] = f"WITH {t.SQL} {_W} SELECT DeviceId, LocationId, SensorTyId, h AS LocalTimeSpan, count(*) FILTER (WHERE vm > {LO}) AS is_okay, CAST(CASE WHEN count(*) FILTER (WHERE vm > {LO}) / 12.0 >= 0.3 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode FROM d WHERE h + INTERVAL 1 HOUR <= (SELECT max(LocalTimeSpan) FROM cur) - INTERVAL 2 HOURS GROUP BY DeviceId, LocationId, SensorTyId, h"


_GAPS = """, lim AS (SELECT date_trunc('hour', max(LocalTimeSpan) - INTERVAL 2 HOURS) AS l FROM cur),
gsp AS (SELECT DeviceId, LocationId, SensorTyId, _sensor_type, unnest(generate_series(min(xw), (SELECT l FROM lim) - INTERVAL '20 minutes', INTERVAL '20 minutes')) AS xw FROM b WHERE DeviceId IS NOT NULL GROUP BY DeviceId, LocationId, SensorTyId, _sensor_type),
gan AS (SELECT s.DeviceId, s.LocationId, s.SensorTyId, s._sensor_type, date_trunc('hour', s.xw) AS h, least(count(*) FILTER (WHERE coalesce(n, 0) = 0 OR z = n OR (n < {lo} AND z > 0)), 3) AS anomalies
  FROM gsp s LEFT JOIN ag a ON s.DeviceId = a.DeviceId AND s.LocationId = a.LocationId AND s.SensorTyId = a.SensorTyId AND s.xw = a.xw GROUP BY ALL),
gok AS (SELECT DeviceId, LocationId, SensorTyId, h, count(*) FILTER (WHERE vm > {lo}) AS ok FROM d GROUP BY ALL)
SELECT g.DeviceId, g.LocationId, g.SensorTyId, g.h AS LocalTimeSpan, round(mv, 6) AS MeasurementValue, coalesce(n, 0) AS total_sensors, coalesce(ok, 0) AS is_okay,
  CAST(CASE WHEN coalesce(ok, 0) / 12.0 >= 0.3 THEN 1 ELSE 3 END AS INTEGER) AS StatusCode, anomalies AS "Anomalies"
FROM gan g LEFT JOIN val v ON g.DeviceId = v.DeviceId AND g.LocationId = v.LocationId AND g.SensorTyId = v.SensorTyId AND g.h = v.h
  LEFT JOIN gok o ON g.DeviceId = o.DeviceId AND g.LocationId = o.LocationId AND g.SensorTyId = o.SensorTyId AND g.h = o.h"""


@_query("S-3", f"{_W} {_GAPS.format(lo=LO)}")
def _(spark, sf):
    """With values, and with the hours in which nothing came."""
    rows = _run_stream(spark, gaps.streaming_status_with_gaps(_event_stream(spark, sf), LO), "windowed")
    return _rounded(_plain(rows.drop("_sensor_type"), "LocalTimeSpan"), "MeasurementValue")


@_query("S-4", "SELECT CAST(event_id AS VARCHAR) AS ReadId, CAST(user_id AS VARCHAR) AS SensorId, ts AS TimeSpan, ts AS LocalTimeSpan, CAST(value AS DECIMAL(19,9)) AS Value FROM events", cte=False)
def _(spark, sf):
    """A lake in which every value is wrong by one is put right by a stream of six micro-batches. The first ones have whole days, and say so; the last has one reading in twenty, late: they replace nothing."""
    root, r = _scratch(spark, "lake"), _stamped(t.readings(spark, sf))
    lake.write_readings(r.withColumn("Value", F.col("Value") + 1), root)
    late, day = F.crc32("ReadId") % 20 == 0, F.unix_date(F.to_date("TimeSpan"))
    rows = r.withColumns({"late": late, "arrival": F.when(late, 5).otherwise(F.pmod(day, F.lit(5)))})
    days = r.select(F.date_trunc("day", "TimeSpan").alias("since")).distinct().withColumn("until", F.col("since") + F.expr("INTERVAL 1 DAY"))
    complete = streaming.declared(lake.hand_off(days, _scratch(spark, "days")))
    replacing = streaming.replacing_lake(root, lambda batch, n: complete(batch.where("not late"), n))

    def run(source: str) -> None:
        stream = spark.readStream.schema(rows.drop("arrival").schema).option("recursiveFileLookup", "true").parquet(source)
        stream.writeStream.foreachBatch(replacing).option("checkpointLocation", f"{root}-state").trigger(availableNow=True).start().awaitTermination()

    _arrive(spark, rows, 6, run)
    return _plain(spark.read.parquet(root).select("ReadId", "SensorId", "TimeSpan", "LocalTimeSpan", "Value"), "TimeSpan", "LocalTimeSpan")


# Operators that are parts of the queries above, on their own


def _appended(spark, rows: DataFrame, keys: list[list[str]]) -> DataFrame:
    """Rows written to a new table in two runs that overlap: what is there already is left out."""
    path = _scratch(spark, "fact")
    first = rows.where(F.pmod(F.xxhash64(*keys[0]), F.lit(2)) == 0)
    incremental.write_new(first, rows.limit(0), path, *keys)
    incremental.write_new(rows, spark.read.schema(rows.schema).parquet(path), path, *keys)
    return spark.read.schema(rows.schema).parquet(path)


@_query("L-5", f"{_family_sql(None)} {_READING_FACT}")
def _(spark, sf):
    return _plain(_appended(spark, _facts(spark, sf).readings, [["OperationId", "SensorTyId"]]), "ModifiedAt")


@_query("L-6", f"{_DEVICES} {_DEVICE_FACT}")
def _(spark, sf):
    return _plain(_appended(spark, _facts(spark, sf).devices, [["OperationId"], ["DeviceId", "LocalTimeSpan"]]), "ModifiedAt")


@_query("L-21", f"SELECT (SELECT count(*) = 0 FROM readings) AS is_empty UNION ALL SELECT (SELECT count(*) = 0 FROM readings WHERE TimeSpan > {_hi} AND TimeSpan < {_lo})")
def _(spark, sf):
    r = t.readings(spark, sf)
    return incremental.is_empty(r).unionByName(incremental.is_empty(r.where((F.col("TimeSpan") > F.lit(HI_TS)) & (F.col("TimeSpan") < F.lit(LO_TS)))))


@_query("J-6", "SELECT o_orderkey AS Id, o_custkey AS Fk_Tienda, l_extendedprice AS Oportunidad FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'A'", cte=False)
def _(spark, sf):
    m = t.modules(spark, sf).where("Fk_ModuloEvaluable = 'SEG'").select(F.col("Fk_EvaluacionGeneral").alias("Id"), "Oportunidad")
    return t.evaluations(spark, sf).select("Id", "Fk_Tienda").join(m, "Id")


@_query("J-8", f"{_W} SELECT DeviceId, LocationId, SensorTyId, h AS LocalTimeSpan, {_UUID} AS OperationId FROM out")
def _(spark, sf):
    rows = status.windowed_status(t.enriched(spark, sf), "Corriente", LO, None, 20)
    return rows.select("DeviceId", "LocationId", "SensorTyId", "LocalTimeSpan", operation_id().alias("OperationId"))


@_query("A-11", "SELECT max(LocalTimeSpan) AS latest, max(ReadId) AS latest_id FROM readings")
def _(spark, sf):
    return t.readings(spark, sf).agg(F.max("LocalTimeSpan").alias("latest"), F.max("ReadId").alias("latest_id"))


_query("A-12", _opportunity_sql("MTO", "evaluation"), cte=False)(_opportunity("MTO", "evaluation"))


@_query("A-14", "SELECT nullif((SELECT count(*) FROM not_armed) + (SELECT count(*) FROM orders WHERE o_orderkey % 100 IN (87, 43, 89, 42)), 0) AS n_total")
def _(spark, sf):
    return _Q["M-4"](spark, sf).select("n_total")


@_query("M-6", "SELECT count(*) FILTER (WHERE o_orderkey % 5 = 1) AS n FROM orders", cte=False)
def _(spark, sf):
    return measures.alerts_by_description(t.alerts(spark, sf), t.alert_types(spark, sf), {"n": t.DESCRIPTIONS[1]})


@_query("M-7", "SELECT count(*) FILTER (WHERE o_orderkey % 5 = 2) AS n FROM orders", cte=False)
def _(spark, sf):
    return measures.alerts_by_description(t.alerts(spark, sf), t.alert_types(spark, sf), {"n": t.DESCRIPTIONS[2]})


@_query("U-1", f"{_family_sql(None)} {_STATUS}")
def _(spark, sf):
    rows, families = t.enriched(spark, sf), list(FAMILIES)
    return _rounded(status.hourly_reading_status(rows, families[:3]).unionByName(status.hourly_reading_status(rows, families[3:])), "MeasurementValue")


@_query("U-3", f"{_DEVICES} SELECT * FROM ({_DEVICE_FACT}) WHERE false")
def _(spark, sf):
    """Facts of a window without readings: no rows, but all columns."""
    none = t.readings(spark, sf).where((F.col("TimeSpan") > F.lit(HI_TS).cast("timestamp_ntz")) & (F.col("TimeSpan") < F.lit(LO_TS).cast("timestamp_ntz")))
    return _plain(build_facts(none, t.dimensions(spark, sf), HI_TS, t.load(spark, sf, "customer")).devices, "ModifiedAt")


@_query("U-4", "SELECT * FROM readings")
def _(spark, sf):
    """Files of a good size, whatever the number of tasks was."""
    return t.readings(spark, sf).hint("rebalance")
