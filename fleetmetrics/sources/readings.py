"""Reading the lake of sensor readings and other tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from fleetmetrics.functions.schemas import conform, schema
from fleetmetrics.sources import files, incremental
from fleetmetrics.sources.swap import Change, Journal

DAY = "event_date"


def read_readings_range(spark: SparkSession, root: str, since: datetime, until: datetime) -> DataFrame:
    """Readings with ``since <= TimeSpan <= until`` from parquet partitioned by ``event_date`` (L-1): days prune partitions, the range row groups. Missing days are empty."""
    df = spark.read.parquet(root)
    day = F.col("event_date")
    return between(df.where((day >= F.lit(since.date())) & (day <= F.lit(until.date()))), "TimeSpan", F.lit(since), F.lit(until))


def write_readings(readings: DataFrame, root: str) -> None:
    """Append readings partitioned by ``event_date``. Tasks are dealt out by date, and a large date is split among several."""
    _dated(readings).write.mode("append").partitionBy(DAY).parquet(root)


def _dated(readings: DataFrame) -> DataFrame:
    return conform(readings, "readings").withColumn(DAY, F.to_date("TimeSpan")).hint("rebalance", DAY)


def table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The parquet table at ``path``; a typed frame without rows if there is none yet."""
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def _lake(spark: SparkSession, root: str) -> DataFrame:
    to = schema("readings")
    return table(spark, root, StructType([StructField(f.name, f.dataType) for f in to] + [StructField(DAY, DateType())]))


def replace_readings(spark: SparkSession, root: str, incoming: DataFrame, since: datetime, until: datetime, journal: Journal | None = None, run: str | None = None) -> dict:
    """Replace the lake's readings of ``since <= TimeSpan < until`` by the incoming ones of that range (L-10).

    Only the range's days are read and written, each once: the others' partitions stay as they are. A day that has no
    reading left loses its partition. All days change together (:class:`Journal`). Returns n and latest of the readings
    that the days have now.
    """
    if since >= until:
        raise ValueError("the range must not be empty")
    t = F.col("TimeSpan")
    mine = conform(incoming, "readings").where((t >= F.lit(since)) & (t < F.lit(until)))
    return _replace(spark, root, mine, [(since, until)], [], None, journal, run)


def replace_windows(spark: SparkSession, root: str, incoming: DataFrame, windows: list[tuple[datetime, datetime]], key: str = "ReadId", journal: Journal | None = None, run: str | None = None) -> dict:
    """Replace what the lake has for the windows (half-open) by the incoming readings; those outside of all windows are added (S-4).

    A window says that the incoming readings are all that there are for that time. A reading outside, as one that is
    late, deletes nothing: it is added unless a day that is written has its key. Of incoming readings with one key one
    stays. With the name of a ``run``, a repeated call changes nothing.
    """
    for since, until in windows:
        if since >= until:
            raise ValueError("a window must not be empty")
    rows = conform(incoming, "readings")
    days = [r[0] for r in rows.where(~_in_windows(windows)).select(F.to_date("TimeSpan")).distinct().collect()]  # days, not rows
    return _replace(spark, root, rows, windows, [(d, d) for d in days if d is not None], key, journal, run)


def _in_windows(windows: list[tuple[datetime, datetime]]) -> Column:
    t, out = F.col("TimeSpan"), F.lit(False)
    for since, until in windows:
        out = out | ((t >= F.lit(since)) & (t < F.lit(until)))
    return out


def _replace(spark, root, rows, windows, spans, key, journal, run) -> dict:
    spans = [*spans, *[(since.date(), (until - timedelta(microseconds=1)).date()) for since, until in windows]]
    if not spans:
        return {}
    journal = journal or Journal(spark, f"{root}/_journal")
    journal.recover([root])  # before the lake is listed
    there, of_days = _lake(spark, root), F.lit(False)
    for first, last in spans:
        of_days = of_days | F.col(DAY).between(F.lit(first), F.lit(last))
    kept = there.where(of_days).drop(DAY).where(~_in_windows(windows))
    fresh = rows if key is None else incremental.new_rows(rows, kept, [key])
    now = kept.unionByName(fresh).withColumn(DAY, F.to_date("TimeSpan"))
    seen = journal.replace(run or f"run-{uuid.uuid4().hex}", [Change(root, now, DAY, spans, {"latest": F.max("TimeSpan")})])
    return seen.get(root, {})


def between(df: DataFrame, ts: str, lo, hi, closed: str = "both") -> DataFrame:
    """Rows of a time range (C-5): ``closed`` is both, left (half-open) or neither."""
    t = F.col(ts)
    low = t > lo if closed == "neither" else t >= lo
    high = t <= hi if closed == "both" else t < hi
    return df.where(low & high)


def since_bound(df: DataFrame, ts: str, bound) -> DataFrame:
    """Rows from a lower bound on; None, "" and "None" mean no bound (L-3)."""
    return df if bound in (None, "", "None") else df.where(F.col(ts) >= F.lit(bound).cast(df.schema[ts].dataType))


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str | None = None, partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A table over JDBC (L-2); Spark pushes filters on it down (L-3).

    With a partition column it is read in parallel: by stretches of equal width if ``bounds`` are given, else by
    stretches of about as many rows each (:func:`key_stretches`), for which the column must hold whole numbers.
    """
    options = options | {"url": url} | ({"driver": driver} if driver else {})
    if partition_column and bounds is None:
        return spark.read.jdbc(url, table, predicates=key_stretches(spark, table, partition_column, partitions, options), properties={k: v for k, v in options.items() if k != "url"})
    reader = spark.read.format("jdbc").option("dbtable", table).options(**options)
    if partition_column:
        lo, hi = bounds
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", str(lo)).option("upperBound", str(hi)).option("numPartitions", str(partitions))
    return reader.load()


#: Stretches into which one query of counts cuts the keys; and how many of the stretches that are left share the rows of a partition.
_CUTS, _FINE = 64, 8


def key_stretches(spark: SparkSession, table: str, column: str, partitions: int, options: dict) -> list[str]:
    """Predicates that cut a table into parts of about as many rows each, by a column of whole numbers; one more takes its nulls.

    The column's name is quoted as in standard SQL; the table's is taken as it is.

    The database counts rows by stretches of the keys; stretches with too many rows are counted again in finer ones, so
    a part has at most 1 + 1/8 times the mean, but where one key has more rows than that. Only counts are read.
    """

    column = '"' + column.replace('"', '""') + '"'

    def ask(sql: str) -> list:
        return spark.read.format("jdbc").option("dbtable", f"({sql}) q").options(**options).load().collect()

    low, high, n = ask(f"SELECT MIN({column}) AS a, MAX({column}) AS b, COUNT({column}) AS n FROM {table}")[0]
    if not n:
        return ["1 = 1"]
    most = max(1, int(n) // (partitions * _FINE))
    todo, counts = [(int(low), int(high) + 1, int(n))], {}
    while todo:
        a, b, rows = todo.pop()
        if rows <= most or b - a == 1:
            counts[a] = rows
            continue
        width = max(1, -(-(b - a) // _CUTS))
        found = ask(f"SELECT s, COUNT(*) AS n FROM (SELECT ({column} - ({a})) / {width} AS s FROM {table} WHERE {column} >= {a} AND {column} < {b}) t GROUP BY s")
        todo += [(a + int(s) * width, min(b, a + (int(s) + 1) * width), int(k)) for s, k in found]
    starts, held = [], 0
    for a in sorted(counts):
        if not starts or held >= n / partitions or held + counts[a] > n / partitions * (1 + 1 / _FINE):
            starts.append(a)
            held = 0
        held += counts[a]
    ends = [*starts[1:], None]
    bound = lambda a, b: " AND ".join([f"{column} >= {a}"] * (a != starts[0]) + [f"{column} < {b}"] * (b is not None)) or f"{column} IS NOT NULL"
    return [*[bound(a, b) for a, b in zip(starts, ends, strict=True)], f"{column} IS NULL"]


def write_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None, batch: int = 4000, **options: str) -> None:
    """Append to a table over JDBC."""
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).option("batchsize", str(batch)).options(**options)
    (writer.option("driver", driver) if driver else writer).save()


def hand_off(df: DataFrame, path: str) -> DataFrame:
    """Write a stage's result and read it back (L-18)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
