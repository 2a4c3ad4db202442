"""Summaries of a table's keys by day, so that known keys are found without reading the table (L-4, L-9).

Beside a table that is partitioned by day lies, for each day, a Bloom filter of its keys: rows of a slot and its 64 bits.
A key has one slot and eight bits there; a day has a slot for every two keys, so a filter is some four bytes a key and
says falsely of one key in 20,000 or so that the day has it. What it says the day has not, it has not. So only the days
that may hold one of the incoming keys are read, only their key column, and only rows of suspected keys are compared.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.sources import files, incremental
from fleetmetrics.sources.swap import days_of

BITS, KEYS_A_SLOT, MOST_SLOTS_LOG = 8, 2, 36
_SCHEMA = "slots_log int, slot long, bits long"


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`"))


def _slot(h: Column, slots_log: Column) -> Column:
    """The upper bits of the hash."""
    return F.call_function("shiftrightunsigned", h, (F.lit(64) - slots_log).cast("int"))


def _bits(h: Column) -> Column:
    """Bits of the word, from a second hash of the first."""
    g, out = F.xxhash64(h, F.lit(1)), F.lit(0).cast("long")
    for i in range(BITS):
        at = F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return out


class KeyIndex:
    """The summaries of the table at ``path``, partitioned by ``day``, of its column ``key``. A day's summary is bound to the names of its files, so one that is out of date is never used."""

    def __init__(self, spark: SparkSession, path: str, day: str, key: str) -> None:
        self.spark, self.path, self.day, self.key, self.root = spark, path, day, key, f"{path}/_keys-{key}"

    def _stamps(self) -> dict[date, str]:
        listed = {d: files.names(self.spark, f"{self.path}/{self.day}={d}") for d in days_of(self.spark, self.path, self.day)}
        return {d: hashlib.md5("\n".join(n).encode()).hexdigest() for d, n in listed.items()}

    def _folder(self, day: date, stamp: str) -> str:
        return f"{self.root}/{day}-{stamp}"

    def refresh(self) -> list[date]:
        """Make the summaries of days that are new or have changed, and delete those of days that have gone. Only those days' keys are read. Returns them."""
        stamps, there = self._stamps(), set(files.names(self.spark, self.root))
        wanted = {f"{d}-{s}": d for d, s in stamps.items()}
        todo = {n: d for n, d in wanted.items() if n not in there}
        if todo:
            staged = f"{self.root}/_staged-{uuid.uuid4().hex}"
            self._summaries(sorted(todo.values())).write.partitionBy("day_").parquet(staged)
            for name, d in todo.items():  # a summary appears as a whole
                if files.exists(self.spark, f"{staged}/day_={d}"):
                    files.move(self.spark, f"{staged}/day_={d}", f"{self.root}/{name}")
            files.delete(self.spark, staged)
        for name in there - set(wanted):
            files.delete(self.spark, f"{self.root}/{name}")
        return sorted(todo.values())

    def _summaries(self, days: list[date]) -> DataFrame:
        rows = self.spark.read.parquet(self.path).where(F.col(self.day).isin(days)).select(F.col(self.day).alias("day_"), _hash(self.key).alias("h"))
        counts = rows.groupBy("day_").count()  # a row a day
        log = F.greatest(F.lit(4), F.least(F.lit(MOST_SLOTS_LOG), F.ceil(F.log2(F.col("count") / KEYS_A_SLOT)))).cast("int")
        sized = rows.join(F.broadcast(counts.select("day_", log.alias("slots_log"))), "day_")
        return sized.groupBy("day_", "slots_log", _slot(F.col("h"), F.col("slots_log")).alias("slot")).agg(F.bit_or(_bits(F.col("h"))).alias("bits"))

    def suspected(self, keys: DataFrame) -> tuple[DataFrame, list[date]]:
        """Of a frame with the key column the rows whose key a day may have, and those days. Days without a summary may have any key."""
        stamps, there = self._stamps(), set(files.names(self.spark, self.root))
        known = [self._folder(d, s) for d, s in stamps.items() if f"{d}-{s}" in there]
        unknown = [d for d, s in stamps.items() if f"{d}-{s}" not in there]
        if unknown or not known:
            return (keys, sorted(stamps)) if unknown else (keys.limit(0), [])
        summaries = self.spark.read.schema(_SCHEMA).parquet(*known).withColumn("day_", F.regexp_extract(F.input_file_name(), rf"/(\d+-\d\d-\d\d)-[0-9a-f]{{32}}/[^/]+$", 1).cast("date"))
        logs = [r[0] for r in summaries.select("slots_log").distinct().collect()]  # 33 at most
        h = _hash(self.key)
        probes = keys.withColumn("slots_log", F.explode(F.array(*map(F.lit, logs)))).withColumns({"slot": _slot(h, F.col("slots_log")), "mask_": _bits(h)})
        hits = probes.join(summaries, ["slots_log", "slot"]).where(F.col("bits").bitwiseAND(F.col("mask_")) == F.col("mask_"))
        hits = hits.select(f"`{self.key}`", "day_")
        days = sorted(r[0] for r in hits.select("day_").distinct().collect())
        return hits.select(f"`{self.key}`").distinct(), days

    def new_rows(self, incoming: DataFrame, target: DataFrame | None = None) -> DataFrame:
        """Incoming rows whose key the table has not, one a key (L-9). ``target`` is the table, or the part of it that counts. A null key is a key like any other.

        Of incoming rows with one key the one that :func:`incremental.new_rows` keeps stays.
        """
        target = self.spark.read.parquet(self.path) if target is None and files.exists(self.spark, self.path) else target
        first = incremental.new_rows(incoming, incoming.limit(0), [self.key])
        if target is None:
            return first
        suspects, days = self.suspected(incoming.select(f"`{self.key}`"))
        if not days:
            return first
        one, two = F.col(f"t_.`{self.key}`"), F.col(f"s_.`{self.key}`")
        held = target.where(F.col(self.day).isin(days)).select(f"`{self.key}`").alias("t_").join(suspects.alias("s_"), one.eqNullSafe(two), "left_semi")
        return first.alias("new_").join(held.alias("known_"), F.col(f"new_.`{self.key}`").eqNullSafe(F.col(f"known_.`{self.key}`")), "left_anti")
