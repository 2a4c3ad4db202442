"""The ledger of runs as files: each state is a version, made by whoever creates its file first."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.functions.schemas import empty, schema
from fleetmetrics.sources import files, incremental

_NAME = "IngestionName"


class Busy(RuntimeError):
    """Another run has the window."""


class FrameLedger:
    """A ledger that is a frame only: what runs are given and what they leave."""

    def __init__(self, frame: DataFrame) -> None:
        self.frame = frame

    def begin(self, name: str, now: datetime, lookback_hours: int = 0) -> tuple[datetime, datetime]:
        """Mark a run as started, and give its window (L-13, L-15, L-16)."""
        self.frame, window = begun(self.frame, name, now, lookback_hours)
        return window

    def finish(self, name: str, now: datetime, succeeded: bool, loaded_at: datetime | None = None, error: str | None = None) -> None:
        """Mark it as ended (L-17): the watermark moves on success only."""
        self.frame = incremental.mark_completed(self.frame, name, now, succeeded, loaded_at, error)


class Ledger:
    """A ledger in a folder, one small file a version, of a row for each pipeline.

    A change reads the latest version and creates the next one, which fails if another run was faster; it then starts
    over from what that run has left. So of two runs that begin at once one is given the window, and the other
    :class:`Busy`, until the first has finished or has been running for ``stale`` (it is taken for dead then).
    """

    def __init__(self, spark: SparkSession, root: str, stale: timedelta = timedelta(hours=12)) -> None:
        self.spark, self.root, self.stale = spark, root.rstrip("/"), stale

    def _versions(self) -> list[int]:
        return [int(n[1:]) for n in files.names(self.spark, self.root) if n.startswith("v")]

    def load(self) -> tuple[int, DataFrame]:
        """The latest version and its rows; version 0 is empty."""
        version = max(self._versions(), default=0)
        to = schema("ingestion_control")
        if not version:
            return 0, empty(self.spark, "ingestion_control")
        rows = json.loads(files.read_text(self.spark, f"{self.root}/v{version:012d}"))
        texts = self.spark.createDataFrame([tuple(r[f.name] for f in to) for r in rows], ", ".join(f"{f.name} string" for f in to))
        return version, texts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in to])

    def store(self, frame: DataFrame, after: int) -> bool:
        """Make ``frame`` the version behind ``after``, unless that is there already."""
        rows = [r.asDict() for r in frame.select(*[F.col(c).cast("string") for c in frame.columns]).collect()]  # a row a pipeline
        return files.publish(self.spark, f"{self.root}/v{after + 1:012d}", json.dumps(rows))

    @property
    def frame(self) -> DataFrame:
        return self.load()[1]

    def begin(self, name: str, now: datetime, lookback_hours: int = 0) -> tuple[datetime, datetime]:
        """As :meth:`FrameLedger.begin`, for one run only."""
        while True:
            version, frame = self.load()
            mine = frame.where((F.col(_NAME) == name) & F.col("IsActive")).first()
            # A row that was made on first reading carries a note: nobody has started its run.
            if mine and mine.LastRunStatus == "RUNNING" and mine.LastRunError is None and now - mine.LastRunStartedAt < self.stale:
                raise Busy(f"{name} has been running since {mine.LastRunStartedAt}")
            frame, window = begun(frame, name, now, lookback_hours)
            if self.store(frame, version):
                return window

    def finish(self, name: str, now: datetime, succeeded: bool, loaded_at: datetime | None = None, error: str | None = None) -> None:
        while True:
            version, frame = self.load()
            if self.store(incremental.mark_completed(frame, name, now, succeeded, loaded_at, error), version):
                return

    def prune(self, keep: int = 100) -> None:
        """Delete all but the last versions."""
        for version in self._versions()[:-keep]:
            files.delete(self.spark, f"{self.root}/v{version:012d}")


def begun(frame: DataFrame, name: str, now: datetime, lookback_hours: int = 0) -> tuple[DataFrame, tuple[datetime, datetime]]:
    """The ledger after a run's start, with a row for it if there was none, and the run's window."""
    names = frame.sparkSession.createDataFrame([(name,)], f"{_NAME} string")
    frame = incremental.get_watermark(frame, names, now)
    window = incremental.load_window(frame.where((F.col(_NAME) == name) & F.col("IsActive")), now, lookback_hours).select("from_utc", "to_utc").first()
    return incremental.mark_started(frame, name, now), (window[0], window[1])
