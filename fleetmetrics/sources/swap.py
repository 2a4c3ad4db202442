"""Days of several tables replaced together: after a crash at any point all of them are old, or all are new.

The new days of every table are written to a hidden folder in it first (``_staged-...``), which readers pass over. A file
in the journal then says what is to be put where: from then on the run counts. Its days are moved into place one by one,
and the file becomes the record of a finished run. Whoever uses the journal next finishes what is on record, and throws
away what was staged without a record (:meth:`Journal.recover`).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.sources import files

_STAGED = "_staged-"


@dataclass
class Change:
    """New rows for some days of the table at ``path``, which is parquet partitioned by ``day``: they replace all that it has for those days. ``spans`` are first and last days. Rows of other days are an error."""

    path: str
    rows: DataFrame
    day: str
    spans: list[tuple[date, date]]
    #: Observed in the write: name -> aggregate.
    measures: dict = field(default_factory=dict)


def days_of(spark: SparkSession, path: str, day: str) -> list[date]:
    """The days that a table has, from its folders."""
    return [date.fromisoformat(n.split("=", 1)[1]) for n in files.names(spark, path) if n.startswith(f"{day}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]


class Journal:
    """The record of runs that replace days. Runs that share tables share a journal; they are not to run at the same time (see :mod:`ledger`)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _file(self, state: str, run: str) -> str:
        return f"{self.root}/{state}/{run}"

    def is_done(self, run: str) -> bool:
        return files.exists(self.spark, self._file("done", run))

    def recover(self, tables: list[str] = ()) -> list[str]:
        """Finish the runs that are on record, and delete what others have left staged in ``tables``. Returns the names of the finished ones."""
        pending = [n for n in files.names(self.spark, f"{self.root}/pending") if not n.startswith((".", "_"))]
        for run in pending:
            self._apply(run)
        for path in tables:
            for name in files.names(self.spark, path):
                if name.startswith(_STAGED):
                    files.delete(self.spark, f"{path}/{name}")
        return pending

    def replace(self, run: str, changes: list[Change]) -> dict[str, dict]:
        """Make the changes of a run, all or none, and return what was observed of each table. A run that is done already changes nothing and gives no figures."""
        self.recover([c.path for c in changes])
        if self.is_done(run):
            return {}
        seen = {c.path: self._stage(run, c) for c in changes}
        plan = [self._plan(run, c) for c in changes]
        files.publish(self.spark, self._file("pending", run), json.dumps(plan))
        self._apply(run)
        return seen

    def _stage(self, run: str, change: Change) -> dict:
        seen = Observation()
        measures = {"n": F.count(F.lit(1))} | change.measures
        rows = change.rows.observe(seen, *[m.alias(n) for n, m in measures.items()])
        rows.hint("rebalance", change.day).write.partitionBy(change.day).parquet(f"{change.path}/{_STAGED}{run}")
        return seen.get

    def _plan(self, run: str, change: Change) -> dict:
        staged = f"{change.path}/{_STAGED}{run}"
        moved = days_of(self.spark, staged, change.day)
        within = lambda d: any(first <= d <= last for first, last in change.spans)
        if not all(map(within, moved)):
            files.delete(self.spark, staged)
            raise ValueError(f"{change.path}: rows of days that are not to be replaced")
        gone = [d for d in days_of(self.spark, change.path, change.day) if within(d) and d not in moved]
        folder = lambda d: f"{change.day}={d}"
        return {"path": change.path, "staged": staged, "move": [folder(d) for d in moved], "drop": [folder(d) for d in gone]}

    def _apply(self, run: str) -> None:
        """Each step may have been done before."""
        for table in json.loads(files.read_text(self.spark, self._file("pending", run))):
            for name in table["drop"]:
                files.delete(self.spark, f"{table['path']}/{name}")
            for name in table["move"]:
                if files.exists(self.spark, f"{table['staged']}/{name}"):
                    files.delete(self.spark, f"{table['path']}/{name}")
                    files.move(self.spark, f"{table['staged']}/{name}", f"{table['path']}/{name}")
            files.delete(self.spark, table["staged"])
        if not self.is_done(run):
            files.move(self.spark, self._file("pending", run), self._file("done", run))
