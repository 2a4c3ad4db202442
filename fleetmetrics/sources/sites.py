"""A source system of several databases (sites) in files, which any number of processes read over JDBC at once.

Spark brings the engine of Derby, but not its network server: a database that is written to belongs to one process. So a
task fills each site by Derby's own tool, in a process that ends with it, and packs it into a jar in the folder that
driver and executors share: Derby reads such a database from as many processes as like to.
"""

from __future__ import annotations

import glob
import os
import re
import shutil
import subprocess
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
#: A site has about as many rows at most, so that the work of a task does not grow with the table.
SITE_ROWS = 250_000


def build(rows: DataFrame, folder: str, table: str, types: dict[str, str]) -> list[str]:
    """Deal the rows of a table out to sites, and return their URLs. ``types`` are the SQL types of all columns; ``folder`` is a shared one that is mounted as a local path."""
    where = urlparse(folder)
    if where.scheme not in ("", "file"):
        raise ValueError(f"Derby reads no {where.scheme} files")
    n, root = max(4, -(-rows.count() // SITE_ROWS)), where.path
    columns = ", ".join(f'"{c}" {kind}' for c, kind in types.items())

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"url": [_site(batches, root, table, columns)]})

    return [r[0] for r in rows.select(*types).repartition(n).mapInArrow(fill, "url string").collect()]  # a row a site


def _site(batches: Iterator[pa.RecordBatch], root: str, table: str, columns: str) -> str:
    from pyarrow import csv

    with tempfile.TemporaryDirectory() as own:
        with open(f"{own}/rows.csv", "wb") as out:
            for b in batches:
                csv.write_csv(pa.Table.from_batches([b]), out, csv.WriteOptions(include_header=False))
        load = f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table}', '{own}/rows.csv', NULL, NULL, 'UTF-8', 0)"
        _ij(own, f"CONNECT 'jdbc:derby:{own}/site;create=true'", f"CREATE TABLE {table} ({columns})", load, "CONNECT 'jdbc:derby:;shutdown=true'")
        return _packed(own, root)


def _packed(own: str, root: str) -> str:
    os.makedirs(root, exist_ok=True)
    path = f"{root}/{uuid.uuid4().hex}.jar"  # another one if the task is tried again
    with zipfile.ZipFile(path, "w") as jar:
        for name in glob.glob(f"{own}/site/**", recursive=True):
            jar.write(name, os.path.relpath(name, own))
    return f"jdbc:derby:jar:({path})site"


def _ij(own: str, *statements: str) -> None:
    """Run statements by Derby's tool; it goes on after errors, and says so in its output only."""
    import pyspark

    jars = os.path.join(os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__), "jars")
    java = os.path.join(os.environ["JAVA_HOME"], "bin", "java") if os.environ.get("JAVA_HOME") else shutil.which("java") or "java"
    with open(f"{own}/run.sql", "w") as out:
        out.write(";\n".join([*statements, ""]))
    command = [java, "-Xmx256m", f"-Dderby.stream.error.file={own}/log", "-cp", ":".join(glob.glob(f"{jars}/derby*.jar")), "org.apache.derby.tools.ij", f"{own}/run.sql"]
    done = subprocess.run(command, cwd=own, capture_output=True, text=True)
    failed = re.findall(r"^(?:ij> ?)*ERROR (?!XJ015).*", done.stdout, re.M)
    if failed or done.returncode or "XJ015" not in done.stdout:
        raise RuntimeError(f"a site was not filled: {' '.join(failed) or done.stdout + done.stderr}")
