"""Files of any Hadoop file system, as the driver sees them: small ones, and folders as a whole.

Spark has no public way to list, move or publish files, so these few functions go through the driver's JVM. They are the
only ones of the library's core that do, and need a classic session, not Spark Connect.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    if not hasattr(spark, "_jvm"):
        raise RuntimeError("files are reached through the driver's JVM, which a Spark Connect session does not have")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder, sorted; none if there is no such folder."""
    fs, where = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    """A file or a folder with all that is in it; nothing if it is not there."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, to: str) -> None:
    """Rename within a file system. The target must not be there yet; its folder is made."""
    fs, where = _hadoop(spark, source)
    target = _hadoop(spark, to)[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(where, target):
        raise OSError(f"cannot move {source} to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _hadoop(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its content, unless it is there: of several that try at once exactly one gets True.

    The content is written beside it first. A local file is then linked to its name, as local renames replace; elsewhere
    it is renamed, which fails on HDFS and its like where the name is taken.
    """
    fs, where = _hadoop(spark, path)
    draft = _hadoop(spark, f"{os.path.dirname(path)}/_draft-{uuid.uuid4().hex}")[1]
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(urlparse(draft.toString()).path, urlparse(path).path)
            except FileExistsError:
                return False
            return True
        return not fs.exists(where) and fs.rename(draft, where)
    finally:
        fs.delete(draft, False)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share (``spark.checkpoint.dir``); one of this machine where none is set and the master is local, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base}/{name}-{uuid.uuid4().hex}"
