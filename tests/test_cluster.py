"""Queries on executors that share nothing with the driver but folders."""

import os
import subprocess
import sys
from functools import reduce
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame

from fleetmetrics.sources import readings as lake
from fleetmetrics.sources import sites

ROOT = Path(__file__).resolve().parent.parent
RUN = """
import sys
from pyspark.sql import SparkSession
from fleetmetrics.plans import registry
home = sys.argv[1]
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{home}/shared", "spark.sql.session.timeZone": "UTC"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
print("rows", registry.queries()[sys.argv[2]](spark, sys.argv[3]).count())
"""


def test_jdbc_on_a_cluster(tmp_path):
    """Executors do not see a database in the driver's memory."""
    (tmp_path / "home/work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (tmp_path / "home" / p.name).symlink_to(p)
    env = os.environ | {"SPARK_HOME": str(tmp_path / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": str(ROOT), "PYSPARK_PYTHON": sys.executable}
    env = {k: v for k, v in env.items() if k not in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path), "L-2", "/root/testdata/sf0.001"], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "rows 150\n" in done.stdout, done.stderr[-2000:]


def test_sites_keep_all_values(spark, tmp_path, monkeypatch):
    """Nulls, empty texts, quotes, commas, line ends; more sites than four, and sites without rows."""
    texts = [None, "", '"', '""', "a,b", "a\nb", "a\r\nb", "'", " x ", "\\", "ñ 日本 \U0001f600", ";", "NULL"]
    rows = spark.createDataFrame([(None if k == 7 else k, k * k if k % 3 else None, t) for k, t in enumerate(texts)], "K long, n int, s string")
    types = {"K": "BIGINT", "n": "INTEGER", "s": "VARCHAR(99)"}
    for size, least in ((2, 7), (1000, 4)):
        monkeypatch.setattr(sites, "SITE_ROWS", size)
        urls = sites.build(rows, str(tmp_path / f"{size}"), "T", types)
        back = reduce(DataFrame.unionByName, [lake.read_jdbc(spark, url, "T", sites.DRIVER, "K", partitions=2) for url in urls])
        assert len(urls) == least and back.dtypes == rows.dtypes and sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    empty = [lake.read_jdbc(spark, url, "T", sites.DRIVER, "K", partitions=2) for url in sites.build(rows.limit(0), str(tmp_path / "none"), "T", types)]
    assert sum(df.count() for df in empty) == 0
