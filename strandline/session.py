"""Session factory and the few helpers that touch the session's configuration."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC time; `conf` overrides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir` of the session. Only in local mode, where that is unset, a
    temporary folder of this machine; a cluster without the setting is refused, its executors would write to their own disks."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), "strandline-shared")
    return d


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table that is written once and read several times."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this process has written; for when no result that reads them is needed any more."""
    jvm, n = spark.sparkContext._jvm, 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return n


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and read it back (survives lost executors)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
