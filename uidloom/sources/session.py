"""Session settings, and the shared folder for data written between two stages of a run."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the operators rely on; sizes stay with the cluster.

    One flow generates more than the 100 classes that the cache for compiled code holds by default, so each run
    would compile all of them again.
    """
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.session.timeZone", "UTC")
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a new temporary folder; a cluster must name one, as
    a folder of one machine is not visible to the others.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="uidloom-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder below the shared one, for frames that only one flow reads; removed at the end of the flow."""
    path = f"{shared_folder(spark)}/uidloom/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a frame to a new parquet folder and read it back.

    Ends the lineage, so a lost executor costs one task and not the upstream joins, and gives the planner
    the true size of the data. What is written outside a ``scratch`` folder stays, as its readers are lazy.
    """
    path = f"{folder or f'{shared_folder(df.sparkSession)}/uidloom'}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
