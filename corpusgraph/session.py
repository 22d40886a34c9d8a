"""Session helpers shared by every plan."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` below `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores if it comes in fewer partitions than there are, as a small table of one file does.

    Large tables have more partitions than cores and are left as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, which a cluster must set.

    On a single machine (local mode, as in tests) a folder is made where the setting is missing;
    anywhere else that is an error, as other machines would not see such a folder.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` into the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """`df` written as a table to the shared folder and read again: lineage is cut, columns are compressed and pruned.

    The table is removed when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables of so many short rows at most are broadcast, larger ones are joined by shuffling.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """A stored table for a join: broadcast if it has BROADCAST_ROWS rows at most, joined by shuffling otherwise."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may be gone before the process
        pass


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, which on a cluster may not have it installed."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(suffix=".zip", prefix="corpusgraph-")
    os.close(fd)
    with zipfile.ZipFile(name, "w") as z:
        for p in root.rglob("*.py"):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)
