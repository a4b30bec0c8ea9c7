"""Where intermediate tables live, and how lineage is cut.

Intermediate tables are written as Parquet below the folder that the cluster names in ``spark.checkpoint.dir`` (shared by
all executors, so a lost executor loses nothing). Only a local session without that setting, as in tests, gets a folder of its
own; on a cluster the setting must be there.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's own folder below ``spark.checkpoint.dir``; removed when the program ends."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="quotaloom-")
            spark.conf.set("spark.checkpoint.dir", base)
        _FOLDERS[app] = f"{base.rstrip('/')}/quotaloom-{app}"
        atexit.register(_remove, spark, _FOLDERS[app])
    return _FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already
        pass


def drop(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that no later plan reads."""
    _remove(spark, path)


def cut(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: lineage ends here and later passes only read."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it is known to hold at most ``max_rows`` rows, else as it is (a shuffle join).

    The check is an action over ``df``, so pass tables that are cheap to read.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread_small(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for steps that are heavy on the CPU.

    Only an input of fewer splits than cores is shuffled; a large table has more splits and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
