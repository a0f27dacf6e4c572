"""Session helpers: settings, the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ship_by_value(*packages: str) -> None:
    """Send the packages' functions to Python workers with the job itself.

    For sessions whose workers cannot import them, because they were not given
    to spark-submit as --py-files.
    """
    for name in packages:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def local_session(cores: str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("opinara")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder of its own; any other
    master is an error, since executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="opinara-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder."""
    return os.path.join(work_root(spark), f"{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the work folder once and read it back.

    Cuts the lineage and survives lost executors, unlike cached blocks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table of `saved` that nothing reads any more, and what finished jobs have shuffled.

    Spark removes shuffled files when the driver collects the plans that made them, which may be
    long after the jobs if its memory is large; so it is asked to.
    """
    spark = df.sparkSession
    spark._jvm.System.gc()
    for uri in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Give an input with fewer splits than cores to all cores.

    A large input has far more splits than cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
