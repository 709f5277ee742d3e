"""Stage boundaries: intermediate results written once to shared storage and read back.

A result that several consumers read (the weekly table, an index) is written as Parquet, so
it is computed once, its lineage is cut, and the loss of an executor costs no recomputation
of the input scan.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000  # of narrow rows: a few megabytes

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Where it is unset, a session of one machine gets a temporary folder of its own (one per
    application). A cluster must name a folder that its executors share; one on local disks is
    refused, as each executor would see only its own part of a table.
    """
    one_machine = spark.sparkContext.master.startswith("local")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if configured.startswith("file:") and not one_machine:
            raise ValueError(f"spark.checkpoint.dir is {configured}, which executors do not share")
        return configured.rstrip("/")
    if not one_machine:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="costwatch-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/costwatch/{uuid.uuid4().hex}/{name}"


def absolute(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, as tasks need it that open files on their own."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.makeQualified(folder).toString()
    return found if found.startswith("file://") else found.replace("file:/", "file:///", 1)


def clear(spark: SparkSession) -> None:
    """Delete everything staged below the shared folder; for the owner of the folder, after use."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/costwatch")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a file scan over the cores where it has fewer partitions than that.

    A single file with one row group would leave the work of a whole table to one core. A
    scan with enough partitions, as of any large table, is left as it is. `key` should be
    (nearly) unique.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once under a fresh path and return the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_side(written: DataFrame) -> DataFrame:
    """A narrow written table with distinct keys as the build side of a join.

    Counted first (from file footers): broadcast while it is small, so that the other side is
    not shuffled, else a shuffled hash join. Its keys are distinct, so they spread evenly;
    rows of a frequent key are on the other side, which AQE splits.
    """
    small = written.count() <= BROADCAST_ROWS
    return F.broadcast(written) if small else written.hint("shuffle_hash")
