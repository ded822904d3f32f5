"""Sessions, tables and lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of a folder."""
    workers_find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", os.environ.get("HORTULUS_MEMORY", "12g"))
    settings = {
        "spark.sql.shuffle.partitions": cores,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def workers_find_package(spark: SparkSession) -> None:
    """Puts the folder of this package on the Python path of workers started from now on.

    On a cluster the package is given with --py-files or installed; this serves where all see the same folders.
    """
    environment = spark.sparkContext.environment
    folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if folder not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *paths])


def spread(df: DataFrame, *by: str) -> DataFrame:
    """`df` over all tasks by some columns: for rows that are few in bytes but costly to work on, which adaptive execution would put
    into one task."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder, so that a lost executor costs a read and not a recomputation.

    The folder is the one the cluster names in spark.checkpoint.dir. Where that is unset a single-machine session (tests) makes a
    temporary one; a cluster has no folder that is known to be shared, so there it is an error.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local") or "cluster" in context.master:
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="hortulus-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
