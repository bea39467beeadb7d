"""Session defaults and the one way this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Texts are large rows: a Python worker holds a batch several times over.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


# Set these when the session is built: call sites in error texts cost several driver round trips
# per Column operation, and this library's rule tables are many Column operations.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


#: Tasks a core that rows are dealt out to.
TASKS = 3
#: Removes the shuffle files of a job when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC), the adaptive ones plans rely on and the size of Arrow batches."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="storyspark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, survives lost executors, and carries its true size, so the planner
    broadcasts it only when it really is small.  Shuffle files of the write serve nothing afterwards and
    are removed when it ends, so a chain of steps holds the shuffles of one step on disk.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    kept = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, kept)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for row-heavy work on a file scan.

    A scan with several splits per core is left alone; others are dealt out, because a split without a row
    group of its own is empty.  Only for plain scans: asking a plan with shuffles for its partitions would run it.
    """
    return dealt(df) if df.rdd.getNumPartitions() < TASKS * df.sparkSession.sparkContext.defaultParallelism else df


def dealt(df: DataFrame) -> DataFrame:
    """Deal rows out evenly, several tasks a core, before work that is heavy per row.

    Joins and scans make few parts of small rows, as many as their bytes ask for.
    """
    spark = df.sparkSession
    return df.repartition(max(TASKS * spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions"))))
