"""Where intermediate tables go.

A cluster names a folder that the driver and all executors share in
``spark.checkpoint.dir``.  Intermediate tables are written there as Parquet:
that cuts the lineage, survives the loss of any executor, and gives the next
stage exact sizes to plan with.  Tables whose readers are done are deleted;
those that a returned DataFrame reads stay for the owner of the folder.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder.

    Where none is set, a temporary folder serves a session that runs in one
    process; on a cluster executors would not see each other's files, so that is
    an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, *, by: str | None = None, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    by: a column of few values, in folders of which the rows are kept.  options: of the writer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more, and shuffle files of plans that are gone; others are left alone."""
    for table in tables:
        if path := getattr(table, "_stored_at", None):
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    if tables:
        release(tables[0].sparkSession)


def release(spark: SparkSession, *, settle: float = 0.0) -> None:
    """Collect the driver's memory: Spark deletes the shuffle files of plans that are gone only then.

    settle: seconds to wait before; the events of a query that has just ended still hold its plan.
    On a cluster the first collection still leaves them, so then there is a second one.
    """
    for _ in range(2 if settle else 1):
        time.sleep(settle)
        gc.collect(1)
        spark.sparkContext._jvm.System.gc()
