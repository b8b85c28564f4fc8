"""Replacing partitions of a stored table in one recoverable step (K5).

A reload overwrites some partitions and deletes those that end up empty; a crash in between would leave old and new
rows side by side.  So the new rows and the list of partitions to go are first written beside the table, and a plan
file, renamed into place last, makes them binding.  Both steps can be repeated: ``recover`` completes every swap that
has its plan file and removes what never got one (the table is untouched then).  Loads call it before they read
their target; loads into one target run one after the other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_PLAN = "plan"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.Path, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def swap_partitions(spark: SparkSession, path: str, rows: DataFrame, column: str, emptied) -> None:
    """Replace the partitions (by ``column``) that ``rows`` have and delete those of ``emptied(rows as written)``,
    a table whose first column names partitions."""
    at = f"{_pending(path)}/{uuid.uuid4().hex}"
    rows.write.parquet(f"{at}/rows")
    emptied(spark.read.schema(rows.schema).parquet(f"{at}/rows")).distinct().write.parquet(f"{at}/emptied")
    Path, draft, fs = _fs(spark, f"{at}/{_PLAN}.draft")
    out = fs.create(draft, True)
    out.write(column.encode())
    out.close()
    fs.rename(draft, Path(f"{at}/{_PLAN}"))
    _complete(spark, path, at)


def _complete(spark: SparkSession, path: str, at: str) -> None:
    Path, plan, fs = _fs(spark, f"{at}/{_PLAN}")
    source = fs.open(plan)
    column = bytes(source.readAllBytes()).decode()
    source.close()
    rows = spark.read.parquet(f"{at}/rows")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    drop_partitions(spark, path, column, spark.read.parquet(f"{at}/emptied"))
    fs.delete(Path(at), True)


def recover(spark: SparkSession, path: str) -> int:
    """Complete the swaps that broke off after their plan was made; remove the others.  Returns how many were
    completed."""
    Path, folder, fs = _fs(spark, _pending(path))
    if not fs.exists(folder):
        return 0
    done = 0
    for status in fs.listStatus(folder):
        at = status.getPath()
        if fs.exists(Path(at, _PLAN)):
            _complete(spark, path, at.toString())
            done += 1
        else:
            fs.delete(at, True)
    return done


def drop_partitions(spark: SparkSession, path: str, column: str, ids: DataFrame) -> None:
    """Delete ``column=<id>`` directories.  Dynamic overwrite cannot express "this partition is now empty".  Only
    the (few) ids reach the driver; deletion is a metadata operation."""
    Path, root, fs = _fs(spark, path)
    for row in ids.toLocalIterator():
        gone = Path(root, f"{column}={row[0]}")
        if fs.exists(gone):
            fs.delete(gone, True)
