"""T1, stream form for files that change: every micro-batch lists the paths and loads new and changed files.

Spark's file source knows a file by its name and never reads it again, so here the stream's source is a clock: each
trigger is one batch, in which tasks list the paths (``list_files``), the listing meets the ledger's fingerprints in
an anti-join, and a changed file's rows are replaced by its new ones (``job.sync``).  The driver holds no listing,
and the checkpoint holds no file names: what has been loaded is in the ledger.

A batch that broke off (a lost driver) is run again by the checkpoint.  The tasks it had queued are cancelled first,
else they would count as live and their files as submitted; files that it had loaded are skipped, or replace their
own rows.  One watch at a time may load into a target.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.job import sync, utc_now
from sluice.operators.ledger import append_versions, bulk_finish, current_versions, read_versions
from sluice.operators.load import stage
from sluice.session import delete_paths
from sluice.spec import LoadSpec


def watch_prefix(checkpoint: str) -> str:
    """What the ids of a watch's jobs start with."""
    return hashlib.md5(checkpoint.encode(), usedforsecurity=False).hexdigest()[:12]


def cancel_leftovers(spark: SparkSession, ledger: str, prefix: str) -> int:
    """Cancel the unfinished tasks of the jobs whose id starts with ``prefix``; returns their number."""
    _, versions = read_versions(spark, ledger)
    mine = current_versions(versions.where(F.col("job_id").startswith(prefix)))
    # written, as the append below changes the table that it is read from
    left, path = stage(spark, mine.where(F.col("finished").isNull()), "watch-leftovers")
    try:
        number = left.count()
        if number:
            append_versions(bulk_finish(left, utc_now()), ledger)
        return number
    finally:
        delete_paths(spark, [path])


def start_watch(spark: SparkSession, spec: LoadSpec, ledger: str, checkpoint: str, every: str | None = "1 minute"):
    """Start the stream; returns the ``StreamingQuery``.  ``every`` is the trigger's interval; None runs one batch
    and ends.  The target needs ``options.file_id_column``."""
    if not spec.options.file_id_column:
        raise ValueError("a changed file must replace its own rows: set options.file_id_column")
    prefix = watch_prefix(checkpoint)

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        cancel_leftovers(session, ledger, prefix)
        sync(session, spec, ledger, job_prefix=prefix)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    writer = ticks.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_watch(spark: SparkSession, spec: LoadSpec, ledger: str, checkpoint: str) -> None:
    """One batch, to its end."""
    start_watch(spark, spec, ledger, checkpoint, every=None).awaitTermination()
