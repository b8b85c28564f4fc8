"""Deciding what a new job loads.

*Competing jobs* are the jobs with the same target (P4) — optionally only
those created before the new job.  A manifest file is skipped when a task of a
competing job that is QUEUED, RUNNING or SUCCESS has the same etag and the
same name (J3); a NULL etag never matches, so local files always load.  All of
it is semi / anti joins on (etag, name) or on the file id — no IN-lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fields import task_data
from sluice.plans.reports import same_target
from sluice.functions.fileid import file_id_string
from sluice.functions.states import TaskState, now_literal, task_state

LIVE_STATES = (TaskState.QUEUED, TaskState.RUNNING, TaskState.SUCCESS)


def _now(now) -> Column:
    return now if isinstance(now, Column) else now_literal(now)


def competing_jobs(jobs: DataFrame, host: str, port: int, database: str, table: str,
                   created_before: str | None = None) -> DataFrame:
    cond = same_target("spec", host, port, database, table)
    if created_before is not None:
        cond = cond & (F.col("created") < F.lit(created_before).cast("timestamp_ntz"))
    return jobs.where(cond).select("id")


def known_files(tasks: DataFrame, competing: DataFrame, now, states=LIVE_STATES) -> DataFrame:
    """Tasks of competing jobs in ``states`` as ``(md5, key_name, bucket, file_key_id)``."""
    t = tasks.join(competing.select(F.col("id").alias("job_id")), "job_id", "left_semi")
    t = t.where(task_state(_now(now)).isin(list(states))).withColumn("_d", task_data("data"))
    d = F.col("_d")
    fid = F.col("file_id") if "file_id" in tasks.columns else F.lit(None).cast("string")
    return t.select("md5", d["key_name"].alias("key_name"), d["bucket"].alias("bucket"), fid.alias("file_id"))


def skip_unchanged(manifest: DataFrame, tasks: DataFrame, competing: DataFrame, now,
                   match_bucket: bool = True) -> DataFrame:
    """Manifest rows still to load.  ``match_bucket`` also requires
    the bucket to agree (NULL-safe); the reference ignores the bucket."""
    known = known_files(tasks, competing, now).where(F.col("md5").isNotNull())
    m = manifest.alias("m")
    k = known.alias("k")
    cond = (F.col("m.etag") == F.col("k.md5")) & (F.col("m.name") == F.col("k.key_name"))
    if match_bucket:
        cond = cond & F.col("m.bucket").eqNullSafe(F.col("k.bucket"))
    out = m.join(k, cond, "left_anti")
    return out.withColumn("file_id", file_id_string("name", "bucket"))


def submit_counts(manifest: DataFrame, to_load: DataFrame) -> DataFrame:
    """Submitted and ignored counts of one submission."""
    total = manifest.agg(F.count(F.lit(1)).alias("n"))
    sub = to_load.agg(F.count(F.lit(1)).alias("submitted"))
    return sub.select("submitted", (total.scalar() - F.col("submitted")).alias("ignored"))


def prior_success(manifest: DataFrame, tasks: DataFrame, competing: DataFrame, now,
                  task_file_id: Column | None = None) -> DataFrame:
    """Manifest files that a competing job already loaded successfully
    (by file id) — their old rows must be replaced, not added to."""
    t = tasks.join(competing.select(F.col("id").alias("job_id")), "job_id", "left_semi")
    t = t.where(task_state(_now(now)) == TaskState.SUCCESS)
    fid = task_file_id if task_file_id is not None else F.col("file_id")
    done = t.select(fid.alias("file_id"))
    m = manifest.withColumn("file_id", file_id_string("name", "bucket"))
    return m.join(done, "file_id", "left_semi")


def names_per_etag(tasks: DataFrame, competing: DataFrame, now) -> DataFrame:
    """A10: the etag → names relation of live competing tasks, one row per
    (md5, key_name) with the number of tasks and of distinct names per md5.
    Kept as rows (not collected lists), so a hot etag never becomes one
    oversized value."""
    known = known_files(tasks, competing, now).where(F.col("md5").isNotNull())
    pairs = known.groupBy("md5", "key_name").agg(F.count(F.lit(1)).alias("n_tasks"))
    per_md5 = pairs.groupBy("md5").agg(F.count(F.lit(1)).alias("n_names"))
    return pairs.join(per_md5, "md5")
