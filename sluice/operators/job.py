"""A load job end to end, with its ledger (the reference's ``load`` command).

1. list the files (S2–S4) — nothing matched: warn, write nothing (S6, K8);
2. skip files a competing job already has live with the same etag (J3), or
   with ``force`` cancel every unfinished task of the same files first (L6);
3. enqueue one task row per file (K7);
4. load the batch (``load_files``) and record each file's outcome (L7);
5. append the job row last, so a failed submit leaves no job behind (K8).

``sync`` is the same call: changed files have a new fingerprint, so they are
not skipped, and the file-id partitions make their reload replace old rows.
``retry_job`` loads the files of failed tasks again (L8).
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.fileid import file_id_string
from sluice.functions.states import is_queued, now_literal
from sluice.operators.ledger import (
    append_versions, current_versions, enqueue, force_cancel, job_row, read_versions, record_outcomes, retry_errors,
)
from sluice.operators.load import load_files, stage
from sluice.session import delete_paths
from sluice.operators.submit import competing_jobs, skip_unchanged
from sluice.plans.reports import prefix_filter
from sluice.sources.listing import list_files
from sluice.spec import LoadSpec, check_target

log = logging.getLogger(__name__)


@dataclass
class JobResult:
    job_id: str | None
    submitted: int
    ignored: int
    cancelled: int
    verdicts: DataFrame | None


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def run_load_job(spark: SparkSession, spec: LoadSpec, ledger_path: str, now: str | None = None,
                 force: bool = False, dry_run: bool = False, job_prefix: str = "") -> JobResult | DataFrame:
    """List, skip or force, enqueue, load and record. ``job_prefix`` (hexadecimal) starts the new job's id."""
    check_target(spark, spec)
    fixed, now = now, now or utc_now()
    manifest = list_files(spark, list(spec.source.paths), spec.source.fingerprint, spec.source.keep_duplicates)
    if dry_run:
        return manifest.select("name", "size")  # S7
    total = manifest.count()
    if total == 0:
        log.warning("Paths %s matched no files", list(spec.source.paths))
        return JobResult(None, 0, 0, 0, None)
    jobs, versions = read_versions(spark, ledger_path)
    competing = competing_jobs(jobs, "spark", 0, spec.target.database, spec.target.name)
    # resolve versions only for the tasks this submission can touch
    of_competing = current_versions(versions.join(competing.select(F.col("id").alias("job_id")), "job_id", "left_semi"))
    cancelled = 0
    if force:
        same_files = versions.join(
            manifest.select(file_id_string("name", "bucket").alias("file_id")).distinct(), "file_id", "left_semi")
        cancel = force_cancel(current_versions(same_files), manifest, now, same_target_jobs=competing)
        cancel.cache()
        cancelled = cancel.count()
        if cancelled:
            append_versions(cancel, ledger_path)
        cancel.unpersist()
        to_load = manifest
    else:
        to_load = skip_unchanged(manifest, of_competing, competing, now).drop("file_id")
    # written, not cached: appends to the ledger below would have a cached plan computed again, over them
    to_load, staged_path = stage(spark, to_load, "to-load")
    submitted = to_load.count()
    ignored = total - submitted
    if submitted == 0:
        delete_paths(spark, [staged_path])
        return JobResult(None, 0, ignored, cancelled, None)
    job_id = job_prefix + uuid.uuid1().hex[:32 - len(job_prefix)]
    queued = enqueue(to_load, job_id, now)
    # the job is visible while it runs; a load that fails leaves no task queued
    append_versions(job_row(spark, job_id, now, spec.to_json()), ledger_path, table="jobs")
    append_versions(queued, ledger_path)
    try:
        verdicts = _load_and_record(spark, spec, ledger_path, to_load, F.col("job_id") == job_id, now, fixed)
    finally:
        delete_paths(spark, [staged_path])
    return JobResult(job_id, submitted, ignored, cancelled, verdicts)


def _load_and_record(spark: SparkSession, spec: LoadSpec, ledger_path: str, files: DataFrame, mine, now: str,
                     fixed: str | None, gone: DataFrame | None = None) -> DataFrame:
    """Load ``files`` and append the outcomes of the unfinished tasks that ``mine`` (a condition, or a table of task
    ids) names.  ``gone``: file ids whose file is not there any more."""
    def tasks() -> DataFrame:
        _, versions = read_versions(spark, ledger_path)
        return current_versions(versions.join(mine, "id", "left_semi") if isinstance(mine, DataFrame)
                                else versions.where(mine))

    def finish(verdicts: DataFrame) -> None:
        append_versions(record_outcomes(tasks(), verdicts, fixed or utc_now(), started=now), ledger_path)

    def all_failed(of: DataFrame, why: str) -> DataFrame:
        return of.select("file_id", F.lit("error").alias("status"), F.lit(why).alias("error"),
                         F.lit(0).cast("bigint").alias("row_count"), none.alias("started"), none.alias("stopped"))

    none = F.lit(None).cast("timestamp_ntz")
    try:
        outcome = load_files(spark, spec, files)
    except Exception as failure:
        finish(all_failed(tasks().where(F.col("finished").isNull()), f"load failed: {str(failure).splitlines()[0]}"))
        raise
    verdicts = outcome.verdicts.select(F.col("file_id").cast("string").alias("file_id"), "status", "error", "row_count",
                                       "started", "stopped")
    finish(verdicts if gone is None else verdicts.unionByName(all_failed(gone, "the file is not there any more")))
    return outcome.verdicts


def retry_job(spark: SparkSession, spec: LoadSpec, ledger_path: str, now: str | None = None,
              job_prefix: str | None = None) -> JobResult:
    """Load the files of failed tasks again — those of the jobs with this target, or only of the jobs whose id
    starts with ``job_prefix``.  Their tasks are queued anew (``retry_errors``) and get the new outcome; tasks that
    were queued anew earlier and not loaded since run too.  A task whose file is gone fails again."""
    check_target(spark, spec)
    fixed, now = now, now or utc_now()
    jobs, versions = read_versions(spark, ledger_path)
    own = competing_jobs(jobs, "spark", 0, spec.target.database, spec.target.name)
    own = own.where(prefix_filter("id", job_prefix)).select(F.col("id").alias("job_id"))
    tasks, tasks_path = stage(spark, current_versions(versions.join(own, "job_id", "left_semi")), "retry-tasks")
    again = retry_errors(tasks, now)
    waiting = tasks.where(is_queued(now_literal(now)) & (F.col("update_count") > 1)).select("id", "file_id")
    due, due_path = stage(spark, again.select("id", "file_id").unionByName(waiting), "retry-due")
    try:
        submitted = due.count()
        if submitted == 0:
            return JobResult(None, 0, 0, 0, None)
        append_versions(again, ledger_path)
        listed = list_files(spark, list(spec.source.paths), spec.source.fingerprint).withColumn(
            "file_id", file_id_string("name", "bucket"))
        files = listed.join(due.select("file_id").distinct(), "file_id", "left_semi")
        files, files_path = stage(spark, files, "retry-files")
        try:
            gone = due.select("file_id").distinct().join(files, "file_id", "left_anti")
            verdicts = _load_and_record(spark, spec, ledger_path, files.drop("file_id"), due.select("id"), now, fixed, gone)
        finally:
            delete_paths(spark, [files_path])
    finally:
        delete_paths(spark, [tasks_path, due_path])
    return JobResult(None, submitted, 0, 0, verdicts)


def sync(spark: SparkSession, spec: LoadSpec, ledger_path: str, now: str | None = None,
         job_prefix: str = "") -> JobResult:
    """T1 (batch form): bring the target in line with the files matching the
    spec's paths — new and changed files are (re)loaded, unchanged skipped."""
    if not spec.options.file_id_column:
        raise ValueError("sync needs options.file_id_column so a changed file replaces its old rows")
    return run_load_job(spark, spec, ledger_path, now=now, job_prefix=job_prefix)
