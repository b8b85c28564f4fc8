"""The load ledger as append-only versioned tables.

The reference mutates rows of a SQLite table in place and bumps
``update_count``.  Parquet tables take no UPDATE, so every change here is a
*change set*: new version rows with ``update_count + 1`` that are appended;
the current state of a task is its row with the greatest ``update_count`` (L1).
All change sets are lazy DataFrames; writing them is one append.

Task versions lie in buckets by task id, so the versions of a task meet in the
task that reads their bucket, without a shuffle.  The number of buckets is a
property of the ledger: a file ``_buckets=<n>`` beside the tables holds it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.fields import task_data
from sluice.functions.fileid import file_id_string
from sluice.functions.states import is_queued, now_literal, TaskState, task_state
from sluice.plans.reports import prefix_filter

JOBS_SCHEMA = "id STRING, created TIMESTAMP_NTZ, spec STRING"

TASKS_SCHEMA = (
    "id STRING, created TIMESTAMP_NTZ, data STRING, result STRING, execution_id STRING, "
    "steps STRING, job_id STRING, file_id STRING, bytes_total BIGINT, bytes_downloaded BIGINT, "
    "download_rate BIGINT, md5 STRING, started TIMESTAMP_NTZ, last_contact TIMESTAMP_NTZ, "
    "update_count BIGINT, finished TIMESTAMP_NTZ"
)

#: Least number of buckets of a new ledger. One task reads a bucket: a first append of many rows makes more, a grown
#: ledger is compacted into more (``compact_ledger``).
BUCKETS = 8

#: Rows of a first append for each bucket: some 150 MB to sort in the task that writes or reads it.
BUCKET_ROWS = 400_000


def _now(now) -> Column:
    return now if isinstance(now, Column) else now_literal(now)


# ---------------------------------------------------------------------------
# storage (S18, K7)
# ---------------------------------------------------------------------------

def read_ledger(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(jobs, tasks)`` of a ledger directory; tasks at their current
    version (L1), of which only ``columns`` if given.  Missing tables read as
    empty."""
    jobs, versions = read_versions(spark, path)
    return jobs, current_versions(versions, columns=columns)


def read_job_tasks(spark: SparkSession, path: str, job_prefix: str) -> tuple[DataFrame, DataFrame]:
    """``(jobs, tasks)`` of the jobs whose id starts with ``job_prefix``: the
    prefix is applied to the raw versions, where it reaches the Parquet scan
    (row groups sorted by job id are skipped), before versions are resolved."""
    jobs, versions = read_versions(spark, path)
    return (jobs.where(F.col("id").startswith(job_prefix)),
            current_versions(versions.where(F.col("job_id").startswith(job_prefix))))


def read_versions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(jobs, task versions)`` without resolving versions.  A task's
    ``job_id`` and ``file_id`` never change between versions, so filters on
    them can run *before* ``current_versions`` and shrink its input."""
    jobs = _read_or_empty(spark, f"{path}/jobs", JOBS_SCHEMA)
    buckets, exists = _layout(spark, path)
    if not exists or buckets is None:
        return jobs, _read_or_empty(spark, f"{path}/tasks", TASKS_SCHEMA)
    return jobs, spark.table(_bucketed_table(spark, path, buckets))


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001 - only a missing path is expected
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a function from a name in it to the Hadoop path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, lambda name="": hadoop.Path(f"{path}/{name}" if name else path)


def _layout(spark: SparkSession, path: str) -> tuple[int | None, bool]:
    """(number of buckets, or None where the versions are not bucketed; whether there are task versions)."""
    fs, at = _folder(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(at())] if fs.exists(at()) else []
    marked = [int(n.removeprefix("_buckets=")) for n in names if n.startswith("_buckets=")]
    return (min(marked) if marked else None), "tasks" in names


def create_ledger(spark: SparkSession, path: str, buckets: int = BUCKETS) -> int | None:
    """Fix the number of buckets of a ledger that has none yet; returns the number in force (None for a ledger whose
    versions were written without buckets: it stays so until it is compacted).  The first append does this with
    ``BUCKETS``; call it before the first writers start where another number is wanted.  (``append_versions`` asks for more than
    ``BUCKETS`` if its rows are many.)"""
    known, exists = _layout(spark, path)
    if known is None and not exists:
        fs, at = _folder(spark, path)
        fs.mkdirs(at())
        fs.createNewFile(at(f"_buckets={buckets}"))
        known, _ = _layout(spark, path)
    return known


def _bucketed_table(spark: SparkSession, path: str, buckets: int) -> str:
    """The name of an external table over the versions: Spark reads buckets only through its catalog.  The file list
    is read anew, as other sessions append too."""
    fs, at = _folder(spark, path)
    where = fs.makeQualified(at("tasks")).toString()
    name = f"sluice_ledger_{hashlib.sha256(f'{where} {buckets}'.encode()).hexdigest()[:24]}"
    location = where.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({TASKS_SCHEMA}) USING parquet "
              f"CLUSTERED BY (id) SORTED BY (job_id, id) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return name


def append_versions(df: DataFrame, path: str, table: str = "tasks") -> None:
    """Append version rows (or job rows) to the ledger.

    Not partitioned by job: millions of small jobs would mean millions of
    directories.  Task versions go to the buckets of their ids, one file a
    bucket.  Rows are sorted by (job id, id) inside each file, so Parquet
    min/max statistics let a job-id prefix filter skip row groups."""
    buckets = None
    if table == "tasks":
        known, exists = _layout(df.sparkSession, path)
        buckets = known if known or exists else create_ledger(
            df.sparkSession, path, max(BUCKETS, -(-df.count() // BUCKET_ROWS)))
    if buckets is None:
        key = "job_id" if table == "tasks" else "id"
        rows = df.sortWithinPartitions(key, "id" if key != "id" else "created")
        rows.write.mode("append").parquet(f"{path}/{table}")
        return
    _append_to_buckets(df, path, buckets)


def _append_to_buckets(df: DataFrame, path: str, buckets: int) -> None:
    name = _bucketed_table(df.sparkSession, path, buckets)
    columns = df.sparkSession.table(name).schema.fields
    # same hash as the buckets': each bucket is written by one task, as one file
    df.select([F.col(c.name).cast(c.dataType).alias(c.name) for c in columns]) \
        .repartition(buckets, "id").write.insertInto(name)


def compact_ledger(spark: SparkSession, path: str, out_path: str, buckets: int | None = None) -> None:
    """Write the current version of every task (and all jobs) to a new
    ledger directory — many appends become a few sorted files, in ``buckets``
    buckets (by default as many as before).  Readers switch to ``out_path``;
    the old directory is left untouched."""
    known, exists = _layout(spark, out_path)
    if exists or known is not None:
        raise ValueError(f"{out_path} holds a ledger already")
    jobs, tasks = read_ledger(spark, path)
    jobs.repartitionByRange("id").sortWithinPartitions("id").write.parquet(f"{out_path}/jobs")
    _append_to_buckets(tasks, out_path, create_ledger(spark, out_path, buckets or _layout(spark, path)[0] or BUCKETS))


def job_row(spark: SparkSession, job_id: str, created: str, spec_json: str) -> DataFrame:
    """K7: the job row (written *after* its tasks, so a failed submit leaves
    nothing to roll back — K8)."""
    return spark.createDataFrame([(job_id, created, spec_json)], "id STRING, created STRING, spec STRING") \
        .select("id", F.col("created").cast("timestamp_ntz").alias("created"), "spec")


def enqueue(manifest: DataFrame, job_id: str, now) -> DataFrame:
    """K7: one QUEUED task row per manifest file (scheme, name, bucket in
    ``data``; file id by F1; etag into ``md5``; size into ``bytes_total``)."""
    nowc = _now(now)
    data = F.to_json(F.struct(F.col("scheme"), F.col("name").alias("key_name"), F.col("bucket")))
    fid = file_id_string("name", "bucket")
    return manifest.select(
        F.concat_ws("-", F.lit(job_id), fid).alias("id"),
        nowc.alias("created"), data.alias("data"),
        F.lit(None).cast("string").alias("result"), F.lit(None).cast("string").alias("execution_id"),
        F.lit(None).cast("string").alias("steps"), F.lit(job_id).alias("job_id"),
        fid.alias("file_id"), F.col("size").cast("bigint").alias("bytes_total"),
        F.lit(None).cast("bigint").alias("bytes_downloaded"), F.lit(None).cast("bigint").alias("download_rate"),
        F.col("etag").alias("md5"), F.lit(None).cast("timestamp_ntz").alias("started"),
        F.lit(None).cast("timestamp_ntz").alias("last_contact"), F.lit(1).cast("bigint").alias("update_count"),
        F.lit(None).cast("timestamp_ntz").alias("finished"),
    )


# ---------------------------------------------------------------------------
# L1: current version
# ---------------------------------------------------------------------------

def current_versions(versions: DataFrame, key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """L1: the row with the greatest ``update_count`` per task id, or ``key`` and those of its ``columns``: the rest
    is then neither read, sorted nor shuffled (Spark does not prune the struct of an aggregate).

    The versions of a ledger lie in buckets by id: each task aggregates its
    bucket, and nothing is shuffled.  For other inputs ``max_by`` over a struct
    is a partial aggregate: each map task keeps one row per id before the shuffle.
    """
    cols = [c for c in versions.columns if c != key and (columns is None or c in columns)]
    return (versions.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.col("update_count")).alias("_v"))
            .select(key, *[F.col(f"_v.{c}").alias(c) for c in cols]))


# ---------------------------------------------------------------------------
# Bulk finish (cancel)
# ---------------------------------------------------------------------------

def bulk_finish(tasks: DataFrame, now, predicate: Column | None = None, result: str = "cancelled",
                queued_only: bool = False) -> DataFrame:
    """L2 (L3 with ``queued_only``): version rows finishing every unfinished
    task matching ``predicate`` — running ones too unless ``queued_only``:
    execution_id 0, steps ``[]``, started = finished = last_contact = now.
    ``count()`` of the result is the affected-row count (A12)."""
    nowc = _now(now)
    cond = F.col("finished").isNull()
    if queued_only:
        cond = cond & is_queued(nowc)
    if predicate is not None:
        cond = cond & predicate
    return tasks.where(cond).withColumns({
        "execution_id": F.lit("0"),
        "last_contact": nowc,
        "update_count": F.col("update_count") + 1,
        "steps": F.lit("[]"),
        "started": nowc,
        "finished": nowc,
        "result": F.lit(result),
    })


def cancel_jobs(jobs: DataFrame, tasks: DataFrame, now, job_prefix: str | None = None,
                job_filter: Column | None = None, multiple: bool = True) -> DataFrame:
    """L4: cancel the unfinished tasks of the jobs matching a prefix and/or a
    job filter.  Without ``multiple`` the prefix must name exactly one job
    (checked with ``limit(2)``); ``job_candidates`` lists what others it names."""
    sel = jobs.where(prefix_filter("id", job_prefix))
    if job_filter is not None:
        sel = sel.where(job_filter)
    if not multiple:
        found = job_candidates(jobs, job_prefix, job_filter).limit(2).count()
        if not found:
            raise ValueError(f"No job found with id `{job_prefix}`")
        if found > 1:
            named = job_candidates(jobs, job_prefix, job_filter)
            first = ", ".join(r["id"] for r in named.limit(20).collect())
            raise ValueError(f"More than one job matches `{job_prefix}` ({first}; {sel.count()} in all, see job_candidates); "
                             "use a longer prefix or multiple=True")
    targets = sel.select(F.col("id").alias("job_id"))
    scoped = tasks.where(prefix_filter("job_id", job_prefix)).join(targets, "job_id", "left_semi")
    return bulk_finish(scoped, now)


def job_candidates(jobs: DataFrame, job_prefix: str | None = None, job_filter: Column | None = None) -> DataFrame:
    """The jobs that a prefix and / or filter names, in the order of their ids: what an ambiguous prefix may mean."""
    sel = jobs.where(prefix_filter("id", job_prefix))
    return (sel if job_filter is None else sel.where(job_filter)).select("id", "created").orderBy("id")


def cancel_task(tasks: DataFrame, now, task_id) -> DataFrame:
    """Cancel one task by id (a string or a Column, e.g. a scalar subquery)."""
    return bulk_finish(tasks, now, F.col("id") == task_id)


def force_cancel(tasks: DataFrame, manifest: DataFrame, now, same_target_jobs: DataFrame | None = None,
                 task_file_id: Column | None = None) -> DataFrame:
    """Before a forced load, cancel every unfinished task whose file id
    is among the manifest's files.  The reference does this across all
    targets; pass ``same_target_jobs`` (a DataFrame with ``id``) to restrict."""
    fids = manifest.select(file_id_string("name", "bucket").alias("_fid")).distinct()
    t = tasks.withColumn("_fid", task_file_id if task_file_id is not None else F.col("file_id"))
    t = t.join(fids, "_fid", "left_semi").drop("_fid")
    if same_target_jobs is not None:
        t = t.join(same_target_jobs.select(F.col("id").alias("job_id")), "job_id", "left_semi")
    return bulk_finish(t, now)


# ---------------------------------------------------------------------------
# L7 / L8 / L9
# ---------------------------------------------------------------------------

def steps_json(name: str, start: Column, stop: Column) -> Column:
    """The ``steps`` array with one finished step (ISO times, duration in s)."""
    return F.to_json(F.array(F.struct(
        F.lit(name).alias("name"), start.alias("start"), stop.alias("stop"),
        (F.timestamp_diff("MICROSECOND", start, stop) / F.lit(1e6)).alias("duration"),
    )), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def record_outcomes(tasks: DataFrame, verdicts: DataFrame, now, started=None) -> DataFrame:
    """Version rows from per-file verdicts
    ``(file_id, status 'success'|'error', error, row_count)``: result set,
    ``data.row_count`` / ``data.error`` filled, one ``download`` step (the
    step the load statistics, A6, measure): from ``started`` to ``stopped``
    of the file's verdict where it has them, else from ``started`` to now."""
    nowc = _now(now)
    start = nowc if started is None else _now(started)
    timed = {"started", "stopped"} <= set(verdicts.columns)
    v = verdicts.select(
        F.col("file_id").cast("string").alias("file_id"), "status", "error", "row_count",
        *((F.coalesce(F.col(c) if timed else F.lit(None), other).cast("timestamp_ntz").alias(f"_{c}")
           for c, other in (("started", start), ("stopped", nowc)))))
    d = task_data("data")
    j = tasks.where(F.col("finished").isNull()).join(v, "file_id", "inner")
    new_data = F.to_json(F.struct(
        d["scheme"].alias("scheme"), d["key_name"].alias("key_name"), d["bucket"].alias("bucket"),
        F.col("row_count").alias("row_count"),
        F.when(F.col("status") == "error", F.col("error")).alias("error"),
    ))
    return j.select(
        "id", "created", new_data.alias("data"), F.col("status").alias("result"),
        F.coalesce("execution_id", F.lit("0")).alias("execution_id"),
        steps_json("download", F.col("_started"), F.col("_stopped")).alias("steps"), "job_id", "file_id", "bytes_total",
        F.col("bytes_total").alias("bytes_downloaded"), "download_rate", "md5",
        F.col("_started").alias("started"), nowc.alias("last_contact"),
        (F.col("update_count") + 1).alias("update_count"), nowc.alias("finished"),
    )


def retry_errors(tasks: DataFrame, now, job_prefix: str | None = None) -> DataFrame:
    """Reset ERROR tasks to QUEUED: lease, heartbeat, start, steps,
    finish and result cleared; ``time_left`` dropped from ``data``;
    ``bytes_downloaded`` / ``download_rate`` left as they are (the
    reference's UPDATE does not write them)."""
    d = task_data("data")
    errored = tasks.where(prefix_filter("job_id", job_prefix)).where(task_state(_now(now)) == TaskState.ERROR)
    kept = F.to_json(F.struct(*[d[k].alias(k) for k in
                                ("scheme", "key_name", "bucket", "conn_id", "row_count", "error")]))
    return errored.withColumns({
        "last_contact": F.lit(None).cast("timestamp_ntz"),
        "update_count": F.col("update_count") + 1,
        "started": F.lit(None).cast("timestamp_ntz"),
        "steps": F.lit(None).cast("string"),
        "execution_id": F.lit(None).cast("string"),
        "finished": F.lit(None).cast("timestamp_ntz"),
        "data": kept,
        "result": F.lit(None).cast("string"),
    })
