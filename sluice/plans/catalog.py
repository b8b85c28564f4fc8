"""Registry of the queries exposed through ``__spark_entry__``.

Every query reads the driver's tables (or ledger views Spark derives from
them) in full; each has a DuckDB oracle unless it is not SQL-expressible.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.plans import fixtures as fx
from sluice.plans import reports as rp
from sluice.session import FIXTURE_NOW

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


NOW = fx.ORACLE_NOW
W = fx.oracle_with

# --- shared oracle fragments ------------------------------------------------

_QUEUED = f"(finished IS NULL AND (execution_id IS NULL OR last_contact <= {NOW} - INTERVAL 120 SECOND))"
_TASK_STATE = f"(CASE WHEN finished IS NOT NULL THEN upper(result) WHEN {_QUEUED} THEN 'QUEUED' ELSE 'RUNNING' END)"
_ROLLUP = f"""
roll AS (
  SELECT job_id,
         min(started) AS first_task_start,
         max(last_contact) AS last_contact,
         count(id) AS tasks_total,
         CAST(sum(CAST(result = 'cancelled' AS BIGINT)) AS BIGINT) AS tasks_cancelled,
         CAST(sum(CAST(result = 'error' AS BIGINT)) AS BIGINT) AS tasks_errored,
         CAST(sum(CAST(result = 'success' AS BIGINT)) AS BIGINT) AS tasks_succeeded,
         CAST(sum(CAST(finished IS NOT NULL AS BIGINT)) AS BIGINT) AS tasks_finished,
         CAST(sum(CAST({_QUEUED} AS BIGINT)) AS BIGINT) AS tasks_queued,
         CAST(sum(bytes_total) AS BIGINT) AS bytes_total,
         CAST(sum(bytes_downloaded) AS BIGINT) AS bytes_downloaded,
         CAST(sum(download_rate) AS BIGINT) AS download_rate
  FROM tasks GROUP BY job_id)"""
_JOB_STATE = """(CASE WHEN (r.tasks_total - r.tasks_finished) = 0 AND r.tasks_cancelled > 0 THEN 'CANCELLED'
       WHEN r.tasks_total IS NULL OR r.tasks_finished = r.tasks_total THEN 'FINISHED'
       WHEN r.tasks_queued = r.tasks_total THEN 'QUEUED'
       ELSE 'RUNNING' END)"""
_JOBS_REPORT = f"""
report AS (
  SELECT id, created, last_contact, spec, tasks_total, tasks_cancelled, tasks_errored, tasks_queued,
         tasks_running, tasks_finished, state, bytes_total, bytes_downloaded, download_rate, first_task_start,
         round(CASE WHEN state = 'RUNNING' AND last_contact IS NOT NULL AND first_task_start IS NOT NULL
                         AND bytes_downloaded IS NOT NULL AND bytes_downloaded <> 0
                         AND bytes_downloaded / greatest(span, 1.0) > 0
                    THEN CASE WHEN span < 1 THEN floor((bytes_total - bytes_downloaded) / bytes_downloaded)
                              ELSE (bytes_total - bytes_downloaded) / (bytes_downloaded / greatest(span, 1.0)) END
                    ELSE -1.0 END, 6) AS time_left
  FROM (
    SELECT j.id, j.created, r.last_contact, j.spec,
           coalesce(r.tasks_total, 0) AS tasks_total,
           coalesce(r.tasks_cancelled, 0) AS tasks_cancelled,
           coalesce(r.tasks_errored, 0) AS tasks_errored,
           coalesce(r.tasks_queued, 0) AS tasks_queued,
           coalesce(r.tasks_total - r.tasks_queued - r.tasks_finished, 0) AS tasks_running,
           coalesce(r.tasks_finished, 0) AS tasks_finished,
           {_JOB_STATE} AS state,
           r.bytes_total, r.bytes_downloaded, r.download_rate, r.first_task_start,
           date_diff('microsecond', r.first_task_start, r.last_contact) / 1e6 AS span
    FROM jobs j LEFT JOIN roll r ON r.job_id = j.id) x)"""


def _views(spark, sf_dir, *names):
    out = []
    for n in names:
        if n == "jobs":
            out.append(fx.jobs_view(spark, sf_dir))
        elif n == "tasks":
            out.append(fx.tasks_view(spark, sf_dir))
        elif n == "manifest":
            out.append(fx.manifest_view(spark, sf_dir))
        elif n == "samples":
            out.append(fx.samples_view(spark, sf_dir))
    return out[0] if len(out) == 1 else out


# --- reports ---------------------------------------------------------------

@register("jobs_report", W("jobs", "tasks") + "," + _ROLLUP + "," + _JOBS_REPORT + "\nSELECT * FROM report")
def q_jobs_report(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.jobs_report(jobs, tasks, FIXTURE_NOW)


@register("jobs_by_state", W("jobs", "tasks") + "," + _ROLLUP + "," + _JOBS_REPORT
          + "\nSELECT id, state, tasks_total, tasks_queued, tasks_running, time_left FROM report"
            " WHERE state IN ('QUEUED', 'RUNNING')")
def q_jobs_by_state(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.jobs_report(jobs, tasks, FIXTURE_NOW, states=["QUEUED", "RUNNING"]).select(
        "id", "state", "tasks_total", "tasks_queued", "tasks_running", "time_left")


@register("jobs_page", W("jobs", "tasks") + "," + _ROLLUP + "," + _JOBS_REPORT
          + "\nSELECT id, created, state, tasks_total FROM report ORDER BY created DESC, id LIMIT 20 OFFSET 20")
def q_jobs_page(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.jobs_report(jobs, tasks, FIXTURE_NOW, order_by="created", order="DESC", page=2,
                          page_size=20).select("id", "created", "state", "tasks_total")


@register("job_detail", W("jobs", "tasks") + "," + _ROLLUP + f"""
SELECT j.id, j.created,
       coalesce(r.tasks_total, 0) AS tasks_total,
       coalesce(r.tasks_queued, 0) AS tasks_queued,
       coalesce(r.tasks_total - r.tasks_queued - r.tasks_finished, 0) AS tasks_running,
       coalesce(r.tasks_finished, 0) AS tasks_finished,
       coalesce(r.tasks_cancelled, 0) AS tasks_cancelled,
       coalesce(r.tasks_succeeded, 0) AS tasks_succeeded,
       coalesce(r.tasks_errored, 0) AS tasks_errored,
       {_JOB_STATE} AS state,
       CASE WHEN coalesce(r.tasks_total, 0) > 0 THEN round(coalesce(r.tasks_succeeded, 0) / r.tasks_total, 6) END AS success_rate,
       CASE WHEN coalesce(r.tasks_total, 0) > 0 THEN round(coalesce(r.tasks_errored, 0) / r.tasks_total, 6) END AS error_rate,
       json_extract_string(j.spec, '$.target.database') AS database,
       json_extract_string(j.spec, '$.target.table') AS "table"
FROM jobs j LEFT JOIN roll r ON r.job_id = j.id""")
def q_job_detail(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.job_details(jobs, tasks, FIXTURE_NOW)


@register("job_load_stats", W("tasks") + f"""
SELECT job_id, count(*) AS files_loaded,
       CAST(sum(coalesce(CAST(json_extract(data, '$.row_count') AS BIGINT), 0)) AS BIGINT) AS rows_loaded,
       CAST(floor(sum(coalesce(CAST(json_extract(data, '$.row_count') AS BIGINT), 0)) / count(*)) AS BIGINT) AS avg_rows_per_file,
       CASE WHEN date_diff('microsecond', min(dl_start), max(dl_stop)) > 0 THEN
            round(sum(coalesce(CAST(json_extract(data, '$.row_count') AS BIGINT), 0))
                  / (date_diff('microsecond', min(dl_start), max(dl_stop)) / 1e6), 6) END AS avg_rows_per_second
FROM (SELECT job_id, data,
             CAST(json_extract_string(steps, '$[0].start') AS TIMESTAMP) AS dl_start,
             CAST(json_extract_string(steps, '$[0].stop') AS TIMESTAMP) AS dl_stop
      FROM tasks WHERE {_TASK_STATE} = 'SUCCESS') s
GROUP BY job_id""")
def q_job_load_stats(spark, sf_dir):
    tasks = _views(spark, sf_dir, "tasks")
    return rp.job_load_stats(tasks, FIXTURE_NOW)


_TASK_COLS = f"""t.id, t.job_id, t.created, t.started, t.finished, t.last_contact, t.result, t.bytes_total,
       t.bytes_downloaded, t.download_rate, t.md5, {_TASK_STATE.replace('finished', 't.finished').replace('result', 't.result').replace('execution_id', 't.execution_id').replace('last_contact', 't.last_contact')} AS state,
       json_extract_string(t.data, '$.key_name') AS key_name,
       coalesce(nullif(json_extract_string(t.data, '$.error'), ''), '') AS error_msg"""


@register("tasks_report", W("jobs", "tasks") + f"""
SELECT {_TASK_COLS}
FROM tasks t JOIN jobs j ON j.id = t.job_id""")
def q_tasks_report(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.tasks_report(jobs, tasks, FIXTURE_NOW)


@register("tasks_by_state", W("jobs", "tasks") + f"""
SELECT * FROM (SELECT {_TASK_COLS}
FROM tasks t JOIN jobs j ON j.id = t.job_id) x WHERE state IN ('ERROR', 'CANCELLED')""")
def q_tasks_by_state(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.tasks_report(jobs, tasks, FIXTURE_NOW, states=["ERROR", "CANCELLED"])


@register("tasks_page", W("jobs", "tasks") + f"""
SELECT id, key_name, state FROM (SELECT {_TASK_COLS}
FROM tasks t JOIN jobs j ON j.id = t.job_id) x ORDER BY key_name DESC, id LIMIT 50 OFFSET 100""")
def q_tasks_page(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.tasks_report(jobs, tasks, FIXTURE_NOW, order_by="key_name", order="DESC", page=3,
                           page_size=50).select("id", "key_name", "state")


@register("target_jobs", W("jobs") + """
SELECT id, created, json_extract_string(spec, '$.target.database') AS database,
       json_extract_string(spec, '$.target.table') AS "table"
FROM jobs
WHERE json_extract_string(spec, '$.connection.host') = 'h'
  AND CAST(json_extract(spec, '$.connection.port') AS INTEGER) = 3306
  AND json_extract_string(spec, '$.target.database') = 'db'
  AND json_extract_string(spec, '$.target.table') = 't3'""")
def q_target_jobs(spark, sf_dir):
    jobs = _views(spark, sf_dir, "jobs")
    return rp.target_jobs(jobs, "h", 3306, "db", "t3")


@register("queue_depth", W("tasks") + f"SELECT count(*) AS queued FROM tasks WHERE {_QUEUED}")
def q_queue_depth(spark, sf_dir):
    return rp.queue_depth(_views(spark, sf_dir, "tasks"), FIXTURE_NOW)


@register("oldest_queued", W("tasks") + f"""
SELECT id, job_id, created, execution_id, last_contact FROM tasks WHERE {_QUEUED}
ORDER BY created, id LIMIT 5""")
def q_oldest_queued(spark, sf_dir):
    return rp.oldest_queued(_views(spark, sf_dir, "tasks"), FIXTURE_NOW)


@register("stale_tasks", W("tasks") + f"""
SELECT id, job_id, last_contact, CAST(date_diff('second', last_contact, {NOW}) AS BIGINT) AS seconds_silent
FROM tasks WHERE finished IS NULL AND execution_id IS NOT NULL AND last_contact <= {NOW} - INTERVAL 120 SECOND""")
def q_stale_tasks(spark, sf_dir):
    return rp.stale_tasks(_views(spark, sf_dir, "tasks"), FIXTURE_NOW)


@register("outcome_summary", W("tasks") + f"""
SELECT job_id, count(*) FILTER (WHERE {_TASK_STATE} = 'SUCCESS') AS successful,
       count(*) FILTER (WHERE {_TASK_STATE} = 'ERROR') AS errored,
       count(*) FILTER (WHERE {_TASK_STATE} = 'CANCELLED') AS cancelled
FROM tasks GROUP BY job_id""")
def q_outcome_summary(spark, sf_dir):
    return rp.outcome_summary(_views(spark, sf_dir, "tasks"), FIXTURE_NOW)


@register("first_errors", W("tasks") + f"""
SELECT job_id, id, rank, error FROM (
  SELECT job_id, id, json_extract_string(data, '$.error') AS error,
         row_number() OVER (PARTITION BY job_id ORDER BY id) AS rank
  FROM tasks WHERE {_TASK_STATE} = 'ERROR') x
WHERE rank <= 10 AND error IS NOT NULL AND error <> ''""")
def q_first_errors(spark, sf_dir):
    return rp.first_errors(_views(spark, sf_dir, "tasks"), FIXTURE_NOW)


# --- SQL twins of the text functions (oracle side) --------------------------

def _sql_size(x: str) -> str:
    units = ["B", "KB", "MB", "GB", "TB"]
    parts, scaled = [], f"CAST({x} AS DOUBLE)"
    for u in units:
        parts.append(f"WHEN {scaled} < 1024.0 THEN format('{{:,.1f}} {u}', {scaled})")
        scaled = f"({scaled} / 1024.0)"
    return "(CASE " + " ".join(parts) + f" ELSE format('{{:,.1f}} PB', {scaled}) END)"


def _sql_time_piece(v: str, unit: str) -> str:
    return f"printf('%2.0f %s%s left', {v}, '{unit}', CASE WHEN round({v}) <> 1 THEN 's' ELSE '' END)"


def _sql_time(x: str) -> str:
    t = f"CAST({x} AS DOUBLE)"
    parts = [f"WHEN {t} = -1 THEN 'estimating...'"]
    scaled = t
    for unit, step in zip(["sec", "min", "hour"], [60, 60, 24]):
        parts.append(f"WHEN {scaled} < {step} THEN {_sql_time_piece(scaled, unit)}")
        scaled = f"({scaled} / {float(step)})"
    return "(CASE " + " ".join(parts) + f" ELSE {_sql_time_piece(scaled, 'day')} END)"


def _sql_pad(kind: str, s: str, w: int | str) -> str:
    return f"{kind}({s}, CAST(greatest({w}, length({s})) AS INTEGER), ' ')"


def _sql_bar(cur: str, tot: str) -> str:
    c, t = f"coalesce({cur}, 0)", f"coalesce({tot}, 0)"
    frac = f"(CASE WHEN {t} = 0 THEN 0.0 ELSE CAST({c} AS DOUBLE) / CAST({t} AS DOUBLE) END)"
    pct = f"(CAST(CAST(trunc({frac} * 100) AS BIGINT) AS VARCHAR) || '%')"
    head = _sql_pad("rpad", pct, 4)
    tail = f"({_sql_pad('lpad', _sql_size(c), 10)} || '/' || {_sql_pad('rpad', _sql_size(t), 10)})"
    bare = f"({head} || ' ' || {tail})"
    bw = f"(50 - length({bare}) - 3)"
    filled = f"CAST(trunc({bw} * {frac}) AS BIGINT)"
    bar = f"(repeat('=', {filled}) || CASE WHEN {filled} <> {bw} AND {frac} <> 0 THEN '>' ELSE '' END)"
    boxed = f"('[' || {_sql_pad('rpad', bar, bw)} || ']')"
    return f"(CASE WHEN {bw} <= 0 THEN {bare} ELSE {head} || ' ' || {boxed} || ' ' || {tail} END)"


def _sql_rate(x: str) -> str:
    return f"({_sql_pad('lpad', _sql_size(f'coalesce({x}, 0)'), 10)} || '/s')"


def _sql_time_cell(x: str) -> str:
    return _sql_pad("lpad", _sql_time(f"coalesce({x}, -1)"), 13)


def _sql_fileid(x: str) -> str:
    return f"CAST(('0x' || substr(sha256({x}), 1, 16))::UBIGINT AS VARCHAR)"


# --- ps ----------------------------------------------------------------------

@register("active_tasks", W("tasks") + f""",
run AS (SELECT id AS task_id, job_id, json_extract_string(data, '$.key_name') AS file, bytes_downloaded,
               bytes_total, download_rate, TRY_CAST(json_extract(data, '$.time_left') AS DOUBLE) AS tl, last_contact
        FROM tasks WHERE {_TASK_STATE} = 'RUNNING')
SELECT task_id, job_id, file, {_sql_bar('bytes_downloaded', 'bytes_total')} AS progress,
       {_sql_rate('download_rate')} AS rate, {_sql_time_cell('tl')} AS time_left, last_contact
FROM run
UNION ALL
SELECT 'Total', '', '', {_sql_bar('bd', 'bt')}, {_sql_rate('dr')}, {_sql_time_cell('greatest(tl, -1.0)')},
       CAST(NULL AS TIMESTAMP)
FROM (SELECT count(*) AS n, sum(coalesce(bytes_downloaded, 0)) AS bd, sum(coalesce(bytes_total, 0)) AS bt,
             sum(coalesce(download_rate, 0)) AS dr, max(coalesce(tl, -1.0)) AS tl FROM run) s
WHERE n > 1""")
def q_active_tasks(spark, sf_dir):
    return rp.ps_tasks(_views(spark, sf_dir, "tasks"), FIXTURE_NOW, order_by="progress")


def _sql_frac(d, t, w):
    return (f"({_sql_pad('lpad', f'CAST({d} AS VARCHAR)', w)} || '/' || "
            f"{_sql_pad('rpad', f'CAST({t} AS VARCHAR)', w)} || ' finished')")


@register("active_jobs", W("jobs", "tasks") + "," + _ROLLUP + "," + _JOBS_REPORT + f""",
act AS (SELECT * FROM report WHERE state IN ('QUEUED', 'RUNNING')),
wid AS (SELECT length(CAST(coalesce(sum(tasks_total), 0) AS VARCHAR)) AS w FROM act)
SELECT id AS job_id, {_sql_frac('tasks_finished', 'tasks_total', 'w')} AS tasks,
       {_sql_bar('bytes_downloaded', 'bytes_total')} AS progress, {_sql_rate('download_rate')} AS rate,
       {_sql_time_cell('time_left')} AS time_left, last_contact
FROM act, wid
UNION ALL
SELECT 'Total', {_sql_frac('tf', 'tt', 'w')}, {_sql_bar('bd', 'bt')}, {_sql_rate('dr')},
       {_sql_time_cell('greatest(tl, -1.0)')}, CAST(NULL AS TIMESTAMP)
FROM (SELECT count(*) AS n, sum(tasks_finished) AS tf, sum(tasks_total) AS tt,
             sum(coalesce(bytes_downloaded, 0)) AS bd, sum(coalesce(bytes_total, 0)) AS bt,
             sum(coalesce(download_rate, 0)) AS dr, max(coalesce(time_left, -1.0)) AS tl FROM act) s, wid
WHERE n > 1""")
def q_active_jobs(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.ps_jobs(jobs, tasks, FIXTURE_NOW)


# the same tasks with an estimate of the time left in four of five rows' data
_TIMED_SQL = W("jobs", "tasks").replace(",\ntasks AS (", ",\nplain_tasks AS (") + """, tasks AS (
SELECT * REPLACE (CASE WHEN bytes_total % 5 = 0 THEN data ELSE substr(data, 1, length(data) - 1) || ',"time_left":' ||
                  CAST(bytes_total % 100000 AS VARCHAR) || '.5}' END AS data) FROM plain_tasks)"""


def _timed(tasks):
    return tasks.withColumn("data", F.when(F.col("bytes_total") % 5 == 0, F.col("data")).otherwise(F.concat(
        F.expr("substring(data, 1, length(data) - 1)"), F.lit(',"time_left":'),
        (F.col("bytes_total") % 100000).cast("string"), F.lit(".5}"))))


@register("active_tasks_time_left", ORACLES["active_tasks"].replace(W("tasks"), _TIMED_SQL))
def q_active_tasks_time_left(spark, sf_dir):
    return rp.ps_tasks(_timed(_views(spark, sf_dir, "tasks")), FIXTURE_NOW, order_by="time_left")


@register("active_jobs_time_left", ORACLES["active_jobs"].replace(W("jobs", "tasks"), _TIMED_SQL))
def q_active_jobs_time_left(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.ps_jobs(jobs, _timed(tasks), FIXTURE_NOW, order_by="time_left")


# --- scalar functions ----------------------------------------------------------

@register("file_id_hash", W("manifest") + f"SELECT name, {_sql_fileid('name')} AS file_id FROM manifest")
def q_file_id_hash(spark, sf_dir):
    from sluice.functions.fileid import file_id
    m = _views(spark, sf_dir, "manifest")
    return m.select("name", file_id("name", "bucket").cast("string").alias("file_id"))


@register("file_id_text", f"SELECT doc_id, {_sql_fileid('text')} AS file_id FROM documents")
def q_file_id_text(spark, sf_dir):
    from sluice.functions.fileid import file_id
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", file_id("text").cast("string").alias("file_id"))


_SIZE_EXPR = "CAST(floor(l_extendedprice) AS DOUBLE) * power(1024, l_linenumber - 1)"


@register("human_size", f"""
SELECT l_orderkey, l_linenumber, {_SIZE_EXPR} AS size, {_sql_size(_SIZE_EXPR)} AS size_text FROM lineitem""")
def q_human_size(spark, sf_dir):
    from pyspark.sql import functions as F
    from sluice.functions.text import human_size
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    size = F.floor("l_extendedprice").cast("double") * F.pow(F.lit(1024.0), F.col("l_linenumber") - 1)
    return li.select("l_orderkey", "l_linenumber", size.alias("size")).withColumn("size_text", human_size("size"))


_SECS_EXPR = "CASE WHEN value < 1 THEN -1.0 ELSE value * power(10, event_id % 6) END"


@register("time_left_text", f"""
SELECT event_id, seconds, {_sql_time('seconds')} AS text FROM (SELECT event_id, {_SECS_EXPR} AS seconds FROM events) e""")
def q_time_left_text(spark, sf_dir):
    from pyspark.sql import functions as F
    from sluice.functions.text import time_left_text
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    secs = F.when(F.col("value") < 1, F.lit(-1.0)).otherwise(
        F.col("value") * F.pow(F.lit(10.0), F.col("event_id") % 6))
    return ev.select("event_id", secs.alias("seconds")).withColumn("text", time_left_text("seconds"))


@register("progress_bar", W("tasks") + f"""
SELECT id, CAST(trunc(CASE WHEN coalesce(bytes_total, 0) = 0 THEN 0.0
                     ELSE coalesce(bytes_downloaded, 0) / bytes_total END * 100) AS INTEGER) AS percent,
       {_sql_bar('bytes_downloaded', 'bytes_total')} AS progress FROM tasks""")
def q_progress_bar(spark, sf_dir):
    from sluice.functions.text import percent_done, progress_bar
    t = _views(spark, sf_dir, "tasks")
    return t.select("id", (percent_done("bytes_downloaded", "bytes_total") * 100).cast("int").alias("percent"),
                    progress_bar("bytes_downloaded", "bytes_total").alias("progress"))


# --- progress windows ---------------------------------------------------------

@register("progress_rate", W("samples") + """
SELECT task_id, seq, ts, bytes_downloaded, bytes_total, delta, round(rate, 6) AS rate,
       round(CASE WHEN rate = 0 THEN -1.0 ELSE (bytes_total - bytes_downloaded) / rate END, 6) AS time_left
FROM (SELECT *, CASE WHEN bytes_downloaded = bytes_total THEN 0.0 ELSE
             avg(delta) OVER (PARTITION BY task_id ORDER BY seq ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) END AS rate
      FROM (SELECT *, bytes_downloaded - lag(bytes_downloaded, 1, 0) OVER (PARTITION BY task_id ORDER BY seq) AS delta
            FROM samples) a) b""")
def q_progress_rate(spark, sf_dir):
    from pyspark.sql import functions as F
    from sluice.operators.progress import with_rates
    r = with_rates(_views(spark, sf_dir, "samples"))
    return r.select("task_id", "seq", "ts", "bytes_downloaded", "bytes_total", "delta",
                    F.round("rate", 6).alias("rate"), F.round("time_left", 6).alias("time_left"))


@register("progress_stall", W("samples") + """
SELECT task_id, seq, ts, delta, last_change, ts > last_change + INTERVAL 30 SECOND AS stalled
FROM (SELECT *, coalesce(last_value(CASE WHEN delta > 10 THEN ts END IGNORE NULLS)
                  OVER (PARTITION BY task_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(ts) OVER (PARTITION BY task_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS last_change
      FROM (SELECT *, bytes_downloaded - lag(bytes_downloaded, 1, 0) OVER (PARTITION BY task_id ORDER BY seq) AS delta
            FROM samples) a) b""")
def q_progress_stall(spark, sf_dir):
    from sluice.operators.progress import with_stall
    s = with_stall(_views(spark, sf_dir, "samples"))
    return s.select("task_id", "seq", "ts", "delta", "last_change", "stalled")


# --- ledger changes -----------------------------------------------------------

_T3 = ("json_extract_string(spec, '$.connection.host') = 'h' AND CAST(json_extract(spec, '$.connection.port') AS INTEGER) = 3306 "
       "AND json_extract_string(spec, '$.target.database') = 'db' AND json_extract_string(spec, '$.target.table') = 't3'")
_CHANGE_COLS = ["id", "job_id", "result", "execution_id", "steps", "started", "finished", "last_contact", "update_count"]
_CANCEL_SQL = f"""SELECT id, job_id, 'cancelled' AS result, '0' AS execution_id, '[]' AS steps, {NOW} AS started,
       {NOW} AS finished, {NOW} AS last_contact, update_count + 1 AS update_count"""


def _t3_filter():
    return rp.same_target("spec", "h", 3306, "db", "t3")


def _cancel_t3(jobs, tasks):
    from sluice.operators.ledger import cancel_jobs
    return cancel_jobs(jobs, tasks, FIXTURE_NOW, job_filter=_t3_filter())


@register("cancel_target_jobs", W("jobs", "tasks") + f"""
{_CANCEL_SQL} FROM tasks WHERE finished IS NULL AND job_id IN (SELECT id FROM jobs WHERE {_T3})""")
def q_cancel_target_jobs(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return _cancel_t3(jobs, tasks).select(*_CHANGE_COLS)


@register("force_cancel", W("tasks", "manifest") + f"""
{_CANCEL_SQL} FROM tasks WHERE finished IS NULL
  AND {_sql_fileid('file_key')} IN (SELECT {_sql_fileid('coalesce(bucket, \'\') || name')} FROM manifest)""")
def q_force_cancel(spark, sf_dir):
    from sluice.functions.fileid import file_id_string
    from sluice.operators.ledger import force_cancel
    tasks, manifest = _views(spark, sf_dir, "tasks", "manifest")
    return force_cancel(tasks, manifest, FIXTURE_NOW, task_file_id=file_id_string("file_key")).select(*_CHANGE_COLS)


@register("retry_errors", W("tasks") + f"""
SELECT id, job_id, CAST(NULL AS VARCHAR) AS result, CAST(NULL AS VARCHAR) AS execution_id, CAST(NULL AS VARCHAR) AS steps,
       CAST(NULL AS TIMESTAMP) AS started, CAST(NULL AS TIMESTAMP) AS finished, CAST(NULL AS TIMESTAMP) AS last_contact,
       update_count + 1 AS update_count, bytes_downloaded,
       json_extract_string(data, '$.key_name') AS key_name, json_extract_string(data, '$.error') AS error
FROM tasks WHERE {_TASK_STATE} = 'ERROR'""")
def q_retry_errors(spark, sf_dir):
    from pyspark.sql import functions as F
    from sluice.functions.fields import task_data
    from sluice.operators.ledger import retry_errors
    r = retry_errors(_views(spark, sf_dir, "tasks"), FIXTURE_NOW)
    r = r.withColumn("_d", task_data("data"))
    return r.select(*_CHANGE_COLS, "bytes_downloaded", F.col("_d")["key_name"].alias("key_name"),
                    F.col("_d")["error"].alias("error"))


@register("current_tasks", W("jobs", "tasks") + f""",
versions AS (
  SELECT id, finished, result, execution_id, last_contact, update_count FROM tasks
  UNION ALL
  SELECT id, {NOW}, 'cancelled', '0', {NOW}, update_count + 1 FROM tasks
  WHERE finished IS NULL AND job_id IN (SELECT id FROM jobs WHERE {_T3})
  UNION ALL
  SELECT id, NULL, NULL, NULL, NULL, update_count + 1 FROM tasks WHERE {_TASK_STATE} = 'ERROR')
SELECT id, update_count, {_TASK_STATE} AS state FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_count DESC) AS rn FROM versions) v WHERE rn = 1""")
def q_current_tasks(spark, sf_dir):
    from sluice.functions.states import STATE_COLUMNS, now_literal, task_state
    from sluice.operators.ledger import current_versions, retry_errors
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    versions = tasks.unionByName(_cancel_t3(jobs, tasks)).unionByName(retry_errors(tasks, FIXTURE_NOW))
    cur = current_versions(versions, columns=["update_count", *STATE_COLUMNS])
    return cur.select("id", "update_count", task_state(now_literal(FIXTURE_NOW)).alias("state"))


@register("task_by_id", W("tasks") + f"""
SELECT {_TASK_COLS} FROM tasks t WHERE t.id = (SELECT min(id) FROM tasks)""")
def q_task_by_id(spark, sf_dir):
    from pyspark.sql import functions as F
    tasks = _views(spark, sf_dir, "tasks")
    first_id = tasks.select(F.min("id")).scalar()
    return rp.task_by_id(tasks, FIXTURE_NOW, first_id)


# --- what a new job loads -----------------------------------------------------------

_COMPETING = f"(SELECT id FROM jobs WHERE {_T3} AND created < CAST('1995-09-01' AS TIMESTAMP))"
_KNOWN = f"""(SELECT md5, json_extract_string(data, '$.key_name') AS key_name,
        json_extract_string(data, '$.bucket') AS bucket FROM tasks
 WHERE job_id IN {_COMPETING} AND {_TASK_STATE} IN ('QUEUED', 'RUNNING', 'SUCCESS') AND md5 IS NOT NULL)"""
_SKIP_SQL = f"""SELECT m.scheme, m.bucket, m.name, m.etag, m.size, {_sql_fileid("coalesce(m.bucket, '') || m.name")} AS file_id
FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM {_KNOWN} k
  WHERE k.md5 = m.etag AND k.key_name = m.name AND k.bucket IS NOT DISTINCT FROM m.bucket)"""


def _competing(jobs):
    from sluice.operators.submit import competing_jobs
    return competing_jobs(jobs, "h", 3306, "db", "t3", created_before="1995-09-01 00:00:00")


@register("skip_unchanged", W("jobs", "tasks", "manifest") + _SKIP_SQL)
def q_skip_unchanged(spark, sf_dir):
    from sluice.operators.submit import skip_unchanged
    jobs, tasks, manifest = _views(spark, sf_dir, "jobs", "tasks", "manifest")
    return skip_unchanged(manifest, tasks, _competing(jobs), FIXTURE_NOW)


# files of three buckets (one of them none), and tasks of such files
_BUCKET_SQL = W("jobs", "tasks", "manifest").replace(",\ntasks AS (", ",\nplain_tasks AS (").replace(
    ",\nmanifest AS (", ",\nplain_manifest AS (") + """, tasks AS (
SELECT * REPLACE (CASE WHEN bytes_total % 3 = 0 THEN data ELSE substr(data, 1, length(data) - 1) || ',"bucket":"b' ||
                  CAST(bytes_total % 3 AS VARCHAR) || '"}' END AS data) FROM plain_tasks), manifest AS (
SELECT * REPLACE (CASE WHEN size % 3 > 0 THEN 'b' || CAST(size % 3 AS VARCHAR) END AS bucket) FROM plain_manifest)"""


@register("skip_unchanged_buckets", _BUCKET_SQL + _SKIP_SQL)
def q_skip_unchanged_buckets(spark, sf_dir):
    from sluice.operators.submit import skip_unchanged
    jobs, tasks, manifest = _views(spark, sf_dir, "jobs", "tasks", "manifest")
    tasks = tasks.withColumn("data", F.when(F.col("bytes_total") % 3 == 0, F.col("data")).otherwise(F.concat(
        F.expr("substring(data, 1, length(data) - 1)"), F.lit(',"bucket":"b'),
        (F.col("bytes_total") % 3).cast("string"), F.lit('"}'))))
    manifest = manifest.withColumn("bucket", F.when(
        F.col("size") % 3 > 0, F.concat(F.lit("b"), (F.col("size") % 3).cast("string"))))
    return skip_unchanged(manifest, tasks, _competing(jobs), FIXTURE_NOW)


@register("submit_counts", W("jobs", "tasks", "manifest") + f"""
SELECT count(*) AS submitted, (SELECT count(*) FROM manifest) - count(*) AS ignored FROM ({_SKIP_SQL}) s""")
def q_submit_counts(spark, sf_dir):
    from sluice.operators.submit import skip_unchanged, submit_counts
    jobs, tasks, manifest = _views(spark, sf_dir, "jobs", "tasks", "manifest")
    return submit_counts(manifest, skip_unchanged(manifest, tasks, _competing(jobs), FIXTURE_NOW))


@register("prior_success", W("jobs", "tasks", "manifest") + f"""
SELECT m.scheme, m.bucket, m.name, m.etag, m.size, {_sql_fileid("coalesce(m.bucket, '') || m.name")} AS file_id
FROM manifest m WHERE {_sql_fileid("coalesce(m.bucket, '') || m.name")} IN (
  SELECT {_sql_fileid('file_key')} FROM tasks WHERE job_id IN {_COMPETING} AND {_TASK_STATE} = 'SUCCESS')""")
def q_prior_success(spark, sf_dir):
    from sluice.functions.fileid import file_id_string
    from sluice.operators.submit import prior_success
    jobs, tasks, manifest = _views(spark, sf_dir, "jobs", "tasks", "manifest")
    return prior_success(manifest, tasks, _competing(jobs), FIXTURE_NOW, task_file_id=file_id_string("file_key"))


@register("names_per_etag", W("jobs", "tasks") + f""",
pairs AS (SELECT md5, key_name, count(*) AS n_tasks FROM {_KNOWN} k GROUP BY md5, key_name)
SELECT p.md5, p.key_name, p.n_tasks, c.n_names FROM pairs p
JOIN (SELECT md5, count(*) AS n_names FROM pairs GROUP BY md5) c ON c.md5 = p.md5""")
def q_names_per_etag(spark, sf_dir):
    from sluice.operators.submit import names_per_etag
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return names_per_etag(tasks, _competing(jobs), FIXTURE_NOW)


# --- loading round trips -----------------------------------------------------------

def _register_round_trips():
    from sluice.plans import roundtrip as rt

    dup = "'Duplicate entry ''' || CAST(min(o_orderkey) AS VARCHAR) || ''' for key ''PRIMARY'''"
    oracles = {
        "load_tsv": "SELECT * FROM part",
        "load_csv_enclosed": "SELECT * FROM documents",
        "load_multiline": "SELECT doc_id, replace(text, 'e ', 'e' || chr(10) || '\"') AS text, lang FROM documents",
        "load_gzip": "SELECT * FROM customer",
        "load_skip_lines": "SELECT * FROM orders",
        "load_line_prefix": "SELECT * FROM supplier",
        "load_multi_sep": "SELECT * FROM events",
        "load_columns": ("SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS DOUBLE) AS l_tax, "
                         "true AS has_file_id FROM lineitem"),
        "load_dup_ignore": ("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 2 "
                            "ELSE o_totalprice END AS o_totalprice FROM orders"),
        "load_dup_replace": ("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 "
                             "ELSE o_totalprice END AS o_totalprice FROM orders"),
        "load_dup_error": ("SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders "
                           "WHERE o_orderkey % 5 = 0 AND o_orderkey % 3 = 1 UNION ALL "
                           "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 2"),
        "load_verdicts": (f"SELECT 'a' AS file, 'error' AS status, {dup} AS error, CAST(0 AS BIGINT) AS row_count "
                          "FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 3 = 1 UNION ALL "
                          "SELECT 'b', 'success', NULL, count(*) FROM orders WHERE o_orderkey % 3 = 2 UNION ALL "
                          f"SELECT 'c', 'error', {dup}, 0 FROM orders WHERE o_orderkey % 21 = 0"),
        "load_error_isolated": (
            "SELECT 'a' AS file, 'error' AS status, 'Incorrect double' AS error, CAST(0 AS BIGINT) AS row_count UNION ALL "
            "SELECT 'b', 'success', NULL, count(*) FROM orders WHERE o_orderkey % 3 = 1 UNION ALL "
            "SELECT 'c', 'error', 'Duplicate entry', 0 UNION ALL "
            "SELECT 'd', 'success', NULL, count(*) FROM orders WHERE o_orderkey % 3 = 2"),
        "load_error_reload": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "reload_changed_file": ("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 5 "
                                "THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal FROM customer "
                                "WHERE c_nationkey <> 5"),
        "reload_bucketed": ("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 5 "
                            "THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal FROM customer "
                            "WHERE c_nationkey <> 5"),
        "dry_run": "SELECT DISTINCT 'key=' || c_mktsegment || '/data.txt' AS name FROM customer",
        "list_flat": ("SELECT DISTINCT 'flat' AS pattern, 'key=' || CAST(c_nationkey AS VARCHAR) || '/data.txt' "
                      "AS name FROM customer"),
        "list_recursive": ("SELECT DISTINCT 'recursive' AS pattern, 'key=' || CAST(c_nationkey AS VARCHAR) "
                           "|| '/data.txt' AS name FROM customer UNION ALL "
                           "SELECT DISTINCT 'recursive', 'deep/key=' || c_mktsegment || '/data.txt' FROM customer "
                           "UNION ALL SELECT DISTINCT 'deep', 'deep/key=' || c_mktsegment || '/data.txt' FROM customer"),
        "list_hidden": (
            "SELECT CASE WHEN c_nationkey < 9 THEN 'data' WHEN c_nationkey <= 15 THEN '_data' ELSE '.data' END || '/key=' || "
            "c_nationkey || '/' || CASE WHEN c_nationkey < 9 THEN 'data' WHEN c_nationkey <= 15 THEN '_data' ELSE '.data' END "
            "|| '.txt' AS name, CAST(CASE WHEN c_nationkey = 0 THEN 0 ELSE "
            "sum(strlen(c_custkey || ' ' || c_name || ' ' || c_mktsegment) + 1) END AS BIGINT) AS size "
            "FROM customer GROUP BY c_nationkey"),
        "load_corrupt_gzip": "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_nationkey <> 3",
        "gzip_verdicts": (
            "SELECT CAST(c_nationkey AS INTEGER) AS nation, CASE WHEN c_nationkey = 3 THEN 'error' ELSE 'success' END AS status, "
            "CASE WHEN c_nationkey = 3 THEN 'corrupt gzip' END AS error, "
            "CASE WHEN c_nationkey = 3 THEN 0 ELSE count(*) END AS row_count FROM customer GROUP BY c_nationkey"),
        "sync_same_content": (
            "SELECT c_custkey, CASE WHEN c_nationkey = 4 THEN upper(c_name) ELSE c_name END AS c_name, "
            "CAST(1 AS BIGINT) AS submitted, (SELECT count(DISTINCT c_nationkey) - 1 FROM customer) AS ignored FROM customer"),
        "retry_loads": "SELECT c_custkey, c_nationkey, c_name, CAST(0 AS BIGINT) AS failed FROM customer",
        "list_patterns": (
            "WITH f AS (SELECT DISTINCT 'key=' || c_nationkey || '/data.txt' AS name FROM customer UNION ALL "
            "SELECT DISTINCT 'deep/key=' || c_mktsegment || '/data.txt' FROM customer), "
            "m AS (SELECT name, CAST(name LIKE 'deep/%' AS BIGINT) + 1 + CAST(name LIKE 'key=1%' AS BIGINT) AS n FROM f) "
            "SELECT name, CAST(1 AS BIGINT) AS times, false AS kept FROM m UNION ALL SELECT name, n, true FROM m"),
        "load_text_options": "SELECT c_name, c_custkey, CAST(NULL AS INTEGER) AS c_nationkey FROM customer",
        "job_cycle": (
            "SELECT CAST(c_nationkey AS INTEGER) AS nation, CASE WHEN c_nationkey = 3 THEN 'error' ELSE 'success' END AS result, "
            "CAST(2 AS BIGINT) AS update_count, CASE WHEN c_nationkey = 3 THEN 0 ELSE count(*) END AS row_count, "
            "CASE WHEN c_nationkey = 3 THEN 'Incorrect' END AS error, CAST(sum(strlen(CASE WHEN c_nationkey = 3 THEN 'oops' "
            "ELSE CAST(c_custkey AS VARCHAR) END || c_nationkey || c_name) + 3) AS BIGINT) AS bytes_total, "
            "'download' AS step, true AS in_order FROM customer GROUP BY c_nationkey"),
        "stored_versions": W("tasks") + f""", s AS (SELECT *, {_TASK_STATE} AS st FROM tasks), v AS (
            SELECT id, update_count, finished, result, execution_id, last_contact FROM s
            UNION ALL SELECT id, update_count + 1, {NOW}, 'cancelled', '0', {NOW} FROM s WHERE finished IS NULL
            UNION ALL SELECT id, update_count + 1, NULL, NULL, NULL, NULL FROM s WHERE st = 'ERROR'
            UNION ALL SELECT id, update_count + 2, {NOW}, 'cancelled', '0', {NOW} FROM s WHERE st = 'ERROR' AND bytes_total % 2 = 0)
            SELECT id, update_count, result, {_TASK_STATE} AS state FROM (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_count DESC) AS rn FROM v) WHERE rn = 1""",
        "load_script": ("SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, "
                        "upper(c_mktsegment) AS c_mktsegment FROM customer"),
        "sync_stream": "SELECT * FROM customer",
        "watch_stream": ("SELECT * REPLACE (CASE WHEN c_nationkey < 5 THEN c_acctbal + 1000 ELSE c_acctbal END "
                         "AS c_acctbal) FROM customer"),
        "heartbeat_stream": W("tasks") + (f"SELECT id AS task_id, last_contact FROM tasks WHERE finished IS NULL "
                                          f"AND execution_id IS NOT NULL AND last_contact <= {NOW} - INTERVAL 120 SECOND"),
    }
    for name, sql in oracles.items():
        register(name, sql)(getattr(rt, name))


_register_round_trips()


@register("last_job", W("jobs") + "SELECT id, created, spec FROM jobs ORDER BY created DESC, id DESC LIMIT 1")
def q_last_job(spark, sf_dir):
    return rp.last_job(_views(spark, sf_dir, "jobs"))


@register("job_lookup", ORACLES["job_detail"] + " WHERE j.id = '00000001'")
def q_job_lookup(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.job_lookup(jobs, tasks, FIXTURE_NOW, "00000001")


@register("cancel_job", W("tasks") + f"""
{_CANCEL_SQL} FROM tasks WHERE finished IS NULL AND job_id = '00000002'""")
def q_cancel_job(spark, sf_dir):
    from sluice.operators.ledger import cancel_jobs
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return cancel_jobs(jobs, tasks, FIXTURE_NOW, job_prefix="00000002", multiple=False).select(*_CHANGE_COLS)


@register("cancel_queued", W("jobs", "tasks") + f"""
{_CANCEL_SQL} FROM tasks WHERE {_QUEUED} AND job_id IN (SELECT id FROM jobs WHERE {_T3})""")
def q_cancel_queued(spark, sf_dir):
    from sluice.operators.ledger import bulk_finish
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    t3 = jobs.where(_t3_filter()).select(F.col("id").alias("job_id"))
    return bulk_finish(tasks.join(t3, "job_id", "left_semi"), FIXTURE_NOW, queued_only=True).select(*_CHANGE_COLS)


@register("job_tasks", W("jobs", "tasks") + f"""
SELECT {_TASK_COLS} FROM tasks t JOIN jobs j ON j.id = t.job_id WHERE j.id LIKE '00000001%'""")
def q_job_tasks(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.tasks_report(jobs, tasks, FIXTURE_NOW, job_prefix="00000001")


@register("cancel_task", W("tasks") + f"""
{_CANCEL_SQL} FROM tasks WHERE id = (SELECT min(id) FROM tasks WHERE finished IS NULL)""")
def q_cancel_task(spark, sf_dir):
    from sluice.operators.ledger import cancel_task
    tasks = _views(spark, sf_dir, "tasks")
    first_open = tasks.where(F.col("finished").isNull()).select(F.min("id")).scalar()
    return cancel_task(tasks, FIXTURE_NOW, first_open).select(*_CHANGE_COLS)


@register("jobs_listing", W("jobs", "tasks") + "," + _ROLLUP + "," + _JOBS_REPORT + """
SELECT id, created, last_contact, state, tasks_queued, tasks_running, tasks_cancelled, tasks_errored,
       tasks_finished, tasks_total, json_extract_string(spec, '$.target.database') AS database,
       json_extract_string(spec, '$.target.table') AS "table"
FROM report""")
def q_jobs_listing(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.jobs_listing(jobs, tasks, FIXTURE_NOW)


@register("last_job_tasks", W("jobs", "tasks") + f"""
SELECT {_TASK_COLS} FROM tasks t
WHERE t.job_id = (SELECT id FROM jobs ORDER BY created DESC, id DESC LIMIT 1)""")
def q_last_job_tasks(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return rp.last_job_tasks(jobs, tasks, FIXTURE_NOW)


@register("live_leases", W("tasks") + f"""
SELECT id, execution_id, last_contact FROM tasks
WHERE execution_id IS NOT NULL AND last_contact > {NOW} - INTERVAL 120 SECOND""")
def q_live_leases(spark, sf_dir):
    from sluice.functions.states import has_live_lease, now_literal
    tasks = _views(spark, sf_dir, "tasks")
    return tasks.where(has_live_lease(now_literal(FIXTURE_NOW))).select("id", "execution_id", "last_contact")


@register("cancel_count", W("jobs", "tasks") + f"""
SELECT count(*) AS cancelled FROM tasks WHERE finished IS NULL AND job_id IN (SELECT id FROM jobs WHERE {_T3})""")
def q_cancel_count(spark, sf_dir):
    jobs, tasks = _views(spark, sf_dir, "jobs", "tasks")
    return _cancel_t3(jobs, tasks).agg(F.count("*").alias("cancelled"))


@register("job_specs", W("jobs") + "SELECT id, spec FROM jobs WHERE id LIKE '0000%'")
def q_job_specs(spark, sf_dir):
    return rp.job_specs(_views(spark, sf_dir, "jobs"), "0000")


@register("job_candidates", W("jobs") + f"SELECT id, created FROM jobs WHERE id LIKE '0000%' AND {_T3}")
def q_job_candidates(spark, sf_dir):
    from sluice.operators.ledger import job_candidates
    return job_candidates(_views(spark, sf_dir, "jobs"), "0000", _t3_filter())


@register("broken_fields", W("tasks") + """
SELECT id, CASE WHEN length(id) % 2 = 0 OR update_count > 1 THEN NULL ELSE json_extract_string(data, '$.key_name') END AS key_name,
       CASE WHEN length(id) % 2 = 0 OR update_count > 1 THEN NULL ELSE TRY_CAST(json_extract(data, '$.row_count') AS BIGINT) END AS row_count
FROM tasks""")
def q_broken_fields(spark, sf_dir):
    """fields of text that is no JSON are NULL."""
    from sluice.functions.fields import task_data
    tasks = _views(spark, sf_dir, "tasks")
    broken = (F.length("id") % 2 == 0) | (F.col("update_count") > 1)
    d = task_data(F.when(broken, F.expr("substring(data, 2)")).otherwise(F.col("data")))
    return tasks.select("id", d["key_name"].alias("key_name"), d["row_count"].alias("row_count"))
