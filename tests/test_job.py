"""A ledger-tracked load job: first load, unchanged re-run, one file changed, force."""

from pyspark.sql import functions as F

from sluice.operators.job import run_load_job
from sluice.operators.ledger import read_ledger
from sluice.operators.load import read_target
from sluice.plans.reports import job_details, job_load_stats, jobs_report
from sluice.session import local_path
from sluice.sources.delimited import TextOptions, replace_files, write_delimited
from sluice.spec import LoadSpec, SourceSpec, TargetSpec


def test_job_cycle(spark, scratch):
    df = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") * 10).alias("b"), (F.col("id") % 3).alias("_k"))
    landing = scratch("landing")
    write_delimited(df, landing, TextOptions(), columns=["a", "b"], file_key="_k", files=3, stable_names=True)
    ledger = scratch("ledger")
    spec = LoadSpec(SourceSpec(paths=(local_path(landing) + "/key=*/data.txt",)),
                    TargetSpec(path=scratch("target"), schema="a BIGINT, b BIGINT, fid DECIMAL(20,0)", table="t"),
                    TextOptions(columns=("a", "b"), file_id_column="fid"))
    now = "2020-01-01 00:00:00"
    r1 = run_load_job(spark, spec, ledger, now=now)
    assert (r1.submitted, r1.ignored) == (3, 0)
    assert read_target(spark, spec).count() == 300
    r2 = run_load_job(spark, spec, ledger, now=now)
    assert r2.job_id is None and r2.ignored == 3
    changed = df.where("_k = 1").withColumn("b", F.col("b") + 1)
    d2 = scratch("v2")
    write_delimited(changed, d2, TextOptions(), columns=["a", "b"], file_key="_k", files=1, stable_names=True)
    replace_files(spark, d2, landing)
    r3 = run_load_job(spark, spec, ledger, now=now)
    assert (r3.submitted, r3.ignored) == (1, 2)
    t = read_target(spark, spec)
    assert t.count() == 300
    assert t.where("a % 3 = 1 AND b = a * 10 + 1").count() == 100
    r4 = run_load_job(spark, spec, ledger, now=now, force=True)
    assert r4.submitted == 3
    # a producer empties one file: sync sees the new fingerprint and removes its rows
    from sluice.sources.delimited import truncate_file
    truncate_file(spark, f"{landing}/key=2/data.txt")
    r5 = run_load_job(spark, spec, ledger, now=now)
    assert (r5.submitted, r5.ignored) == (1, 2)
    assert read_target(spark, spec).count() == 200
    write_delimited(df.where("_k = 2"), d2 + "-back", TextOptions(), columns=["a", "b"], file_key="_k", files=1,
                    stable_names=True)
    replace_files(spark, d2 + "-back", landing)
    assert run_load_job(spark, spec, ledger, now=now).submitted == 1
    jobs, tasks = read_ledger(spark, ledger)
    assert jobs.count() == 5
    from sluice.operators.ledger import read_job_tasks
    one = jobs.orderBy("id").first().id
    j1, t1 = read_job_tasks(spark, ledger, one)
    assert j1.count() == 1 and t1.count() == tasks.where(F.col("job_id") == one).count()
    assert "StringStartsWith" in t1._jdf.queryExecution().executedPlan().toString()
    rep = {r.id: r for r in jobs_report(jobs, tasks, now).collect()}
    assert all(r.state == "FINISHED" for r in rep.values())
    det = job_details(jobs, tasks, now).collect()
    assert sorted(r.tasks_succeeded for r in det) == [1, 1, 1, 3, 3]
    stats = sorted((r.files_loaded, r.rows_loaded) for r in job_load_stats(tasks, now).collect())
    assert stats == [(1, 0), (1, 100), (1, 100), (3, 300), (3, 300)]
    assert read_target(spark, spec).count() == 300


def test_compact_ledger_keeps_reports(spark, scratch):
    from sluice.operators.ledger import append_versions, cancel_jobs, compact_ledger, enqueue, job_row
    ledger = scratch("ledger")
    m = spark.createDataFrame([("file", None, f"/d/f{i}", f"e{i}", i) for i in range(20)],
                              "scheme STRING, bucket STRING, name STRING, etag STRING, size BIGINT")
    now = "2020-01-01 00:00:00"
    append_versions(enqueue(m, "j1", now), ledger)
    append_versions(job_row(spark, "j1", now, "{}"), ledger, table="jobs")
    jobs, tasks = read_ledger(spark, ledger)
    append_versions(cancel_jobs(jobs, tasks, now, job_prefix="j1"), ledger)
    out = scratch("compact")
    compact_ledger(spark, ledger, out)
    a = jobs_report(*read_ledger(spark, ledger), now).collect()
    b = jobs_report(*read_ledger(spark, out), now).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert a[0].tasks_cancelled == 20 and a[0].state == "CANCELLED"
    assert spark.read.parquet(out + "/tasks").count() == 20
