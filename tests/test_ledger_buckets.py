"""The ledger's buckets: versions meet without a shuffle, whatever wrote them."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sluice.operators.ledger import (
    TASKS_SCHEMA, append_versions, bulk_finish, compact_ledger, create_ledger, current_versions, read_ledger,
    read_versions, retry_errors,
)
from sluice.plans import fixtures as fx

NOW = "2005-01-01 00:00:00"


def _tasks(spark):
    return fx.tasks_view(spark, SF001).withColumnRenamed("file_key", "file_id")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.select("id", "update_count", "result", "finished").collect()), key=str)


def _filled(spark, path):
    """A ledger of three appends: all tasks, those cancelled, those retried."""
    tasks = _tasks(spark)
    changes = bulk_finish(tasks, NOW, F.col("bytes_total") % 3 == 0), retry_errors(tasks, NOW)
    for part in (tasks, *changes):
        append_versions(part, path)
    return tasks.unionByName(changes[0]).unionByName(changes[1])


def test_versions_meet_without_a_shuffle(spark, scratch):
    path = scratch("ledger")
    versions = _filled(spark, path)
    jobs, tasks = read_ledger(spark, path)
    assert jobs.count() == 0
    assert "Exchange" not in _plan(tasks)
    assert "Exchange" in _plan(current_versions(versions))
    assert _rows(tasks) == _rows(current_versions(versions))


def test_filters_before_versions_keep_the_buckets(spark, scratch):
    path = scratch("ledger")
    _filled(spark, path)
    _, versions = read_versions(spark, path)
    one = versions.agg(F.min("id"), F.min("job_id")).first()
    of_job = current_versions(versions.where(F.col("job_id").startswith(one[1])))
    assert "Exchange" not in _plan(of_job) and of_job.count() > 0
    by_id = current_versions(versions.where(F.col("id") == one[0]))
    assert "SelectedBucketsCount: 1 out of 8" in by_id._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    few = versions.join(F.broadcast(versions.select("job_id").distinct().limit(3)), "job_id", "left_semi")
    assert "Exchange hashpartitioning(id" not in _plan(current_versions(few))


def test_each_append_adds_one_file_a_bucket(spark, scratch):
    path = scratch("ledger")
    assert create_ledger(spark, path, 4) == 4 and create_ledger(spark, path, 9) == 4
    tasks = _tasks(spark)
    for n in (1, 2):
        append_versions(tasks.repartition(7), path)
        files = spark.read.parquet(path + "/tasks").select(F.input_file_name()).distinct().count()
        assert files == 4 * n
    assert read_ledger(spark, path)[1].count() == tasks.count()


def test_ledgers_without_buckets_are_read_and_compacted_into_some(spark, scratch):
    old, new = scratch("old"), scratch("new")
    tasks = _tasks(spark)
    tasks.write.parquet(old + "/tasks")
    assert create_ledger(spark, old) is None
    append_versions(retry_errors(tasks, NOW), old)
    compact_ledger(spark, old, new, buckets=5)
    got = read_ledger(spark, new)[1]
    assert "Exchange" not in _plan(got) and "out of 5" in got._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert _rows(got) == _rows(read_ledger(spark, old)[1])
    with pytest.raises(ValueError, match="holds a ledger already"):
        compact_ledger(spark, old, new)


def test_empty_ledger_and_empty_append(spark, scratch):
    path = scratch("it's a ledger")
    assert read_ledger(spark, path)[1].count() == 0
    append_versions(spark.createDataFrame([], TASKS_SCHEMA), path)
    assert read_ledger(spark, path)[1].count() == 0
    tasks = _tasks(spark)
    append_versions(tasks.select(*reversed(tasks.columns)), path)
    assert read_ledger(spark, path)[1].count() == tasks.count()


def test_appends_of_another_session_are_seen(spark, scratch):
    path = scratch("ledger")
    tasks = _tasks(spark)
    append_versions(tasks, path)
    before = read_ledger(spark, path)[1].where("result = 'cancelled'").count()
    other = spark.newSession()
    append_versions(bulk_finish(_tasks(other), NOW), path)
    assert read_ledger(spark, path)[1].where("result = 'cancelled'").count() > before
