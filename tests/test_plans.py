"""Plan-shape guards for the scale properties PLANS.md relies on."""

import __spark_entry__ as E
from conftest import SF001
from sluice.plans import fixtures as fx
from sluice.plans.reports import jobs_report, tasks_report


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_job_limits_before_shuffle(spark):
    p = _plan(E.queries()["first_errors"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_paging_is_take_ordered(spark):
    jobs, tasks = fx.jobs_view(spark, SF001), fx.tasks_view(spark, SF001)
    now = "2005-01-01 00:00:00"
    assert "TakeOrderedAndProject" in _plan(jobs_report(jobs, tasks, now, page=2, page_size=20))
    assert "TakeOrderedAndProject" in _plan(tasks_report(jobs, tasks, now, states=["ERROR"], page=2,
                                                         page_size=20))


def test_rollup_is_partial_and_scans_are_pruned(spark):
    p = _plan(E.queries()["jobs_report"](spark, SF001))
    assert "partial_count" in p or "partial_sum" in p
    # the lineitem scan reads only the columns the ledger view needs
    assert "l_comment" not in p and "l_tax" not in p


def test_progress_windows_shuffle_once(spark):
    from sluice.operators.progress import with_rates
    p = _plan(with_rates(fx.samples_view(spark, SF001), skew_safe=False))
    assert p.count("Exchange hashpartitioning") == 1


def test_skip_lines_offsets_are_broadcast(spark, scratch):
    from pyspark.sql import functions as F
    from sluice.sources.delimited import TextOptions, read_delimited, write_delimited
    d = scratch("skip")
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("a"))
    write_delimited(df, d, TextOptions(ignore_lines=2), header_lines=2, files=2)
    p = _plan(read_delimited(spark, d, "a STRING", TextOptions(ignore_lines=2)))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
