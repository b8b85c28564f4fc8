"""ps (A8, O3): rows come in the order of the chosen column, the Total row last; the totals reuse the rows' shuffles."""

import json

import pytest

from conftest import SF001
from sluice.functions.states import TaskState, now_literal, task_state
from sluice.plans import catalog, reports as rp
from sluice.plans import fixtures as fx
from sluice.session import FIXTURE_NOW


@pytest.mark.parametrize("order", ["ASC", "DESC"])
def test_tasks_in_order_of_time_left(spark, order):
    tasks = catalog._timed(fx.tasks_view(spark, SF001))
    left = {r.id: json.loads(r.data).get("time_left") for r in tasks.where(
        task_state(now_literal(FIXTURE_NOW)) == TaskState.RUNNING).select("id", "data").collect()}
    rows = rp.ps_tasks(tasks, FIXTURE_NOW, order_by="time_left", order=order).collect()
    assert rows[-1].task_id == "Total" and {r.task_id for r in rows[:-1]} == set(left) and len(rows) > 20
    keys = [2.0 ** 63 if left[r.task_id] is None else left[r.task_id] for r in rows[:-1]]
    assert keys == sorted(keys, reverse=order == "DESC")
    assert len(set(keys)) > 10 and any(v is None for v in left.values())


@pytest.mark.parametrize("column, key", [("job_id", lambda r: r.job_id),
                                         ("tasks", lambda r: int(r.tasks.split("/")[0]))])
def test_jobs_in_order(spark, column, key):
    jobs, tasks = fx.jobs_view(spark, SF001), fx.tasks_view(spark, SF001)
    rows = rp.ps_jobs(jobs, tasks, FIXTURE_NOW, order_by=column, order="ASC").collect()
    assert rows[-1].job_id == "Total" and [key(r) for r in rows[:-1]] == sorted(key(r) for r in rows[:-1])


def test_no_total_of_one_or_none(spark):
    jobs, tasks = fx.jobs_view(spark, SF001), fx.tasks_view(spark, SF001)
    one = [r.job_id for r in rp.ps_jobs(jobs, tasks, FIXTURE_NOW).collect() if r.job_id != "Total"][0]
    got = rp.ps_jobs(jobs.where(jobs.id == one), tasks.where(tasks.job_id == one), FIXTURE_NOW).collect()
    assert [r.job_id for r in got] == [one]
    assert rp.ps_jobs(jobs.where("false"), tasks, FIXTURE_NOW).collect() == []


def test_totals_reuse_the_shuffles_of_the_rows(spark):
    df = rp.ps_jobs(fx.jobs_view(spark, SF001), fx.tasks_view(spark, SF001), FIXTURE_NOW)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("ReusedExchange") >= 1
