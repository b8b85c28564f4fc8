"""F2 / F3 state machines on hand-picked rows covering the NULL cases
(SQL three-valued logic: a NULL condition is not true)."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sluice.functions.states import job_state, now_literal, task_state

NOW = datetime(2005, 1, 1)
S = timedelta(seconds=1)

# (finished, result, execution_id, last_contact) -> state
TASKS = [
    ((NOW, "success", None, None), "SUCCESS"),
    ((NOW, "cancelled", "0", NOW), "CANCELLED"),
    ((NOW, "error", "x", NOW - 10 * S), "ERROR"),
    ((NOW, None, None, None), None),
    ((None, None, None, None), "QUEUED"),
    ((None, None, "x", NOW - 10 * S), "RUNNING"),
    ((None, None, "x", NOW - 120 * S), "QUEUED"),
    ((None, None, "x", NOW - 119 * S), "RUNNING"),
    ((None, None, "x", NOW - 500 * S), "QUEUED"),
    ((None, None, "x", None), "RUNNING"),
]

# (total, finished, cancelled, queued) -> state
JOBS = [
    ((None, None, None, None), "FINISHED"),
    ((3, 3, 1, 0), "CANCELLED"),
    ((3, 3, 0, 0), "FINISHED"),
    ((3, 3, None, 0), "FINISHED"),
    ((3, 0, None, 3), "QUEUED"),
    ((3, 1, 0, 2), "RUNNING"),
    ((3, 0, None, None), "RUNNING"),
    ((3, 2, 1, 1), "RUNNING"),
    ((2, None, None, None), "RUNNING"),
]


def test_task_state(spark):
    df = spark.createDataFrame([r for r, _ in TASKS], "finished timestamp_ntz, result string, execution_id string, "
                                                       "last_contact timestamp_ntz")
    got = [r[0] for r in df.select(task_state(now_literal("2005-01-01 00:00:00"))).collect()]
    assert got == [e for _, e in TASKS]


def test_job_state(spark):
    df = spark.createDataFrame([r for r, _ in JOBS], "t bigint, f bigint, c bigint, q bigint")
    got = [r[0] for r in df.select(job_state(F.col("t"), F.col("f"), F.col("c"), F.col("q"))).collect()]
    assert got == [e for _, e in JOBS]
