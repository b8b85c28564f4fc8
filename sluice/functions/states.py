"""Task and job state machines (F2, F3) and the lease predicates.

All predicates take ``now`` as an explicit Column (never current_timestamp),
so reports are reproducible.  Timestamps are TIMESTAMP_NTZ (UTC wall time).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: lease time-to-live and the
# state names.
TASK_TTL_SECONDS = 120


class TaskState:
    QUEUED = "QUEUED"
    RUNNING = "RUNNING"
    SUCCESS = "SUCCESS"
    ERROR = "ERROR"
    CANCELLED = "CANCELLED"
    ALL = (QUEUED, RUNNING, SUCCESS, ERROR, CANCELLED)


class JobState:
    QUEUED = "QUEUED"
    RUNNING = "RUNNING"
    FINISHED = "FINISHED"
    CANCELLED = "CANCELLED"
    ALL = (QUEUED, RUNNING, FINISHED, CANCELLED)


def now_literal(now: str) -> Column:
    """``now`` as a TIMESTAMP_NTZ literal (time-zone independent)."""
    return F.lit(now).cast("timestamp_ntz")


def _lease_cutoff(now: Column, ttl: int = TASK_TTL_SECONDS) -> Column:
    return now - F.expr(f"INTERVAL {int(ttl)} SECONDS")


def is_finished() -> Column:
    return F.col("finished").isNotNull()


def is_queued(now: Column, ttl: int = TASK_TTL_SECONDS) -> Column:
    """Unfinished and (never leased, or heartbeat at least ``ttl`` old).

    Three-valued like SQL: a lease with a NULL heartbeat gives NULL.
    """
    return F.col("finished").isNull() & (
        F.col("execution_id").isNull() | (F.col("last_contact") <= _lease_cutoff(now, ttl))
    )


def has_live_lease(now: Column, execution_id: Column | None = None,
                   ttl: int = TASK_TTL_SECONDS) -> Column:
    """The lease is held (by ``execution_id`` if given) and fresh."""
    held = F.col("execution_id").isNotNull() if execution_id is None else (F.col("execution_id") == execution_id)
    return held & (F.col("last_contact") > _lease_cutoff(now, ttl))


#: The task columns that ``task_state`` reads.
STATE_COLUMNS = ("result", "execution_id", "finished", "last_contact")


def task_state(now: Column, ttl: int = TASK_TTL_SECONDS) -> Column:
    """finished → UPPER(result); queued → QUEUED; else RUNNING."""
    return (
        F.when(is_finished(), F.upper(F.col("result")))
        .when(is_queued(now, ttl), F.lit(TaskState.QUEUED))
        .otherwise(F.lit(TaskState.RUNNING))
    )


def job_state(total: Column, finished: Column, cancelled: Column, queued: Column) -> Column:
    """F3 on the raw (NULL-able) per-job rollup columns, in this order:
    all finished and some cancelled → CANCELLED; no tasks or all finished →
    FINISHED; all queued → QUEUED; else RUNNING."""
    return (
        F.when(((total - finished) == 0) & (cancelled > 0), F.lit(JobState.CANCELLED))
        .when(total.isNull() | (finished == total), F.lit(JobState.FINISHED))
        .when(queued == total, F.lit(JobState.QUEUED))
        .otherwise(F.lit(JobState.RUNNING))
    )
