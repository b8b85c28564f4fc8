"""Column-level helpers.  Everything here returns a ``pyspark.sql.Column``
built from built-in functions, so it stays inside whole-stage codegen."""

from sluice.functions.fileid import file_id, file_id_string
from sluice.functions.states import (
    TASK_TTL_SECONDS, TaskState, JobState, now_literal, is_finished, is_queued,
    has_live_lease, task_state, job_state,
)
from sluice.functions.fields import (
    TASK_DATA_SCHEMA, TASK_STEPS_SCHEMA, LOAD_SPEC_SCHEMA, task_data, task_steps,
    job_spec, seconds_between,
)
from sluice.functions.text import (
    human_size, time_left_text, percent_done, progress_bar, tasks_fraction,
)

__all__ = [
    "file_id", "file_id_string", "TASK_TTL_SECONDS", "TaskState", "JobState",
    "now_literal", "is_finished", "is_queued", "has_live_lease", "task_state",
    "job_state", "TASK_DATA_SCHEMA", "TASK_STEPS_SCHEMA", "LOAD_SPEC_SCHEMA",
    "task_data", "task_steps", "job_spec", "seconds_between", "human_size",
    "time_left_text", "percent_done", "progress_bar", "tasks_fraction",
]
