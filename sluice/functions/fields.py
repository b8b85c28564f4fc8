"""JSON fields of the ledger (F6–F10): typed access to ``jobs.spec``,
``tasks.data`` and ``tasks.steps``.

``from_json`` is PERMISSIVE: malformed text gives a struct of NULLs and the
empty string gives NULL, which is the tolerant parse the ledger needs (F7);
callers read fields through ``coalesce``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TASK_DATA_SCHEMA = (
    "scheme STRING, key_name STRING, bucket STRING, conn_id BIGINT, "
    "row_count BIGINT, error STRING, time_left DOUBLE"
)

# ISO-8601 start / stop read straight into TIMESTAMP_NTZ.
TASK_STEPS_SCHEMA = "ARRAY<STRUCT<name: STRING, start: TIMESTAMP_NTZ, stop: TIMESTAMP_NTZ, duration: DOUBLE>>"

LOAD_SPEC_SCHEMA = (
    "STRUCT<source: STRUCT<paths: ARRAY<STRING>, hdfs_host: STRING, webhdfs_port: INT, hdfs_user: STRING>, "
    "connection: STRUCT<host: STRING, port: INT, user: STRING>, "
    "target: STRUCT<database: STRING, `table`: STRING>, "
    "options: STRUCT<file_id_column: STRING, duplicate_key_method: STRING, script: STRING, "
    "columns: ARRAY<STRING>>>"
)

_JSON_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def task_data(c="data") -> Column:
    return F.from_json(_col(c), TASK_DATA_SCHEMA)


def task_steps(c="steps") -> Column:
    return F.from_json(_col(c), TASK_STEPS_SCHEMA, _JSON_OPTS)


def job_spec(c="spec") -> Column:
    return F.from_json(_col(c), LOAD_SPEC_SCHEMA)


def seconds_between(start: Column, stop: Column) -> Column:
    """``stop - start`` in seconds with microseconds, as DOUBLE.

    ``timestampdiff`` on TIMESTAMP_NTZ does not depend on the session zone.
    """
    return F.timestamp_diff("MICROSECOND", start, stop) / F.lit(1e6)
