"""Tasks whose worker stopped sending heartbeats.

Batch form: ``plans.reports.stale_tasks`` (P6/P7 over the current ledger).
Stream form: ``transformWithState`` over ``BUCKETS`` buckets of tasks (by the
task's hash).  A bucket's state is its live tasks with their latest heartbeats,
and one event-time timer ``ttl`` after the least of these.  A newer beat moves
its task; a beat that says ``finished`` drops the task; when the timer expires
the tasks that are due are emitted as lost and dropped.  So the state holds the
tasks that are alive (not every task ever seen) and the output is appended,
never rewritten.  Calls between Spark and Python are for each bucket with new
beats, not for each task, and a bucket's beats are aggregated as columns.

The number of buckets is part of a checkpoint's state: it cannot change between
runs (nor can checkpoints of one state for each task be continued).

Event time is the beats' own: the clock is the latest beat of any task, less
``delay``.  A beat that comes after its task was reported makes it live again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluice.functions.states import TASK_TTL_SECONDS
from sluice.session import scratch_dir

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOST_SCHEMA = "task_id STRING, last_ms BIGINT"
BUCKETS = 4096


class LostHeartbeats(StatefulProcessor):
    """Per bucket: rows ``(task_id, ms, finished)`` in, ``(task_id, last_ms)`` out for a task when ``ttl`` passes without
    one of it."""

    def __init__(self, ttl: int):
        self.ttl_ms = ttl * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", "tasks ARRAY<STRING>, ms ARRAY<BIGINT>")

    def _known(self) -> pd.Series:
        """Latest heartbeats by task."""
        tasks, ms = self.live.get() if self.live.exists() else ([], [])
        return pd.Series(list(ms), index=pd.Index(list(tasks), dtype=object), dtype="int64")

    def _keep(self, known: pd.Series, now: pd.Series) -> None:
        """The state and its timer become those of ``now``."""
        before, after = (int(x.min()) if len(x) else None for x in (known, now))
        if before != after and before is not None:
            self.handle.deleteTimer(before + self.ttl_ms)
        if before != after and after is not None:
            self.handle.registerTimer(after + self.ttl_ms)
        if len(now):
            self.live.update((now.index.tolist(), now.tolist()))
        elif len(known):
            self.live.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [beats.groupby("task_id", dropna=False, sort=False).agg(ms=("ms", "max"), finished=("finished", "max"))
                 for beats in rows if len(beats)]
        new = pd.concat(parts).groupby(level=0, dropna=False, sort=False).agg({"ms": "max", "finished": "max"})
        new.index = pd.Index([None if pd.isna(x) else x for x in new.index], dtype=object)
        known = self._known()
        done = new.index[new["finished"].astype(bool)]
        beaten = new["ms"][~new["finished"].astype(bool)].dropna().astype("int64")
        now = pd.concat([known[~known.index.isin(done)], beaten]).groupby(level=0, dropna=False, sort=False).max()
        now.index = pd.Index([None if pd.isna(x) else x for x in now.index], dtype=object)
        if not now.equals(known):
            self._keep(known, now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self._known()
        # a timer expires when the watermark has passed it
        due = known + self.ttl_ms < max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
        lost, now = known[due], known[~due]
        if len(lost):
            if len(now):
                self.live.update((now.index.tolist(), now.tolist()))
                self.handle.registerTimer(int(now.min()) + self.ttl_ms)
            else:
                self.live.clear()
            yield pd.DataFrame({"task_id": lost.index.to_numpy(dtype=object), "last_ms": lost.to_numpy()})

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """Timers need the RocksDB state store; the session's own setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def lost_heartbeats(beats: DataFrame, ttl: int = TASK_TTL_SECONDS, delay: str = "0 seconds") -> DataFrame:
    """Streaming ``(task_id, last_contact)`` of the tasks silent for ``ttl`` seconds; ``beats`` has ``task_id``,
    ``ts`` (TIMESTAMP_NTZ, UTC) and, where tasks say so, ``finished``."""
    finished = F.col("finished") if "finished" in beats.columns else F.lit(False)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    rows = (beats.select("task_id", F.timestamp_diff("MILLISECOND", epoch, F.col("ts")).alias("ms"),
                         F.coalesce(finished, F.lit(False)).alias("finished"))
            .withColumn("bucket", F.pmod(F.xxhash64("task_id"), F.lit(BUCKETS)).cast("int"))
            .withColumn("at", F.timestamp_millis("ms")).withWatermark("at", delay))
    lost = rows.groupBy("bucket").transformWithStateInPandas(LostHeartbeats(ttl), LOST_SCHEMA, "Append", "EventTime")
    return lost.select("task_id", F.timestamp_add("MILLISECOND", F.col("last_ms"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
                       .alias("last_contact"))


def run_heartbeat_stream(spark: SparkSession, source_dir: str, schema: str, sink_path: str,
                         checkpoint: str | None = None, ttl: int = TASK_TTL_SECONDS,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Read the heartbeat files of ``source_dir`` that are new since the last run and append the tasks lost by now
    to ``sink_path`` (one availableNow run); returns the sink's table."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    with _rocksdb(spark):
        q = (lost_heartbeats(reader.parquet(source_dir), ttl).writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", checkpoint or scratch_dir(spark, "heartbeat-stream"))
             .trigger(availableNow=True).start(sink_path))
        q.awaitTermination()
    return spark.read.schema("task_id STRING, last_contact TIMESTAMP_NTZ").parquet(sink_path)
