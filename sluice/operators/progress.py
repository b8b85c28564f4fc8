"""Progress analytics over a table (or stream) of download samples.

A sample is ``(task_id, seq, ts, bytes_downloaded[, bytes_total])`` with
cumulative bytes, taken about once a second.  The reference keeps the last 30
deltas per download in memory; here they are window functions per task.

The 30-sample moving average uses the telescoping identity
``sum(last 30 deltas) = bytes[i] - bytes[i-30]``, so it is two ``lag`` calls
over one sort instead of a 30-row sliding frame.

Skew: a plain ``Window.partitionBy(task)`` puts all samples of a task into one
task.  The default (``skew_safe=True``) cuts every task's samples into blocks
of ``block_rows`` by their place within the task, and works per block:

* places come from a range partitioning on ``(task, seq)`` (a hot task is cut
  across many partitions): the row's place within its partition plus the
  sizes of the task's earlier partitions, one row per (task, partition);
* the last ``window`` rows of each block are copied into the task's next
  block, so ``lag`` over a block sees exactly the rows it needs; every block
  but a task's last is full, so this is exact for any input;
* values that reach back to the task's start (first sample time, last
  "moving" time) come from a small table of one row per block, prefix-scanned
  over the blocks of a task.

The ranged samples are written once to the shared checkpoint folder, so their
partitions are the same in every branch that reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: averaging window (samples),
# stall threshold (bytes per sample) and stall timeout (seconds).
RATE_WINDOW = 30
STALL_MIN_BYTES = 10
STALL_TIMEOUT_SECONDS = 30

#: Samples of one task that one window group holds.
BLOCK_ROWS = 1 << 16


def _blocks(samples: DataFrame, task_col: str, order_col: str, partitions: int | None, rows: int) -> DataFrame:
    """The samples with ``_at``, their place within the task from 0, and ``_block``, ``rows`` places each."""
    from sluice.session import scratch_dir, track_staged
    spark = samples.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "progress-ranged")
    samples.repartitionByRange(n, task_col, order_col).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    track_staged(path)
    staged = spark.read.parquet(path)
    sizes = staged.groupBy(F.col(task_col).alias("_t"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_t").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_t", "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(task_col, "_range").orderBy(order_col)
    placed = staged.withColumn("_in", F.row_number().over(within) - 1).join(
        starts, F.col(task_col).eqNullSafe(F.col("_t")) & (F.col("_range") == F.col("_r")))
    at = F.col("_start") + F.col("_in")
    return placed.select(*samples.columns, at.alias("_at"), F.floor(at / rows).alias("_block"))


def _with_carry(blocks: DataFrame, rows: int, carry: int) -> DataFrame:
    """``blocks`` plus the last ``carry`` rows of each full block once more in
    the task's next block, flagged ``_carry``."""
    copies = F.when(F.col("_at") % rows >= rows - carry, F.array(F.lit(False), F.lit(True))) \
        .otherwise(F.array(F.lit(False)))
    return (blocks.withColumn("_carry", F.explode(copies))
            .withColumn("_block", F.col("_block") + F.col("_carry").cast("bigint")))


def _rate_columns(df: DataFrame, w, window: int) -> DataFrame:
    b = F.col("bytes_downloaded")
    n = F.least(F.row_number().over(w), F.lit(window))
    out = df.withColumns({
        "delta": b - F.lag(b, 1, 0).over(w),
        "rate": ((b - F.lag(b, window, 0).over(w)) / n).cast("double"),
    })
    if "bytes_total" in df.columns:
        done = F.col("bytes_downloaded") == F.col("bytes_total")
        out = out.withColumn("rate", F.when(done, F.lit(0.0)).otherwise(F.col("rate")))
        left = (F.col("bytes_total") - F.col("bytes_downloaded")) / F.col("rate")
        out = out.withColumn("time_left", F.when(F.col("rate") == 0, F.lit(-1.0)).otherwise(left))
    return out


def with_rates(samples: DataFrame, window: int = RATE_WINDOW, task_col: str = "task_id",
               order_col: str = "seq", skew_safe: bool = True, partitions: int | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """W1 delta, W2 moving-average rate, W3 time left.

    rate = mean of the last ``window`` deltas (first delta against 0);
    0 once ``bytes_downloaded == bytes_total``; time_left = remaining / rate,
    −1 when the rate is 0.
    """
    if not skew_safe:
        return _rate_columns(samples, Window.partitionBy(task_col).orderBy(order_col), window)
    cols = samples.columns
    rows = max(block_rows, window)
    u = _with_carry(_blocks(samples, task_col, order_col, partitions, rows), rows, window)
    out = _rate_columns(u, Window.partitionBy(task_col, "_block").orderBy("_at"), window)
    return out.where(~F.col("_carry")).select(*cols, "delta", "rate", *(["time_left"] if "bytes_total" in cols else []))


def with_stall(samples: DataFrame, min_bytes: int = STALL_MIN_BYTES,
               timeout_s: int = STALL_TIMEOUT_SECONDS, task_col: str = "task_id",
               order_col: str = "seq", skew_safe: bool = True, partitions: int | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``last_change`` = time of the last sample whose delta exceeded
    ``min_bytes`` (the task's first sample time before any); stalled when the
    sample is more than ``timeout_s`` later than that."""
    b = F.col("bytes_downloaded")
    moved = F.when(F.col("delta") > min_bytes, F.col("ts"))
    limit = F.col("last_change") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(timeout_s))
    if not skew_safe:
        w = Window.partitionBy(task_col).orderBy(order_col)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = samples.withColumn("delta", b - F.lag(b, 1, 0).over(w))
        d = d.withColumn("last_change", F.coalesce(F.last(moved, ignorenulls=True).over(upto),
                                                   F.first("ts").over(upto)))
        return d.withColumn("stalled", F.col("ts") > limit)
    cols = samples.columns
    u = _with_carry(_blocks(samples, task_col, order_col, partitions, block_rows), block_rows, 1)
    w = Window.partitionBy(task_col, "_block").orderBy("_at")
    d = u.withColumn("delta", b - F.lag(b, 1, 0).over(w)).where(~F.col("_carry")).drop("_carry")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({"_moved": F.last(moved, ignorenulls=True).over(upto), "_first": F.first("ts").over(upto)})
    # one row per block: what earlier blocks contribute
    groups = d.groupBy(F.col(task_col).alias("_t"), F.col("_block").alias("_b")).agg(
        F.max_by(moved, F.when(moved.isNotNull(), F.col("_at"))).alias("_g_moved"),
        F.min_by(F.col("ts"), F.col("_at")).alias("_g_first"))
    before = Window.partitionBy("_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    task_start = Window.partitionBy("_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = groups.select("_t", "_b",
                           F.last("_g_moved", ignorenulls=True).over(before).alias("_in_moved"),
                           F.first("_g_first").over(task_start).alias("_task_first"))
    d = d.join(groups, F.col(task_col).eqNullSafe(F.col("_t")) & (F.col("_block") == F.col("_b")))
    d = d.withColumn("last_change", F.coalesce("_moved", "_in_moved", "_task_first"))
    return d.withColumn("stalled", F.col("ts") > limit).select(*cols, "delta", "last_change", "stalled")


def latest_sample(samples: DataFrame, task_col: str = "task_id", order_col: str = "seq") -> DataFrame:
    """Most recent sample per task (max_by keeps the aggregate partial)."""
    cols = [c for c in samples.columns if c != task_col]
    return (samples.groupBy(task_col)
            .agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("_s"))
            .select(task_col, "_s.*"))
