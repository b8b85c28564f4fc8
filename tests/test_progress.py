"""Skew-safe progress windows equal the plain per-task windows, also when one
task holds a third of all samples and spans many range partitions."""

from pyspark.sql import functions as F

from conftest import SF01
from sluice.operators.progress import with_rates, with_stall
from sluice.plans.fixtures import samples_view


def _hot_samples(spark):
    # task 0 holds a third of the rows; bytes grow with stalls (delta 0) mixed in
    n = 30000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("task_id"),
        F.col("id").alias("seq"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 7).cast("decimal(18,6)"))).alias("ts"),
        F.when(F.col("id") % 11 < 3, F.lit(0)).otherwise(F.col("id") % 50).alias("inc"))
    from pyspark.sql import Window
    w = Window.partitionBy("task_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("task_id", "seq", "ts", F.sum("inc").over(w).alias("bytes_downloaded"),
                     F.sum("inc").over(Window.partitionBy("task_id")).alias("bytes_total"))


def _same(a, b):
    cols = sorted(a.columns)
    ra = sorted(tuple(r) for r in a.select(*cols).collect())
    rb = sorted(tuple(r) for r in b.select(*cols).collect())
    assert len(ra) == len(rb)
    assert ra == rb


def test_rates_skew_safe_equals_plain(spark):
    s = _hot_samples(spark).cache()
    for parts, rows in ((4, 1 << 16), (16, 1000), (64, 1), (200, 250)):
        _same(with_rates(s, partitions=parts, block_rows=rows), with_rates(s, skew_safe=False))
    _same(with_rates(samples_view(spark, SF01), partitions=8), with_rates(samples_view(spark, SF01), skew_safe=False))


def test_stall_skew_safe_equals_plain(spark):
    s = _hot_samples(spark).cache()
    for parts, rows in ((4, 1 << 16), (16, 1000), (64, 1), (200, 250)):
        _same(with_stall(s, partitions=parts, block_rows=rows), with_stall(s, skew_safe=False))
    _same(with_stall(samples_view(spark, SF01), partitions=8), with_stall(samples_view(spark, SF01), skew_safe=False))


def test_hot_task_is_split(spark):
    s = _hot_samples(spark)
    r = with_rates(s, partitions=16)
    assert r.count() == s.count()
    from sluice.operators.progress import _blocks
    blocks = _blocks(s, "task_id", "seq", 16, 1000).where("task_id = 0").groupBy("_block").count().collect()
    assert sorted(b["count"] for b in blocks) == [1000] * 10


def test_tiny_input_many_partitions(spark):
    """200 partitions over 1,000 samples: empty and tiny ranges, still exact."""
    from conftest import SF001
    s = samples_view(spark, SF001)
    _same(with_rates(s, partitions=200), with_rates(s, skew_safe=False))
    _same(with_stall(s, partitions=200), with_stall(s, skew_safe=False))
