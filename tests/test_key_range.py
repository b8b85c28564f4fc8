"""Key searches of the target read only what the batch's keys can be in."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.load import key_range, load_files, read_target
from sluice.session import local_path
from sluice.sources.delimited import TextOptions
from sluice.spec import LoadSpec, SourceSpec, TargetSpec


def test_ranges_reach_the_scan(spark, scratch):
    target = scratch("t")
    spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s")).write.parquet(target)
    batch = spark.createDataFrame([(10, "b"), (20, "a"), (None, None)], "k BIGINT, s STRING")
    for key, filters in (("k", ("GreaterThanOrEqual(k,10)", "LessThanOrEqual(k,20)")),
                         ("s", ("GreaterThanOrEqual(s,a)", "LessThanOrEqual(s,b)"))):
        found = spark.read.parquet(target).select(key).where(key_range(batch, [key]))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert all(f in plan for f in filters), plan
    assert spark.read.parquet(target).where(key_range(batch, ["k"])).count() == 11
    assert spark.read.parquet(target).where(key_range(batch.where("k IS NULL"), ["k"])).count() == 0


@pytest.mark.parametrize("kind, texts", [
    ("DECIMAL(20,2)", ["-7.50", "0.00", "12345678901234567.25"]), ("DATE", ["1969-12-31", "2024-02-29", "9999-12-31"]),
    ("STRING", ["", "Ab", "zé\U0001F600"]), ("DOUBLE", ["-0.1", "1e300", "2.5"]),
    ("TIMESTAMP_NTZ", ["1969-12-31 23:59:59.5", "2024-01-01 00:00:00", "2030-01-01 00:00:00"])])
@pytest.mark.parametrize("method", ["ignore", "error", "replace"])
def test_no_key_is_missed(spark, scratch, kind, texts, method):
    """Every key of the batch is in the target, at the ends of the range too."""
    target = TargetSpec(path=scratch("t"), schema=f"k {kind}, v INT", key_columns=("k",))
    spec = LoadSpec(SourceSpec(paths=()), target, TextOptions(), duplicate_key_method=method)
    spark.createDataFrame([(t,) for t in texts], "t STRING").select(F.col("t").cast(kind).alias("k"), F.lit(1).alias("v")) \
        .write.parquet(target.path)
    root = local_path(scratch("in"))
    os.makedirs(root)
    with open(os.path.join(root, "a.tsv"), "w") as fh:
        fh.writelines(f"{t}\t2\n" for t in texts)
    load_files(spark, spec, [root])
    rows = read_target(spark, spec).collect()
    assert len(rows) == len({r.k for r in rows}) == 3
    assert {r.v for r in rows} == {2 if method == "replace" else 1}
