"""Listing by UNIX glob (the reference's own example) and splittable line numbers."""

import os

from pyspark.sql import functions as F

from sluice.session import local_path
from sluice.sources.delimited import TextOptions, read_delimited, write_delimited
from sluice.sources.listing import list_files


def _tree(root):
    for rel in ["1", "2", "a/1", "a/2"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            fh.write("x\n")


def test_star_and_double_star(spark, scratch):
    root = local_path(scratch("tree"))
    _tree(root)
    names = lambda pat: sorted(r.name[len(root) + 1:] for r in list_files(spark, [f"{root}/{pat}"]).collect())
    assert names("*") == ["1", "2"]
    assert names("**") == ["1", "2", "a/1", "a/2"]
    assert names("a/*") == ["a/1", "a/2"]
    both = list_files(spark, [f"{root}/*", f"{root}/**"])
    assert both.count() == 4
    assert list_files(spark, [f"{root}/*", f"{root}/**"], keep_duplicates=True).count() == 6
    assert list_files(spark, [f"{root}/nope/*"]).count() == 0


def test_skip_lines_across_splits(spark, scratch):
    """Many splits per file: line numbers must still count from file start."""
    df = spark.range(0, 20000).select(F.col("id").alias("k"), F.concat(F.lit("row-"), F.col("id").cast("string")).alias("s"))
    d = scratch("big")
    write_delimited(df, d, TextOptions(ignore_lines=5), header_lines=5, files=1, order_by=["k"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        back = read_delimited(spark, d, "k bigint, s string", TextOptions(ignore_lines=5))
        assert back.select("_file", "_block").distinct().count() > 5
        assert back.where(F.col("_error").isNotNull()).count() == 0
        assert back.count() == 20000
        assert back.agg(F.min("k"), F.max("k")).first() == (0, 19999)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
