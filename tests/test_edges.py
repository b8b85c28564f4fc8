"""Edge cases: odd file names, SQL TRANSFORM, dry run, stream restart."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.functions.fileid import file_id_py
from sluice.operators.job import run_load_job
from sluice.operators.load import load_files, read_target
from sluice.session import local_path
from sluice.sources.delimited import TextOptions
from sluice.sources.listing import list_files
from sluice.sources.script import transform_lines
from sluice.spec import LoadSpec, SourceSpec, TargetSpec


def test_names_with_blanks_and_percent(spark, scratch):
    root = local_path(scratch("odd"))
    os.makedirs(root)
    name = os.path.join(root, "sp ace%20x+y.tsv")
    with open(name, "w") as fh:
        fh.write("1\t2\n3\t4\n")
    m = list_files(spark, [root + "/*.tsv"]).collect()
    assert [r.name for r in m] == [name]
    spec = LoadSpec(SourceSpec(paths=()), TargetSpec(path=scratch("t"), schema="a INT, b INT, fid DECIMAL(20,0)"),
                    TextOptions(columns=("a", "b"), file_id_column="fid"))
    out = load_files(spark, spec, [root])
    (v,) = out.verdicts.collect()
    assert v.status == "success" and v.row_count == 2 and v.name == name
    ids = {r.fid for r in read_target(spark, spec).select("fid").collect()}
    assert ids == {file_id_py(name)}


def test_sql_transform_lines(spark):
    df = spark.createDataFrame([("abc",), ("xy",)], "value string")
    got = sorted(r.value for r in transform_lines(spark, df, "tr a-z A-Z").collect())
    assert got == ["ABC", "XY"]


def test_dry_run_lists_without_loading(spark, scratch):
    root = local_path(scratch("dry"))
    os.makedirs(root)
    for i in range(3):
        with open(os.path.join(root, f"f{i}.tsv"), "w") as fh:
            fh.write(f"{i}\t{i}\n")
    target = scratch("t")
    spec = LoadSpec(SourceSpec(paths=(root + "/*.tsv",)), TargetSpec(path=target, schema="a INT, b INT"))
    plan = run_load_job(spark, spec, scratch("ledger"), dry_run=True)
    assert plan.count() == 3
    assert not os.path.exists(local_path(target))


def test_sync_stream_restart_loads_each_file_once(spark, scratch):
    from sluice.streaming.sync import run_sync_stream
    landing = local_path(scratch("landing"))
    os.makedirs(landing)
    bare = LoadSpec(SourceSpec(paths=()), TargetSpec(path=scratch("t"), schema="a INT, b INT"))
    with pytest.raises(ValueError, match="file_id_column"):
        run_sync_stream(spark, bare, landing, scratch("ckpt"))
    spec = LoadSpec(SourceSpec(paths=()), TargetSpec(path=scratch("t"), schema="a INT, b INT, fid DECIMAL(20,0)"),
                    TextOptions(columns=("a", "b"), file_id_column="fid"))
    ckpt = scratch("ckpt")
    with open(os.path.join(landing, "one.tsv"), "w") as fh:
        fh.write("1\t10\n2\t20\n")
    run_sync_stream(spark, spec, landing, ckpt)
    run_sync_stream(spark, spec, landing, ckpt)  # restart, nothing new
    with open(os.path.join(landing, "two.tsv"), "w") as fh:
        fh.write("3\t30\n")
    run_sync_stream(spark, spec, landing, ckpt)
    got = sorted(tuple(r)[:2] for r in read_target(spark, spec).collect())
    assert got == [(1, 10), (2, 20), (3, 30)]


def test_enclosed_fields_with_raw_newlines(spark, scratch):
    """Multi-line quoted cells (whole-file mode with an encloser)."""
    root = local_path(scratch("csv"))
    os.makedirs(root)
    with open(os.path.join(root, "a.csv"), "w") as fh:
        fh.write('1,"two\nlines",x\n2,"say ""hi""\nand, bye",y\n3,plain,\\N\n4,"a\\"b",z')
    opts = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True)
    from sluice.sources.delimited import read_delimited
    got = sorted(tuple(r)[:3] for r in read_delimited(spark, root, "k INT, s STRING, t STRING", opts).collect())
    assert got == [(1, "two\nlines", "x"), (2, 'say "hi"\nand, bye', "y"), (3, "plain", None), (4, 'a"b', "z")]


def test_load_stats_without_download_step(spark):
    """A SUCCESS task whose steps hold no download step (or none at all)."""
    from sluice.plans.reports import job_load_stats
    rows = [("t1", "j", '{"row_count": 5}', "success", "[]", "2020-01-01 00:00:00"),
            ("t2", "j", '{"row_count": 7}', "success", None, "2020-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "id STRING, job_id STRING, data STRING, result STRING, steps STRING, f STRING")
    df = df.select("id", "job_id", "data", "result", "steps", F.col("f").cast("timestamp_ntz").alias("finished"),
                   F.lit(None).cast("string").alias("execution_id"), F.lit(None).cast("timestamp_ntz").alias("last_contact"))
    (r,) = job_load_stats(df, "2020-01-02 00:00:00").collect()
    assert (r.files_loaded, r.rows_loaded, r.avg_rows_per_file, r.avg_rows_per_second) == (2, 12, 6, None)
