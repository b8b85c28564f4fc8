"""What large inputs ask of single tasks and of shuffles, seen on small ones."""

import glob

from pyspark.sql import functions as F

from conftest import SF001
from sluice.functions.states import STATE_COLUMNS
from sluice.operators import ledger as lg
from sluice.plans import fixtures as fx
from sluice.plans import reports as rp
from sluice.plans import roundtrip as rt
from sluice.session import local_path
from sluice.sources import delimited

NOW = "2005-01-01 00:00:00"


def _tasks(spark):
    return fx.tasks_view(spark, SF001).withColumnRenamed("file_key", "file_id")


def test_versions_move_only_the_columns_asked_for(spark):
    """the struct that stands for the current version holds nothing that is not read."""
    tasks = _tasks(spark)
    versions = tasks.unionByName(lg.retry_errors(tasks, NOW))
    asked = ["update_count", *STATE_COLUMNS]
    few = lg.current_versions(versions, columns=asked)
    assert sorted(few.columns) == sorted(["id", *asked])
    assert "l_returnflag" in str(few._jdf.queryExecution().optimizedPlan())
    assert "get_json_object" not in str(few._jdf.queryExecution().optimizedPlan())
    assert "part/" not in str(few._jdf.queryExecution().optimizedPlan())
    whole = lg.current_versions(versions).select(*few.columns)
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.collect()))


def test_a_large_first_append_makes_more_buckets(spark, scratch, monkeypatch):
    """the task of a bucket gets no more rows when the ledger's first append has more."""
    monkeypatch.setattr(lg, "BUCKET_ROWS", 300, raising=False)
    tasks, small, large = _tasks(spark), scratch("small"), scratch("large")
    lg.append_versions(tasks.limit(100), small)
    lg.append_versions(tasks, large)
    assert lg._layout(spark, small)[0] == lg.BUCKETS
    assert lg._layout(spark, large)[0] == -(-tasks.count() // 300) > lg.BUCKETS
    lg.append_versions(lg.bulk_finish(tasks, NOW), large)
    now = lg.read_ledger(spark, large)[1]
    assert "Exchange" not in now._jdf.queryExecution().executedPlan().toString()
    assert now.count() == tasks.count()


def test_a_whole_report_moves_no_json(spark):
    """fields are parsed below the join, so that neither join nor sort carries the JSON."""
    tasks, jobs = fx.tasks_view(spark, SF001), fx.jobs_view(spark, SF001)
    plan = str(rp.tasks_report(jobs, tasks, NOW)._jdf.queryExecution().optimizedPlan())
    assert plan.index("Join Inner") < plan.index("get_json_object")
    page = rp.tasks_report(jobs, tasks, NOW, page_size=10)
    assert str(page._jdf.queryExecution().optimizedPlan()).index("Join Inner") > 0 and page.count() == 10


def test_more_documents_make_more_files(spark, scratch, monkeypatch):
    """no task writes or reads a fixed share of the documents."""
    seen = []
    monkeypatch.setattr(rt, "write_delimited", lambda df, path, *a, **kw: (
        seen.append(kw["files"]), delimited.write_delimited(df, path, *a, **kw)))
    d = scratch("tables")
    spark.range(100_001).select(F.col("id").alias("doc_id"), F.lit('a,"b').alias("text"), F.lit("en").alias("lang")) \
        .write.parquet(d + "/documents.parquet")
    assert rt.load_csv_enclosed(spark, d).where("text = 'a,\"b'").count() == 100_001
    assert seen == [6]


def test_a_file_is_sorted_by_many_tasks(spark, scratch):
    """The task that writes an ordered file sorts stretches of lines, not the lines."""
    rows = spark.range(50_000).select(((F.col("id") * 7919) % 50_000).alias("n"),
                                      F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("k"))
    d = scratch("ordered")
    delimited.write_delimited(rows, d, delimited.TextOptions(ignore_lines=2), columns=["n"], file_key="k", files=2,
                              header_lines=2, order_by=["n"])
    for key, first in (("1", 1), ("2", 2), ("__HIVE_DEFAULT_PARTITION__", 0)):
        (name,) = glob.glob(f"{local_path(d)}/key={key}/*.txt")
        lines = open(name).read().splitlines()
        want = sorted(r["n"] for r in rows.where(F.coalesce("k", F.lit("0")) == str(first)).collect())
        assert lines == ["header line 1", "header line 2", *map(str, want)]
    body = rows.select(F.col("n").cast("string").alias("value"), F.col("k").alias("key"), "n")
    assert delimited._stretches(body.repartitionByRange("key", "n").sortWithinPartitions("key", "n"), "\n").count() < 100
