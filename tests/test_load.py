"""Loading: verdicts, duplicate-key modes, per-file reload, script path."""

from pyspark.sql import functions as F

from sluice.operators.load import load_files, read_target
from sluice.sources.delimited import TextOptions, replace_files, write_delimited
from sluice.spec import LoadSpec, SourceSpec, TargetSpec

SCHEMA = "a INT, b INT"


def _files(spark, scratch, batches):
    """batches: {file_key: [(a, b), ...]} → one file per key, rows in order."""
    rows = [(k, i, a, b) for k, rs in batches.items() for i, (a, b) in enumerate(rs)]
    df = spark.createDataFrame(rows, "k STRING, i INT, a INT, b INT")
    d = scratch("files")
    write_delimited(df, d, TextOptions(), columns=["a", "b"], file_key="k", files=len(batches), order_by=["i"],
                    stable_names=True)
    return d


def _spec(target, method, keys=("a",), fid=None, columns=()):
    schema = SCHEMA + (f", {fid} DECIMAL(20,0)" if fid else "")
    return LoadSpec(SourceSpec(paths=()), TargetSpec(path=target, schema=schema, key_columns=keys),
                    TextOptions(file_id_column=fid, columns=columns), duplicate_key_method=method)


def _paths(d, keys):
    return [f"{d}/key={k}" for k in keys]


def _table(spark, spec):
    return sorted((r.a, r.b) for r in read_target(spark, spec).collect())


def test_error_mode_rejects_conflicting_files(spark, scratch):
    d = _files(spark, scratch, {"x": [(1, 10), (2, 20)], "y": [(3, 30), (3, 31)], "z": [(4, 40), (5, 50)]})
    target = scratch("target")
    spec = _spec(target, "error")
    spark.createDataFrame([(5, 99)], SCHEMA).write.parquet(target)
    out = load_files(spark, spec, _paths(d, "xyz"))
    v = {r.name.split("key=")[1][0]: (r.status, r.error, r.row_count) for r in out.verdicts.collect()}
    assert v["x"] == ("success", None, 2)
    assert v["y"][0] == "error" and "Duplicate entry '3'" in v["y"][1]
    assert v["z"][0] == "error" and "Duplicate entry '5'" in v["z"][1]
    assert _table(spark, spec) == [(1, 10), (2, 20), (5, 99)]


def test_ignore_keeps_existing_and_first(spark, scratch):
    d = _files(spark, scratch, {"x": [(1, 10), (2, 20), (2, 21)], "y": [(2, 22), (3, 30)]})
    target = scratch("target")
    spark.createDataFrame([(3, 99)], SCHEMA).write.parquet(target)
    spec = _spec(target, "ignore")
    load_files(spark, spec, _paths(d, "xy"))
    assert _table(spark, spec) == [(1, 10), (2, 20), (3, 99)]


def test_replace_keeps_last(spark, scratch):
    d = _files(spark, scratch, {"x": [(1, 10), (2, 20), (2, 21)], "y": [(2, 22), (3, 30)]})
    target = scratch("target")
    spark.createDataFrame([(3, 99), (7, 70)], SCHEMA).write.parquet(target)
    spec = _spec(target, "replace")
    load_files(spark, spec, _paths(d, "xy"))
    assert _table(spark, spec) == [(1, 10), (2, 22), (3, 30), (7, 70)]


def test_bad_value_fails_file(spark, scratch):
    df = spark.createDataFrame([("x", 0, "1", "10"), ("y", 0, "2", "oops"), ("y", 1, "3", "30")],
                               "k STRING, i INT, a STRING, b STRING")
    d = scratch("files")
    write_delimited(df, d, TextOptions(), columns=["a", "b"], file_key="k", files=2, order_by=["i"])
    target = scratch("target")
    spec = _spec(target, "error")
    out = load_files(spark, spec, _paths(d, "xy"))
    v = {r.name.split("key=")[1][0]: (r.status, r.error) for r in out.verdicts.collect()}
    assert v["y"][0] == "error" and "oops" in v["y"][1]
    assert _table(spark, spec) == [(1, 10)]
    spec_i = _spec(scratch("target"), "ignore")
    load_files(spark, spec_i, _paths(d, "xy"))
    assert _table(spark, spec_i) == [(1, 10), (3, 30)]


def test_reload_replaces_rows_of_changed_file(spark, scratch):
    target = scratch("target")
    spec = _spec(target, "error", keys=(), fid="file_id", columns=("a", "b"))
    d1 = _files(spark, scratch, {"x": [(1, 10), (2, 20)], "y": [(3, 30)]})
    load_files(spark, spec, _paths(d1, "xy"))
    assert _table(spark, spec) == [(1, 10), (2, 20), (3, 30)]
    # same file names, new content: x changes, y is loaded again unchanged
    rows = spark.createDataFrame([("x", 0, 1, 11)], "k STRING, i INT, a INT, b INT")
    d2 = scratch("new")
    write_delimited(rows, d2, TextOptions(), columns=["a", "b"], file_key="k", files=1, order_by=["i"],
                    stable_names=True)
    replace_files(spark, d2, d1)
    load_files(spark, spec, _paths(d1, "xy"))
    assert _table(spark, spec) == [(1, 11), (3, 30)]
    ids = {r.file_id for r in read_target(spark, spec).select("file_id").collect()}
    assert len(ids) == 2


def test_script_transform(spark, scratch):
    df = spark.createDataFrame([("x", 0, "ab", 1), ("x", 1, "cd", 2)], "k STRING, i INT, s STRING, n INT")
    d = scratch("files")
    write_delimited(df, d, TextOptions(), columns=["s", "n"], file_key="k", files=1, order_by=["i"],
                    compression="gzip")
    target = scratch("target")
    spec = LoadSpec(SourceSpec(paths=()), TargetSpec(path=target, schema="s STRING, n INT"),
                    TextOptions(), script="tr a-z A-Z")
    load_files(spark, spec, [d + "/key=x"])
    assert sorted(tuple(r) for r in read_target(spark, spec).collect()) == [("AB", 1), ("CD", 2)]
    bad = LoadSpec(SourceSpec(paths=()), TargetSpec(path=scratch("t2"), schema="s STRING, n INT"),
                   TextOptions(), script="exit 3")
    out = load_files(spark, bad, [d + "/key=x"])
    (v,) = out.verdicts.collect()
    assert v.status == "error" and "code 3" in v.error


def test_hot_key_modes(spark, scratch):
    """A key holding a third of all rows: first / last wins, error names it."""
    n = 3000
    df = spark.range(0, n).select(
        (F.col("id") % 2).cast("string").alias("k"), F.col("id").cast("int").alias("i"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("a"),
        F.col("id").cast("int").alias("b"))
    d = scratch("hot")
    write_delimited(df, d, TextOptions(), columns=["a", "b"], file_key="k", files=2, order_by=["i"],
                    stable_names=True)
    paths = _paths(d, "01")
    ign = _spec(scratch("t"), "ignore")
    load_files(spark, ign, paths)
    t = dict(_table(spark, ign))
    assert len(t) == n - n // 3 + 1 and t[0] == 0        # first row of key 0: id 0 in key=0
    rep = _spec(scratch("t"), "replace")
    load_files(spark, rep, paths)
    t = dict(_table(spark, rep))
    assert t[0] == 2997                                    # last row of key 0 in key=1/ (files in name order)
    err = _spec(scratch("t"), "error")
    out = load_files(spark, err, paths)
    assert all(v.status == "error" and "Duplicate entry '0'" in v.error for v in out.verdicts.collect())
    assert _table(spark, err) == []


def test_bucketed_reload_and_replace(spark, scratch):
    """Bucketed file-id target: reloads and replaces give the per-file result
    with at most ``buckets`` partition directories."""
    import os
    from dataclasses import replace
    from sluice.session import local_path
    d1 = _files(spark, scratch, {f"f{i}": [(10 * i + j, i) for j in range(5)] for i in range(12)})
    paths = [f"{d1}/key=f{i}" for i in range(12)]
    spec = _spec(scratch("target"), "replace", keys=("a",), fid="file_id", columns=("a", "b"))
    spec = replace(spec, target=replace(spec.target, file_id_buckets=3))
    load_files(spark, spec, paths)
    assert len(_table(spark, spec)) == 60
    dirs = [x for x in os.listdir(local_path(spec.target.path)) if x.startswith("_file_bucket=")]
    assert 1 <= len(dirs) <= 3
    # f0 changes (a=0..4 → b=100), f1 is emptied, f2 re-sends key 0 (replace wins over f0's new row)
    new = spark.createDataFrame([("f0", j, j, 100) for j in range(5)] + [("f2", 0, 0, 200)],
                                "k STRING, i INT, a INT, b INT")
    d2 = scratch("v2")
    write_delimited(new, d2, TextOptions(), columns=["a", "b"], file_key="k", files=2, order_by=["i"],
                    stable_names=True)
    replace_files(spark, d2, d1)
    from sluice.sources.delimited import truncate_file
    truncate_file(spark, f"{d1}/key=f1/data.txt")
    load_files(spark, spec, [f"{d1}/key=f0", f"{d1}/key=f1", f"{d1}/key=f2"])
    t = dict(_table(spark, spec))
    assert t[0] == 200 and all(t[j] == 100 for j in range(1, 5))
    assert not any(10 <= a < 25 for a in t)              # f1 emptied; f2 now holds only key 0
    assert len(t) == 50                                   # f0: keys 1-4, f2: key 0, f3-f11: 45


def test_script_timeout_fails_the_file(spark, scratch):
    df = spark.createDataFrame([("x", 0, "ab", 1)], "k STRING, i INT, s STRING, n INT")
    d = scratch("files")
    write_delimited(df, d, TextOptions(), columns=["s", "n"], file_key="k", files=1, order_by=["i"])
    spec = LoadSpec(SourceSpec(paths=()), TargetSpec(path=scratch("t"), schema="s STRING, n INT"),
                    TextOptions(), script="cat >/dev/null; sleep 5", script_timeout_s=1)
    (v,) = load_files(spark, spec, [d + "/key=x"]).verdicts.collect()
    assert v.status == "error" and "did not exit within 1 s" in v.error
    assert read_target(spark, spec).count() == 0
