"""Failures of single files: script trouble, names with glob characters, NULL keys, a load that breaks."""

import os

import pytest

from sluice.operators import job, load
from sluice.operators.ledger import read_ledger
from sluice.operators.load import load_files, read_target
from sluice.session import ensure_checkpoint_dir, local_path
from sluice.sources.delimited import TextOptions
from sluice.sources.script import _run
from sluice.spec import LoadSpec, SourceSpec, TargetSpec


def _put(scratch, **files):
    folder = local_path(scratch("in"))
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    return folder


@pytest.mark.parametrize("method", ["error", "ignore"])
def test_failed_script_keeps_old_rows(spark, scratch, method):
    folder = _put(scratch, **{"a.tsv": "1\t2\n"})
    target = TargetSpec(path=scratch("t"), schema="a BIGINT, b BIGINT, fid DECIMAL(20,0)")
    options = TextOptions(columns=("a", "b"), file_id_column="fid")
    good = LoadSpec(SourceSpec(paths=(folder,)), target, options, duplicate_key_method=method)
    load_files(spark, good, [folder])
    for script, why in (("exit 3", "code 3"), ("exec 0<&-; exit 0", None)):
        spec = LoadSpec(SourceSpec(paths=(folder,)), target, options, script=script, duplicate_key_method=method)
        verdict = load_files(spark, spec, [folder]).verdicts.collect()[0]
        if why:
            assert verdict.status == "error" and why in verdict.error
            assert read_target(spark, good).count() == 1


def test_script_limits():
    assert _run("exit 0", b"x" * (1 << 22), 10)[1]  # input left unread
    assert _run("cat; head -c 300000 /dev/zero >&2", b"y" * 1000000, 20) == (b"y" * 1000000, None)
    assert "within 1 s" in _run("sleep 30", b"", 1)[1]
    assert "within 1 s" in _run("sleep 30 & exit 0", b"", 1)[1]


def test_names_are_not_patterns(spark, scratch):
    folder = _put(scratch, **{"in[1].tsv": "1\n", "in1.tsv": "2\n"})
    target = TargetSpec(path=scratch("t"), schema="a BIGINT")
    spec = LoadSpec(SourceSpec(paths=(folder,)), target, TextOptions())
    manifest = spark.read.format("binaryFile").load(folder).select("path")
    assert load_files(spark, spec, manifest).verdicts.where("status = 'success' and row_count = 1").count() == 2
    assert sorted(r.a for r in read_target(spark, spec).collect()) == [1, 2]


@pytest.mark.parametrize("method", ["ignore", "replace"])
def test_null_keys_differ(spark, scratch, method):
    folder = _put(scratch, **{"a.tsv": "\\N\t1\n\\N\t2\n5\t3\n5\t4\n"})
    target = TargetSpec(path=scratch("t"), schema="k BIGINT, v BIGINT", key_columns=("k",))
    spec = LoadSpec(SourceSpec(paths=(folder,)), target, TextOptions(), duplicate_key_method=method)
    load_files(spark, spec, [folder])
    rows = sorted(((r.k, r.v) for r in read_target(spark, spec).collect()), key=str)
    assert rows == sorted([(None, 1), (None, 2), (5, 3 if method == "ignore" else 4)], key=str)


def test_broken_load_leaves_no_queued_task(spark, scratch, monkeypatch):
    folder = _put(scratch, **{"a.tsv": "1\n"})
    spec = LoadSpec(SourceSpec(paths=(folder + "/*.tsv",)), TargetSpec(path=scratch("t"), schema="a BIGINT", table="t"),
                    TextOptions())

    def broken(*_):
        raise RuntimeError("disk gone")

    monkeypatch.setattr(job, "load_files", broken)
    ledger = scratch("ledger")
    with pytest.raises(RuntimeError):
        job.run_load_job(spark, spec, ledger)
    jobs, tasks = read_ledger(spark, ledger)
    assert jobs.count() == 1
    row = tasks.collect()[0]
    assert row.result == "error" and "disk gone" in row.data


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, _):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_failed_replace_keeps_the_table(spark, scratch, monkeypatch):
    first, second = _put(scratch, **{"a.tsv": "1\t1\n2\t2\n"}), _put(scratch, **{"b.tsv": "2\t5\n"})
    target = TargetSpec(path=scratch("t"), schema="k BIGINT, v BIGINT", key_columns=("k",))
    spec = LoadSpec(SourceSpec(paths=(first,)), target, TextOptions(), duplicate_key_method="replace")
    load_files(spark, spec, [first])

    def broken(*_):
        raise OSError("no rename")

    with monkeypatch.context() as m:
        m.setattr(load, "_change_places", broken)
        with pytest.raises(OSError):
            load_files(spark, spec, [second])
    assert sorted(tuple(r) for r in read_target(spark, spec).collect()) == [(1, 1), (2, 2)]
    load_files(spark, spec, [second])
    assert sorted(tuple(r) for r in read_target(spark, spec).collect()) == [(1, 1), (2, 5)]


def test_failed_reload_keeps_its_keys(spark, scratch):
    folder = _put(scratch, **{"a.tsv": "1\t1\n"})
    target = TargetSpec(path=scratch("t"), schema="k BIGINT, v BIGINT, fid DECIMAL(20,0)", key_columns=("k",))
    options = TextOptions(columns=("k", "v"), file_id_column="fid")
    spec = LoadSpec(SourceSpec(paths=(folder,)), target, options, duplicate_key_method="replace")
    load_files(spark, spec, [folder])
    for name, text in (("a.tsv", "x\t9\n"), ("b.tsv", "1\t2\n")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    load_files(spark, spec, [folder])
    assert [(r.k, r.v) for r in read_target(spark, spec).collect()] == [(1, 2)]


def test_stray_quotes_and_nested_files(spark, scratch):
    folder = _put(scratch, **{"a.csv": '1,5" pipe\n2,"two\nlines"\n3,"open\n4,last\n'})
    os.makedirs(os.path.join(folder, "sub"))
    with open(os.path.join(folder, "sub", "b.csv"), "w") as f:
        f.write("5,nested\n")
    options = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True)
    spec = LoadSpec(SourceSpec(paths=(folder,)), TargetSpec(path=scratch("t"), schema="a BIGINT, b STRING"), options)
    verdicts = load_files(spark, spec, [folder]).verdicts.collect()
    rows = sorted((r.a, r.b) for r in read_target(spark, spec).collect())
    assert rows == [(1, '5" pipe'), (2, "two\nlines"), (3, '"open'), (4, "last"), (5, "nested")]
    assert sorted(v.row_count for v in verdicts) == [1, 4]


def test_unread_remainder_fails_the_file(spark, scratch):
    folder = _put(scratch, **{"a.csv": "1,x\n2,y\\"})
    options = TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True)
    spec = LoadSpec(SourceSpec(paths=(folder,)), TargetSpec(path=scratch("t"), schema="a BIGINT, b STRING"), options,
                    duplicate_key_method="ignore")
    verdict = load_files(spark, spec, [folder]).verdicts.collect()[0]
    assert verdict.status == "error" and "no record ends" in verdict.error
    assert read_target(spark, spec).count() == 0


def _error_spec(target, fid=False):
    opts = TextOptions(columns=("k", "v"), file_id_column="fid") if fid else TextOptions()
    return LoadSpec(SourceSpec(paths=()), TargetSpec(path=target, schema="k INT, v INT" + ", fid DECIMAL(20,0)" * fid,
                                                     key_columns=("k",)), opts)


def _tsv(root, **files):
    os.makedirs(root, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(root, f"{name}.tsv"), "w") as fh:
            fh.write(text)
    return [os.path.join(root, f"{name}.tsv") for name in files]


def _verdicts(out):
    return {os.path.basename(r.name)[:-4]: r.error for r in out.verdicts.collect()}


def test_failing_file_takes_no_key_from_a_clean_one(spark, scratch):
    spec = _error_spec(scratch("t"))
    files = _tsv(local_path(scratch("in")), bad="1\t1\n2\toops\n", good="1\t5\n", later="1\t6\n7\t7\n", last="7\t8\n")
    got = _verdicts(load_files(spark, spec, files))
    assert "Incorrect" in got["bad"] and got["good"] is None and "'1'" in got["later"] and got["last"] is None
    assert sorted(map(tuple, read_target(spark, spec).collect())) == [(1, 5), (7, 8)]


def test_failed_reload_keeps_its_keys_in_error_mode(spark, scratch):
    spec, root = _error_spec(scratch("t"), fid=True), local_path(scratch("in"))
    load_files(spark, spec, _tsv(root, a="1\t1\n", b="2\t2\n", c="3\t3\n"))
    # a's reload fails, so b may not have its key; b's fails with it, so c may not have b's
    got = _verdicts(load_files(spark, spec, _tsv(root, a="1\toops\n", b="1\t20\n", c="2\t30\n", d="4\t4\n")))
    assert "Incorrect" in got["a"] and "'1'" in got["b"] and "'2'" in got["c"] and got["d"] is None
    assert sorted(tuple(r)[:2] for r in read_target(spark, spec).collect()) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_keys_may_change_files_in_one_reload(spark, scratch):
    spec, root = _error_spec(scratch("t"), fid=True), local_path(scratch("in"))
    load_files(spark, spec, _tsv(root, a="1\t1\n", b="2\t2\n"))
    assert set(_verdicts(load_files(spark, spec, _tsv(root, a="2\t20\n", b="1\t10\n"))).values()) == {None}
    assert sorted(tuple(r)[:2] for r in read_target(spark, spec).collect()) == [(1, 10), (2, 20)]


@pytest.mark.parametrize("buckets", [None, 2])
def test_broken_reload_is_completed_or_undone(spark, scratch, monkeypatch, buckets):
    """K5: a reload that breaks off after its plan is made is completed by the next load; before, nothing changes."""
    from sluice.operators import swap
    root, target = local_path(scratch("in")), scratch("t")
    spec = LoadSpec(SourceSpec(paths=()), TargetSpec(path=target, schema="k INT, v INT, fid DECIMAL(20,0)",
                                                     file_id_buckets=buckets),
                    TextOptions(columns=("k", "v"), file_id_column="fid"))
    table = lambda: sorted(tuple(r)[:2] for r in read_target(spark, spec).collect())
    load_files(spark, spec, _tsv(root, a="1\t1\n", b="2\t2\n"))
    files = _tsv(root, a="1\t10\n", b="")

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(swap, "_complete", broken)
        with pytest.raises(OSError, match="lost"):
            load_files(spark, spec, files)
    assert table() == [(1, 1), (2, 2)]          # not begun
    assert swap.recover(spark, target) == 1
    assert table() == [(1, 10)]
    with monkeypatch.context() as m:
        m.setattr(swap, "drop_partitions", broken)
        with pytest.raises(OSError, match="lost"):
            load_files(spark, spec, _tsv(root, a="", b="2\t20\n"))
    load_files(spark, spec, _tsv(root, c="3\t3\n"))     # completes it first
    assert table() == [(2, 20), (3, 3)]
    with monkeypatch.context() as m:
        m.setattr(swap, "_fs", broken)  # before the plan is made
        with pytest.raises(OSError, match="lost"):
            swap.swap_partitions(spark, target, read_target(spark, spec), "fid", lambda rows: rows.select("fid"))
    assert swap.recover(spark, target) == 0 and table() == [(2, 20), (3, 3)]


def test_spans_are_of_each_file(spark, scratch):
    """A file behind a slow script has a longer download step than one that is not."""
    import json
    root, ledger = local_path(scratch("in")), scratch("ledger")
    _tsv(root, fast="1\t1\n2\t2\n", slow="3\t3\n4\t4\n")
    slow = 'while read -r l; do echo "$l"; case "$l" in 3*) sleep 1.5;; esac; done'
    spec = LoadSpec(SourceSpec(paths=(root + "/*",)), TargetSpec(path=scratch("t"), schema="k INT, v INT"), script=slow)
    job.run_load_job(spark, spec, ledger)
    steps = {json.loads(r.data)["key_name"][-8:-4]: json.loads(r.steps)[0] for r in read_ledger(spark, ledger)[1].collect()}
    assert steps["slow"]["duration"] >= 0 and steps["fast"]["duration"] < 1.4
    assert steps["slow"]["stop"] > steps["fast"]["stop"]
