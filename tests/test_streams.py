"""Files read by tasks: hidden and empty names, broken gzip files, large scripts, content fingerprints, retries."""

import gzip
import os
import tracemalloc

import pytest

from sluice.operators.job import retry_job, run_load_job
from sluice.operators.ledger import append_versions, read_ledger, retry_errors
from sluice.operators.load import load_files, read_target
from sluice.session import local_path
from sluice.sources import streams
from sluice.sources.delimited import TextOptions, read_delimited
from sluice.sources.listing import list_files
from sluice.sources.script import script_output
from sluice.spec import LoadSpec, SourceSpec, TargetSpec


def _tree(scratch, **files):
    root = local_path(scratch("tree"))
    for name, data in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(data)
    return root


def _job(root, scratch, **kw):
    return LoadSpec(SourceSpec(paths=(root + "/**",), **kw), TargetSpec(path=scratch("t"), schema="a INT, b STRING"), TextOptions())


def test_large_trees_are_listed_in_rounds(spark, scratch, monkeypatch):
    monkeypatch.setattr(streams, "DIRECTORIES_A_TASK", 2)
    names = {f"d{i}/e{j}/{n}": b"x" * (i + j) for i in range(3) for j in range(3) for n in ("f", "_g", ".h")}
    root = _tree(scratch, **names)
    got = {r.name[len(root) + 1:]: r.size for r in list_files(spark, root + "/**").collect()}
    assert got == {k: len(v) for k, v in names.items()}
    assert {r.name[len(root) + 1:] for r in list_files(spark, root + "/d1/*/_?").collect()} == {
        k for k in names if k.startswith("d1") and k.endswith("_g")}


def test_hidden_empty_and_packed_files_load(spark, scratch):
    root = _tree(scratch, **{"_x.tsv": b"1\ta\n", ".y.tsv": b"2\tb", "empty.tsv": b"", "z.tsv.gz": gzip.compress(b"3\tc\n4\td\n"),
                             "two.gz": gzip.compress(b"5\te\n") + gzip.compress(b"6\tf\n"), "gz": b"7\tg\n"})
    spec = _job(root, scratch)
    out = run_load_job(spark, spec, scratch("ledger"))
    assert out.submitted == 6 and out.verdicts.where("status <> 'success'").count() == 0
    assert sorted(map(tuple, read_target(spark, spec).collect())) == [(i + 1, c) for i, c in enumerate("abcdefg")]


@pytest.mark.parametrize("method", ["error", "ignore", "replace"])
def test_broken_gzip_fails_alone(spark, scratch, method):
    good = gzip.compress(b"".join(b"%d\tx\n" % i for i in range(20000)))
    flipped = bytearray(good)
    flipped[-6] ^= 1  # the checksum
    root = _tree(scratch, **{"a.gz": good[:len(good) // 2], "b.gz": bytes(flipped), "c.gz": b"plain", "d.gz": good, "e.tsv": b"-1\ty\n"})
    spec = LoadSpec(SourceSpec(paths=(root,)), TargetSpec(path=scratch("t"), schema="a INT, b STRING", key_columns=("a",)),
                    TextOptions(), duplicate_key_method=method)
    for files in ([root], list_files(spark, root + "/*")):
        got = {os.path.basename(r.name): r.error for r in load_files(spark, spec, files).verdicts.collect()}
        assert all("corrupt gzip" in got[f"{k}.gz"] for k in "abc")
        if method != "error":  # there the second load finds its keys taken
            assert got["d.gz"] is None
        assert read_target(spark, spec).count() == 20001


def test_skip_lines_counts_in_packed_files(spark, scratch):
    root = _tree(scratch, **{"a.gz": gzip.compress(b"head\nhead\n1\ta\n2\tb\n"), "b.tsv": b"head\nhead\n3\tc\n"})
    got = read_delimited(spark, root, "a INT, b STRING", TextOptions(ignore_lines=2)).select("a", "b").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (2, "b"), (3, "c")]


def test_script_memory_does_not_follow_the_file():
    tracemalloc.start()
    size = sum(map(len, script_output("cat", (b"%07d\n" % i * 131072 for i in range(192)), 20)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size == 192 << 20 and peak < 24 << 20


def test_content_fingerprint(spark, scratch):
    root = _tree(scratch, a=b"1\ta\n", b=b"2\tb\n")
    spec, ledger = _job(root, scratch, fingerprint="md5"), scratch("ledger")
    assert run_load_job(spark, spec, ledger).submitted == 2
    os.utime(os.path.join(root, "a"), (1, 1))
    assert run_load_job(spark, spec, ledger).submitted == 0
    with open(os.path.join(root, "b"), "w") as fh:
        fh.write("3\tc\n")
    assert run_load_job(spark, spec, ledger).submitted == 1
    with pytest.raises(ValueError, match="fingerprint"):
        list_files(spark, root, "sha9")


def test_retry_loads_the_file(spark, scratch):
    root = _tree(scratch, a=b"1\ta\n", b=b"oops\tb\n", c=b"oops\tc\n")
    spec, ledger = _job(root, scratch), scratch("ledger")
    run_load_job(spark, spec, ledger)
    with open(os.path.join(root, "b"), "w") as fh:
        fh.write("2\tb\n")
    os.remove(os.path.join(root, "c"))
    # queued anew by hand, not loaded yet
    append_versions(retry_errors(read_ledger(spark, ledger)[1], "2030-01-01 00:00:00"), ledger)
    assert retry_job(spark, spec, ledger).submitted == 2
    assert sorted(map(tuple, read_target(spark, spec).collect())) == [(1, "a"), (2, "b")]
    tasks = {r.file_id: (r.result, r.data) for r in read_ledger(spark, ledger)[1].collect()}
    assert sorted(r for r, _ in tasks.values()) == ["error", "success", "success"]
    assert any("not there any more" in d for _, d in tasks.values())
    assert retry_job(spark, spec, ledger, job_prefix="nope").submitted == 0


@pytest.mark.parametrize("options", [TextOptions(), TextOptions(fields_enclosed='"'), TextOptions(escaped_terminators=True),
                                     TextOptions(fields_escaped="")])
def test_marks_in_texts_survive(spark, scratch, options):
    marks = "".join(map(chr, range(0xFDD0, 0xFDE0)))
    texts = [marks, marks[::-1], "﷗﷘", "a﷒b"]
    escaped = "x\\tb﷒c\\\\﷐\\﷓" if options.fields_escaped else "x"
    lines = [f"{i}\t{t}" for i, t in enumerate([*texts, escaped])]
    root = _tree(scratch, a="\n".join(lines).encode())
    got = {r.a: r.b for r in read_delimited(spark, root, "a INT, b STRING", options).collect()}
    want = dict(enumerate(texts)) | {4: "x\tb﷒c\\﷐﷓" if options.fields_escaped else "x"}
    assert got == want


def test_heartbeats_over_runs(spark, scratch):
    """A task is reported once its silence passes the time to live, across restarts; finished ones never are."""
    from sluice.streaming.heartbeat import run_heartbeat_stream
    schema = "task_id STRING, ts TIMESTAMP_NTZ, finished BOOLEAN"
    src, sink, ckpt = scratch("beats"), scratch("lost"), scratch("ckpt")

    def beat(n, *rows):
        spark.createDataFrame(rows, "task_id STRING, s INT, finished BOOLEAN").selectExpr(
            "task_id", "timestampadd(SECOND, s, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts", "finished").write.parquet(f"{src}/{n}")
        got = run_heartbeat_stream(spark, src + "/*", schema, sink, ckpt)
        return sorted((r.task_id, (r.last_contact.minute * 60 + r.last_contact.second)) for r in got.collect())

    assert beat(1, ("a", 0, False), ("b", 0, False), ("c", 5, False)) == []
    assert beat(2, ("a", 100, False), ("c", 101, True)) == []
    assert beat(3, ("d", 130, False)) == [("b", 0)]
    assert beat(4, ("d", 400, False)) == [("a", 100), ("b", 0)]
    assert beat(5, ("a", 500, False)) == [("a", 100), ("b", 0)]
    assert beat(6, ("d", 900, False)) == [("a", 100), ("a", 500), ("b", 0)]  # d is back in time


def test_heartbeat_states_are_of_buckets(spark, scratch, monkeypatch):
    """Many tasks share a state and its timer; each is reported as by itself."""
    import random

    from sluice.streaming import heartbeat
    monkeypatch.setattr(heartbeat, "BUCKETS", 3)
    rng = random.Random(4)
    schema = "task_id STRING, ts TIMESTAMP_NTZ, finished BOOLEAN"
    src, sink, ckpt = scratch("beats"), scratch("lost"), scratch("ckpt")
    live, want, clock = {}, set(), 0
    for n in range(2):
        beats = [(rng.choice([None, *map(str, range(60))]), clock + rng.randint(1, 200), rng.random() < 0.1) for _ in range(80)]
        beats.append(("clock", clock + 201, False))
        done = {t for t, _, finished in beats if finished}
        for t, s, _ in beats:
            live[t] = max(s, live.get(t, 0))
        live, clock = {t: s for t, s in live.items() if t not in done}, clock + 201
        due = {(t, s) for t, s in live.items() if s + 120 < clock}
        want, live = want | due, {t: s for t, s in live.items() if (t, s) not in due}
        spark.createDataFrame(beats, "task_id STRING, s INT, finished BOOLEAN").selectExpr(
            "task_id", "timestampadd(SECOND, s, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts", "finished").write.parquet(f"{src}/{n}")
        got = heartbeat.run_heartbeat_stream(spark, src + "/*", schema, sink, ckpt).collect()
        assert sorted(map(str, want)) == sorted(str((r.task_id, r.last_contact.minute * 60 + r.last_contact.second)) for r in got)
    assert want and live
    with heartbeat._rocksdb(spark):
        states = spark.read.format("statestore").option("stateVarName", "live").load(local_path(ckpt))
        assert 1 <= states.count() <= 3
