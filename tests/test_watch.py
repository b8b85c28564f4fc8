"""The watch stream: files that change, come in or stay, and a run that broke off."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.job import utc_now
from sluice.operators.ledger import append_versions, enqueue, job_row, read_ledger
from sluice.operators.load import read_target
from sluice.session import local_path
from sluice.sources.delimited import TextOptions
from sluice.sources.listing import list_files
from sluice.spec import LoadSpec, SourceSpec, TargetSpec
from sluice.streaming.watch import run_watch, watch_prefix


def test_changed_files_are_read_again(spark, scratch):
    root = local_path(scratch("watched"))
    os.makedirs(root)
    spec = LoadSpec(SourceSpec(paths=(root + "/**",)),
                    TargetSpec(path=scratch("t"), schema="a INT, b STRING, fid DECIMAL(20,0)"),
                    TextOptions(columns=("a", "b"), file_id_column="fid"))
    ledger, ckpt = scratch("ledger"), scratch("ckpt")

    def put(name, text):
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)

    def run():
        run_watch(spark, spec, ledger, ckpt)
        return sorted((r.a, r.b) for r in read_target(spark, spec).collect())

    put("a", "1\told\n2\told\n")
    put("b", "3\tkept\n")
    # an earlier run had queued a file, and its driver was lost
    files = list_files(spark, list(spec.source.paths), spec.source.fingerprint)
    dead = watch_prefix(ckpt) + "0" * 20
    append_versions(job_row(spark, dead, utc_now(), spec.to_json()), ledger, table="jobs")
    append_versions(enqueue(files.where(F.col("name").endswith("/a")), dead, utc_now()), ledger)
    assert run() == [(1, "old"), (2, "old"), (3, "kept")]
    put("a", "1\tchanged\n")
    put("c", "4\tcame\n")
    assert run() == [(1, "changed"), (3, "kept"), (4, "came")]
    before = read_ledger(spark, ledger)[1].count()
    assert run() == [(1, "changed"), (3, "kept"), (4, "came")]
    assert read_ledger(spark, ledger)[1].count() == before
    states = {(r.job_id == dead, r.result) for r in read_ledger(spark, ledger)[1].collect()}
    assert states == {(True, "cancelled"), (False, "success")}


def test_a_watch_needs_file_ids(spark, scratch):
    bare = LoadSpec(SourceSpec(paths=()), TargetSpec(path=scratch("t"), schema="a INT"))
    with pytest.raises(ValueError, match="file_id_column"):
        run_watch(spark, bare, scratch("ledger"), scratch("ckpt"))
