"""Load spec: preflight (S17), ledger JSON without credentials, S3 options."""

import json

import pytest

from sluice.session import configure_s3
from sluice.sources.delimited import TextOptions
from sluice.spec import LoadSpec, SourceSpec, TargetError, TargetSpec, check_target


def _spec(schema="a INT, b INT, fid DECIMAL(20,0)", **opts):
    return LoadSpec(SourceSpec(paths=("/d/*.tsv",)), TargetSpec(path="/t", schema=schema, table="t"),
                    TextOptions(**opts))


def test_preflight(spark):
    check_target(spark, _spec(columns=("a", "b"), file_id_column="fid"))
    with pytest.raises(TargetError):
        check_target(spark, _spec(columns=("a", "zz")))
    with pytest.raises(TargetError):  # file id must be unsigned 64-bit
        check_target(spark, _spec(schema="a INT, fid BIGINT", columns=("a",), file_id_column="fid"))
    with pytest.raises(TargetError):  # needs a column list
        check_target(spark, _spec(file_id_column="fid"))
    with pytest.raises(ValueError):   # the column list may not name the file id column
        TextOptions(columns=("a", "fid"), file_id_column="fid")
    with pytest.raises(ValueError):
        LoadSpec(SourceSpec(paths=("ftp://x/y",)), TargetSpec(path="/t", schema="a INT"))
    with pytest.raises(ValueError):
        LoadSpec(SourceSpec(paths=("/d/*",)), TargetSpec(path="/t", schema="a INT"), duplicate_key_method="merge")


def test_spec_json_has_target_and_no_credentials():
    j = json.loads(_spec(columns=("a", "b"), file_id_column="fid").to_json())
    assert j["target"] == {"database": "default", "table": "t"}
    assert j["options"]["file_id_column"] == "fid" and j["options"]["fields"]["terminated"] == "\t"
    text = json.dumps(j).lower()
    assert "password" not in text and "secret" not in text and "access_key" not in text


def test_configure_s3(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    configure_s3(spark)
    assert conf.get("fs.s3a.aws.credentials.provider").endswith("AnonymousAWSCredentialsProvider")
    configure_s3(spark, "AK", "SK")
    assert conf.get("fs.s3a.access.key") == "AK"
    assert conf.get("fs.s3a.aws.credentials.provider").endswith("SimpleAWSCredentialsProvider")
    conf.unset("fs.s3a.access.key")
    conf.unset("fs.s3a.secret.key")
    conf.unset("fs.s3a.aws.credentials.provider")


def test_preflight_reads_the_stored_table(spark, scratch):
    from dataclasses import replace
    path = scratch("t")
    spark.range(1).selectExpr("CAST(id AS INT) AS a", "'x' AS b").write.parquet(path)
    spec = LoadSpec(SourceSpec(paths=("/d/*",)), TargetSpec(path=path, schema="a INT, b STRING"))
    check_target(spark, spec)
    for schema, why in (("a BIGINT, b STRING", "stored as int"), ("a INT, c STRING", "'c' does not exist"),
                        ("a INT", "more columns: b")):
        with pytest.raises(TargetError, match=why):
            check_target(spark, replace(spec, target=replace(spec.target, schema=schema)))
    from sluice.operators.job import run_load_job
    from sluice.operators.ledger import read_ledger
    ledger = scratch("ledger")
    with pytest.raises(TargetError):
        run_load_job(spark, replace(spec, target=replace(spec.target, schema="a INT")), ledger)
    assert read_ledger(spark, ledger)[1].count() == 0
