"""Session helpers: building a session for tests/bench and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed "now" of the ledger fixtures (FIXTURES.md §2).
FIXTURE_NOW = "2005-01-01 00:00:00"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sluice") -> SparkSession:
    """Session used by tests and bench.  AQE on, UI off, UTC session zone."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory the cluster names.

    The cluster setting (``spark.checkpoint.dir``) always wins; only when it is
    unset on a local master (tests) do we create one of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder all nodes share")
    own = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir() or own


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory on the shared file system, below the checkpoint dir.

    Used for written intermediate tables (lineage cuts, round-trip fixtures,
    stream checkpoints).  Never machine-local on a cluster.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sluice-scratch/{name}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can use the path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def configure_s3(spark: SparkSession, access_key: str | None = None, secret_key: str | None = None) -> None:
    """S3 credentials as Hadoop ``fs.s3a`` options, never in the spec.

    Both keys given → simple credentials; either missing → anonymous access
    (public buckets), as the reference does.  Environment defaults apply only
    when the caller passes them in."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if access_key and secret_key:
        conf.set("fs.s3a.aws.credentials.provider", "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider")
        conf.set("fs.s3a.access.key", access_key)
        conf.set("fs.s3a.secret.key", secret_key)
    else:
        conf.set("fs.s3a.aws.credentials.provider", "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider")


def delete_paths(spark: SparkSession, paths) -> None:
    """Remove directories this library staged (Hadoop FS, works on any
    shared file system).  Used once a job no longer needs its staged copy."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        if not p:
            continue
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)


_STAGING = threading.local()


def track_staged(path: str) -> None:
    """Record a staged directory for removal when the enclosing
    ``staging_scope`` ends (no-op outside one)."""
    paths = getattr(_STAGING, "paths", None)
    if paths is not None:
        paths.append(path)


@contextmanager
def staging_scope(spark: SparkSession):
    """Delete everything staged (``track_staged``) inside the block when it
    ends; nested scopes clean up their own paths."""
    outer = getattr(_STAGING, "paths", None)
    _STAGING.paths = []
    try:
        yield
    finally:
        paths, _STAGING.paths = _STAGING.paths, outer
        delete_paths(spark, paths)
