"""Load specification: a frozen dataclass instead of a CLI / spec file.

Defaults equal the reference's spec defaults.  Credentials never enter the
spec (they stay in Spark / Hadoop configuration, e.g. ``fs.s3a.*``), so the
JSON stored in the ledger carries none.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import DecimalType, StructType, _parse_datatype_string

from sluice.sources.delimited import TextOptions
from sluice.sources.paths import resolve_path

DUPLICATE_KEY_METHODS = ("error", "ignore", "replace")
FILE_ID_TYPE = DecimalType(20, 0)
#: Partition column of a target that is bucketed by file id.
BUCKET_COL = "_file_bucket"


@dataclass(frozen=True)
class SourceSpec:
    paths: tuple[str, ...]
    fingerprint: str = "size_mtime"  # size_mtime | etag | md5 | none
    keep_duplicates: bool = False
    # (The HDFS user is the cluster's: HADOOP_USER_NAME / Kerberos at JVM
    # start; the namenode comes from the hdfs://host:port URI.)


@dataclass(frozen=True)
class TargetSpec:
    path: str
    schema: str
    key_columns: tuple[str, ...] = ()
    database: str = "default"
    table: str | None = None  # logical name recorded in the ledger (P4); the data lives at ``path``
    # With a file-id column: partition by ``pmod(file_id, buckets)`` instead
    # of one partition per file (millions of source files would otherwise be
    # millions of tiny partitions); a load rewrites only the touched buckets.
    file_id_buckets: int | None = None

    @property
    def struct(self) -> StructType:
        return _parse_datatype_string(self.schema)

    @property
    def name(self) -> str:
        return self.table or self.path


@dataclass(frozen=True)
class LoadSpec:
    source: SourceSpec
    target: TargetSpec
    options: TextOptions = field(default_factory=TextOptions)
    duplicate_key_method: str = "error"
    script: str | None = None
    script_timeout_s: int = 30

    def __post_init__(self):
        if self.duplicate_key_method not in DUPLICATE_KEY_METHODS:
            raise ValueError(f"duplicate_key_method must be one of {DUPLICATE_KEY_METHODS}")
        for p in self.source.paths:
            resolve_path(p)  # S1 checks

    def to_json(self) -> str:
        """Spec as stored on the job row (P4 reads connection / target)."""
        o = asdict(self.options)
        o["columns"] = list(self.options.columns)
        return json.dumps({
            "source": {"paths": list(self.source.paths)},
            "connection": {"host": "spark", "port": 0},
            "target": {"database": self.target.database, "table": self.target.name},
            "options": {"fields": {"terminated": o["fields_terminated"], "enclosed": o["fields_enclosed"],
                                   "escaped": o["fields_escaped"]},
                        "lines": {"ignore": o["ignore_lines"], "starting": o["lines_starting"],
                                  "terminated": o["lines_terminated"]},
                        "columns": o["columns"], "file_id_column": o["file_id_column"],
                        "duplicate_key_method": self.duplicate_key_method, "script": self.script},
        }, sort_keys=True)


class TargetError(ValueError):
    pass


def _stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema in the stored table's files and partitions, None where there is no table yet."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _check_stored(spark: SparkSession, spec: LoadSpec) -> None:
    stored = _stored_schema(spark, spec.target.path)
    if stored is None:
        return
    fid, bucketed = spec.options.file_id_column, spec.target.file_id_buckets is not None
    kinds = {f.name: f.dataType for f in stored.fields}
    if bucketed != (BUCKET_COL in kinds):
        raise TargetError(f"the stored table at {spec.target.path} is {'not ' if bucketed else ''}bucketed by file id")
    kinds.pop(BUCKET_COL, None)
    for f in spec.target.struct.fields:
        if f.name not in kinds:
            raise TargetError(f"column {f.name!r} does not exist in the stored table at {spec.target.path}")
        kind = kinds.pop(f.name)
        if f.name != fid and kind != f.dataType:  # a partition value has no stored type
            raise TargetError(f"column {f.name!r} is stored as {kind.simpleString()}, not {f.dataType.simpleString()}")
    if kinds:
        raise TargetError(f"the stored table at {spec.target.path} has more columns: {', '.join(sorted(kinds))}")


def check_target(spark: SparkSession, spec: LoadSpec) -> None:
    """S17 preflight: listed / key columns exist; the file-id column exists,
    is DECIMAL(20,0) (unsigned 64-bit) and is not in the column list; the
    table that is stored at the target, if any, has just these columns."""
    st = spec.target.struct
    names = {f.name: f.dataType for f in st.fields}
    for c in spec.options.columns:
        if c not in names:
            raise TargetError(f"column {c!r} does not exist in the target")
    for c in spec.target.key_columns:
        if c not in names:
            raise TargetError(f"key column {c!r} does not exist in the target")
    fid = spec.options.file_id_column
    if fid is not None:
        if fid not in names:
            raise TargetError(f"file id column {fid!r} does not exist in the target")
        if names[fid] != FILE_ID_TYPE:
            raise TargetError(f"file id column {fid!r} must be DECIMAL(20,0) (unsigned 64-bit)")
        if fid in spec.options.columns:
            raise TargetError("the file id column is filled by the load and cannot be one of the columns read")
        if not spec.options.columns:
            raise TargetError("with a file id column, name the columns that the files hold (options.columns)")
    if spec.target.file_id_buckets is not None:
        if fid is None:
            raise TargetError("file_id_buckets needs options.file_id_column")
        if spec.target.file_id_buckets < 1:
            raise TargetError("file_id_buckets must be >= 1")
    _check_stored(spark, spec)
