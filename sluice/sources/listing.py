"""File listing (S2–S7, U1): a manifest DataFrame of the files to load.

The literal root of each pattern is listed by executor tasks
(``streams.list_tree``), hidden and empty files included, and the glob is
applied as a regex on the name.  Stores that tasks cannot open by themselves
(``hdfs``) are listed by Spark's file index (``binaryFile``, metadata columns
only), which hides names starting with ``_`` or ``.``; empty files are added
from a Hadoop metadata listing.

The change fingerprint (``etag`` column) is one of

* ``size_mtime`` (default) – length and modification time;
* ``etag`` – the object store's own etag; where a store has none, as ``md5``;
* ``md5`` – MD5 of the content, read in chunks by executors: a file uploaded
  again with the same content is unchanged;
* ``none`` – NULL, i.e. the file always loads (the reference's rule for
  local files).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.fileid import file_id
from sluice.sources.paths import LoadPath, resolve_path, uri_bucket, uri_name, uri_scheme
from sluice.sources.streams import content_tags, list_tree, reachable

MANIFEST_COLUMNS = ["scheme", "bucket", "name", "etag", "size", "mtime", "path"]
FINGERPRINTS = ("size_mtime", "etag", "md5", "none")


def _found(spark: SparkSession, lp: LoadPath, include_empty: bool) -> DataFrame:
    """(path, size, ms) of the files below the pattern's root."""
    if reachable(lp.root):
        found = list_tree(spark, lp.root)
        return found if include_empty else found.where("size > 0")
    # keys that vanish between listing and reading are skipped (S3 rule)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    try:
        found = reader.load(lp.root).select("path", F.col("length").alias("size"),
                                            F.unix_millis("modificationTime").alias("ms"))
    except Exception as e:  # noqa: BLE001 - a missing root matches nothing
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], "path STRING, size BIGINT, ms BIGINT")
    empties = empty_files(spark, [lp.root], with_mtime=True) if include_empty else []
    if empties:
        found = found.unionByName(spark.createDataFrame(empties, "path STRING, ms BIGINT")
                                  .withColumn("size", F.lit(0).cast("bigint")))
    return found


def _list_one(spark: SparkSession, lp: LoadPath, include_empty: bool) -> DataFrame:
    path = F.col("path")  # the raw name (unlike _metadata.file_path)
    found = _found(spark, lp, include_empty).select(
        uri_scheme(path).alias("scheme"), uri_bucket(path).alias("bucket"), uri_name(path).alias("name"),
        F.concat_ws("-", F.col("size").cast("string"), (F.col("ms") * 1000).cast("string")).alias("etag"), "size",
        F.timestamp_millis("ms").cast("timestamp_ntz").alias("mtime"), "path")
    return found.where(F.col("name").rlike(lp.regex))


def _content_tags(manifest: DataFrame, roots: list[str], etags: bool) -> DataFrame:
    if all(map(reachable, roots)):
        return content_tags(manifest, "etag", etags).select(MANIFEST_COLUMNS)
    read = manifest.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    return manifest.drop("etag").join(read.select("path", F.md5("content").alias("etag")), "path", "left").withColumn(
        "etag", F.when(F.col("size") == 0, F.md5(F.lit(b""))).otherwise(F.col("etag"))).select(MANIFEST_COLUMNS)


def list_files(spark: SparkSession, paths: list[str] | str, fingerprint: str = "size_mtime",
               keep_duplicates: bool = False, include_empty: bool = True) -> DataFrame:
    """S2–S4 + U1: the manifest of every file matched by any pattern.

    The reference lists a file twice when two patterns match it; by default
    we de-duplicate on (scheme, bucket, name).
    """
    if fingerprint not in FINGERPRINTS:
        raise ValueError(f"unknown fingerprint {fingerprint!r}; known: {', '.join(FINGERPRINTS)}")
    resolved = [resolve_path(p) for p in ([paths] if isinstance(paths, str) else paths)]
    out = reduce(DataFrame.unionByName, [_list_one(spark, lp, include_empty) for lp in resolved])
    if not keep_duplicates:
        out = out.dropDuplicates(["scheme", "bucket", "name"])
    if fingerprint == "none":
        out = out.withColumn("etag", F.lit(None).cast("string"))
    elif fingerprint != "size_mtime":
        out = _content_tags(out, [lp.root for lp in resolved], fingerprint == "etag")
    return out.select(MANIFEST_COLUMNS)


def with_file_id(manifest: DataFrame) -> DataFrame:
    """F1 on the manifest (bucket ‖ name)."""
    return manifest.withColumn("file_id", file_id("name", "bucket"))


def dry_run(spark: SparkSession, paths, fingerprint: str = "size_mtime") -> DataFrame:
    """The names that a load would read; nothing is loaded."""
    return list_files(spark, paths, fingerprint).select("name", "size")


def empty_files(spark: SparkSession, roots: list[str], with_mtime: bool = False) -> list:
    """Zero-length files below ``roots`` (Hadoop metadata listing).

    Spark's file index drops empty files, but an emptied file must still be
    reloaded so that its old rows disappear (K5).  Only the empty files'
    names reach the driver; every file costs one metadata step here, so this
    runs only where reload semantics need it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out: list[str] = []
    for root in roots:
        p = jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            continue
        it = fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            if st.getLen() != 0:  # one round trip for the common case
                continue
            name = st.getPath().getName()
            if not name.startswith((".", "_")):
                out.append((st.getPath().toString(), st.getModificationTime()) if with_mtime
                           else st.getPath().toString())
    return out
