"""Files as streams inside tasks: trees listed by executors, contents read chunk by chunk.

Spark's file sources hide names that start with ``_`` or ``.``, skip empty files, end the whole job at one corrupt
``.gz`` and hand a file to Python as one value.  Here ``mapInArrow`` tasks open the store themselves
(``pyarrow.fs``) and work through a file in chunks, so a task's memory does not depend on the file and one file's
failure is a row.  ``reachable`` says for which URIs this works; for others the callers use Spark's sources.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_dir, track_staged

CHUNK = 1 << 20
#: Directories that a task lists before it hands the ones found below back to be spread over other tasks.
DIRECTORIES_A_TASK = 256
_BATCH_LINES = 8192
_LISTED = "path STRING, is_dir BOOLEAN, size BIGINT, ms BIGINT"
LINE_SCHEMA = "value STRING, _file STRING, _block BIGINT, _mid BIGINT, _script_error STRING"


def reachable(uri: str) -> bool:
    """Whether tasks can open ``uri`` by themselves."""
    scheme = uri.partition(":")[0].lower() if ":" in uri else ""
    return uri.startswith("/") or scheme in ("file", "s3", "s3a", "s3n", "gs")


def store_options(spark: SparkSession) -> dict:
    """How tasks reach S3: the session's ``fs.s3a`` settings; anonymous where it has no keys."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    key, secret, endpoint = (conf.get(f"fs.s3a.{k}") for k in ("access.key", "secret.key", "endpoint"))
    options = {"access_key": key, "secret_key": secret} if key and secret else {"anonymous": True}
    return options | ({"endpoint_override": endpoint} if endpoint else {})


def _store(uri: str, options: dict):
    """(file system, path in it, what turns its paths into URIs)."""
    from pyarrow import fs
    scheme, _, rest = uri.partition(":")
    if uri.startswith("/") or scheme == "file":
        path = uri if uri.startswith("/") else rest
        return fs.LocalFileSystem(), "/" + path.lstrip("/"), "file:"
    store = fs.GcsFileSystem() if scheme == "gs" else fs.S3FileSystem(**options)
    return store, rest.lstrip("/"), f"{scheme}://"


def _children(uri: str, options: dict) -> list[tuple[str, bool, int, int]]:
    """(URI, is a directory, size, modification time in ms) of what stands in a directory, or of a file itself.
    The checksum files that Hadoop's local file system keeps beside its files are no files of their own."""
    from pyarrow import fs
    store, path, prefix = _store(uri, options)
    (own,) = store.get_file_info([path])
    if own.type == fs.FileType.NotFound:
        return []
    found = [own] if own.type == fs.FileType.File else store.get_file_info(
        fs.FileSelector(path, recursive=False, allow_not_found=True))
    names = {x.base_name for x in found}
    out = []
    for x in found:
        if x.base_name.startswith(".") and x.base_name.endswith(".crc") and x.base_name[1:-4] in names:
            continue
        is_dir = x.type == fs.FileType.Directory
        if is_dir or x.type == fs.FileType.File:
            out.append((prefix + x.path, is_dir, 0 if is_dir else x.size, (x.mtime_ns or 0) // 1_000_000))
    return out


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, ms) of every file below ``root``, hidden and empty ones included.

    Each task lists up to ``DIRECTORIES_A_TASK`` directories from the one it was given and hands on the others it
    has found; these are dealt over the tasks of the next round.  The driver learns only whether any are left."""
    import pyarrow as pa
    options = store_options(spark)

    def walk(batches):
        for batch in batches:
            for start in batch.column("path").to_pylist():
                todo, listed, out = [start], 0, []
                while todo and listed < DIRECTORIES_A_TASK:
                    for entry in _children(todo.pop(), options):
                        (todo if entry[1] else out).append(entry[0] if entry[1] else entry)
                    listed += 1
                    if len(out) >= _BATCH_LINES:
                        yield _entries(pa, out)
                        out = []
                yield _entries(pa, out + [(path, True, 0, 0) for path in todo])

    todo, rounds = spark.createDataFrame([(root,)], "path STRING"), []
    while True:
        path = scratch_dir(spark, "listing")
        todo.mapInArrow(walk, _LISTED).write.parquet(path)
        track_staged(path)
        rounds.append(path)
        below = spark.read.parquet(path).where("is_dir").select("path")
        if below.isEmpty():
            break
        todo = below.repartition(F.xxhash64("path"))
    return spark.read.schema(_LISTED).parquet(*rounds).where("NOT is_dir").select("path", "size", "ms")


def _entries(pa, rows: list):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.bool_(), pa.int64(), pa.int64()))],
        names=["path", "is_dir", "size", "ms"])


def chunks(uri: str, options: dict, unpack: bool = True) -> Iterator[bytes]:
    """The file's bytes; a ``.gz`` is unpacked (its checksum and length are verified at the end) if ``unpack``."""
    store, path, _ = _store(uri, options)
    with store.open_input_stream(path, compression=None) as stream:
        source = gzip.GzipFile(fileobj=stream) if unpack and uri.endswith(".gz") else stream
        while chunk := source.read(CHUNK):
            yield chunk


def content_tags(files: DataFrame, column: str, etags: bool) -> DataFrame:
    """``files`` (with ``path``) and its content fingerprint in ``column``: the store's own etag where it has one
    and ``etags`` asks for it, else the MD5 of the bytes, read in chunks."""
    import pyarrow as pa
    options = store_options(files.sparkSession)

    def tag(uri: str) -> str:
        store, path, _ = _store(uri, options)
        if etags:
            with store.open_input_stream(path, compression=None) as stream:
                known = {k.lower(): v for k, v in (stream.metadata() or {}).items()}.get(b"etag")
            if known:
                return known.decode().strip('"')
        digest = hashlib.md5(usedforsecurity=False)
        for chunk in chunks(uri, options, unpack=False):
            digest.update(chunk)
        return digest.hexdigest()

    def run(batches):
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    found.append(tag(path))
                except FileNotFoundError:  # gone since it was listed
                    found.append(None)
            at = batch.schema.get_field_index(column)
            yield batch.set_column(at, column, pa.array(found, pa.string()))

    shaped = files.withColumn(column, F.lit(None).cast("string"))
    return shaped.repartition(F.xxhash64("path")).mapInArrow(run, shaped.schema)


def split_lines(parts: Iterator[bytes], sep: bytes) -> Iterator[list[str]]:
    """The lines of a stream, a list for every few chunks."""
    rest, lines = b"", []
    for part in parts:
        found = (rest + part).split(sep)
        rest = found.pop()
        lines += found
        while len(lines) >= _BATCH_LINES:
            yield [x.decode("utf-8", "replace") for x in lines[:_BATCH_LINES]]
            lines = lines[_BATCH_LINES:]
    if rest:
        lines.append(rest)
    if lines:
        yield [x.decode("utf-8", "replace") for x in lines]


def line_batches(path: str, lists: Iterator[list[str]], failures: tuple) -> Iterator:
    """Arrow batches of ``LINE_SCHEMA``; a failure ends them with one row that names it."""
    import pyarrow as pa
    schema = pa.schema([("value", pa.string()), ("_file", pa.string()), ("_block", pa.int64()), ("_mid", pa.int64()),
                        ("_script_error", pa.string())])
    at = 0
    try:
        for lines in lists:
            n = len(lines)
            yield pa.RecordBatch.from_pydict({"value": lines, "_file": [path] * n, "_block": [0] * n,
                                              "_mid": range(at, at + n), "_script_error": [None] * n}, schema=schema)
            at += n
    except failures as e:
        yield pa.RecordBatch.from_pydict({"value": [None], "_file": [path], "_block": [0], "_mid": [at],
                                          "_script_error": [str(e)]}, schema=schema)


class Unreadable(Exception):
    """A file whose bytes cannot be read to the end."""


def checked_chunks(uri: str, options: dict) -> Iterator[bytes]:
    """``chunks`` with every failure of the file itself as ``Unreadable``."""
    import zlib
    try:
        yield from chunks(uri, options)
    except (EOFError, gzip.BadGzipFile, zlib.error) as e:
        raise Unreadable(f"corrupt gzip input: {e}") from e
    except OSError as e:
        raise Unreadable(f"cannot be read: {e}") from e


def read_file_lines(files: DataFrame, sep: str) -> DataFrame:
    """``LINE_SCHEMA`` rows of every file of ``files`` (``path``), one task for a file at a time; an unreadable
    file gives the lines before the trouble and a row with ``_script_error``."""
    options, mark = store_options(files.sparkSession), sep.encode()

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from line_batches(path, split_lines(checked_chunks(path, options), mark), (Unreadable,))

    return files.select("path").repartition(F.xxhash64("path")).mapInArrow(run, LINE_SCHEMA)
