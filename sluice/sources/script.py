"""Per-file external script (S16): file bytes → ``/bin/bash -c script`` →
the lines of its stdout are what gets parsed.

A task opens the file itself and feeds it to the process in chunks while it
turns the output into Arrow batches of lines, so its memory does not depend on
the file's size; ``.gz`` input is gunzipped on the way.  A non-zero exit, a
corrupt gzip, input left unread, or ``timeout_s`` seconds in which the process
neither takes input nor gives output nor ends make the file fail (one row
carrying ``_script_error``) — no retry, as in the reference.

Stores that tasks cannot open (``streams.reachable``) are read with
``binaryFile``: there a file is one value, and must be < 2 GB.

For line-oriented commands that need no file boundary, Spark SQL's
``TRANSFORM ... USING`` is the lighter path (``transform_lines``).
"""

from __future__ import annotations

import contextlib
import gzip
import os
import queue
import signal
import subprocess
import threading
import time
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.delimited import TextOptions, _plain_line, _protect, joined_records
from sluice.sources.streams import (LINE_SCHEMA, Unreadable, checked_chunks, line_batches, reachable, split_lines,
                                    store_options)

_STDERR_KEPT = 4096


class ScriptFailure(Exception):
    """Why a script's run of one file failed."""


def script_output(command: str, source: Iterator[bytes], timeout_s: float) -> Iterator[bytes]:
    """Chunks of the command's stdout while ``source`` is fed to it; raises ``ScriptFailure`` or ``Unreadable``.
    The command's children end with it; a command that leaves input unread has failed, whatever its exit code."""
    proc = subprocess.Popen(["/bin/bash", "-c", command], stdin=subprocess.PIPE, stdout=subprocess.PIPE,
                            stderr=subprocess.PIPE, start_new_session=True)
    moved = [time.monotonic()]
    trouble: list[Exception] = []
    stderr: list[bytes] = []
    out: queue.Queue = queue.Queue(maxsize=16)  # the process waits while its output is not taken
    over = threading.Event()

    def feed() -> None:
        try:
            with proc.stdin:
                for chunk in source:
                    for first in range(0, len(chunk), 65536):
                        proc.stdin.write(chunk[first:first + 65536])
                        moved[0] = time.monotonic()
        except (BrokenPipeError, ValueError):
            trouble.append(ScriptFailure("script ended before it had read its whole input"))
        except Unreadable as e:
            trouble.append(e)
        moved[0] = time.monotonic()

    def put(chunk: bytes | None) -> None:
        while not over.is_set():
            with contextlib.suppress(queue.Full):
                return out.put(chunk, timeout=0.2)

    def drain() -> None:
        while chunk := proc.stdout.read1(65536):
            moved[0] = time.monotonic()
            put(chunk)
        put(None)

    def keep_errors() -> None:
        while chunk := proc.stderr.read1(65536):
            if sum(map(len, stderr)) < _STDERR_KEPT:
                stderr.append(chunk)

    threads = [threading.Thread(target=f, daemon=True) for f in (feed, drain, keep_errors)]
    for t in threads:
        t.start()
    try:
        while True:
            try:
                chunk = out.get(timeout=0.1)
            except queue.Empty:
                if time.monotonic() - moved[0] > timeout_s:  # stuck, or a child still holds a pipe
                    raise ScriptFailure(f"script did not exit within {timeout_s} s") from None
                continue
            if chunk is None:
                break
            yield chunk
            moved[0] = time.monotonic()  # the time that the lines took downstream is not the script's
        try:
            proc.wait(timeout=timeout_s)
        except subprocess.TimeoutExpired:
            raise ScriptFailure(f"script did not exit within {timeout_s} s") from None
        for t in threads:
            t.join(timeout=timeout_s)
        unreadable = [e for e in trouble if isinstance(e, Unreadable)]
        if unreadable:
            raise unreadable[0]
        if proc.returncode != 0:
            said = b"".join(stderr)[:_STDERR_KEPT].decode("utf-8", "replace").strip()
            raise ScriptFailure(f"script exited with code {proc.returncode}" + (f": {said}" if said else ""))
        if trouble:
            raise trouble[0]
    finally:
        over.set()
        if proc.poll() is None or any(t.is_alive() for t in threads):
            with contextlib.suppress(ProcessLookupError):
                os.killpg(proc.pid, signal.SIGKILL)
        proc.wait()


def _run(command: str, data: bytes, timeout_s: float) -> tuple[bytes, str | None]:
    """Stdout of the command fed with ``data``, or why it failed."""
    try:
        return b"".join(script_output(command, iter([data] if data else []), timeout_s)), None
    except ScriptFailure as e:
        return b"", str(e)


def _from_value(path: str, content: bytes | None) -> Iterator[bytes]:
    """The bytes of a file that Spark has read as one value."""
    try:
        yield gzip.decompress(content or b"") if path.endswith(".gz") else content or b""
    except (OSError, EOFError, zlib.error) as e:
        raise Unreadable(f"corrupt gzip input: {e}") from e


def _make_mapper(command: str, line_sep: str, timeout_s: float, options: dict):
    sep = line_sep.encode("utf-8")

    def mapper(batches):
        for batch in batches:
            paths = batch.column("path").to_pylist()
            values = batch.column("content") if "content" in batch.schema.names else [None] * len(paths)
            for path, value in zip(paths, values, strict=True):
                source = checked_chunks(path, options) if value is None else _from_value(path, value.as_py())
                yield from line_batches(path, split_lines(script_output(command, source, timeout_s), sep),
                                        (ScriptFailure, Unreadable))
    return mapper


def transform_files(spark: SparkSession, paths: list[str], command: str, opts: TextOptions | None = None,
                    timeout_s: float = 30, manifest: DataFrame | None = None) -> DataFrame:
    """Lines of each file after the script, in the shape ``read_lines`` gives
    (protected value, ``_file``, ``_block``, ``_mid``) plus ``_script_error``.
    Skip-lines and line prefix apply to the script's output.  ``manifest``
    (``path``) names the files instead of ``paths``."""
    opts = opts or TextOptions()
    files = manifest if manifest is not None else (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths))
    if manifest is not None or all(map(reachable, paths)):
        files = files.select("path").repartition(F.xxhash64("path"))
    else:
        files = files.select("path", "content")
    out = files.mapInArrow(_make_mapper(command, opts.lines_terminated, timeout_s, store_options(spark)), LINE_SCHEMA)
    out = out.withColumns({"_plain": _plain_line(F.col("value"), opts.fields_escaped),
                           "value": _protect(F.col("value"), opts.fields_escaped)})
    out = joined_records(out, opts) if opts.escaped_terminators else out.withColumn("_line", F.col("_mid"))
    if opts.ignore_lines > 0:
        out = out.where((F.col("_line") >= opts.ignore_lines) | F.col("_script_error").isNotNull())
    if opts.lines_starting:
        at = F.instr(F.col("value"), opts.lines_starting)
        out = out.where((at > 0) | F.col("_script_error").isNotNull()).withColumn(
            "value", F.substring(F.col("value"), at + len(opts.lines_starting), F.length("value")))
    return out


def transform_lines(spark: SparkSession, lines: DataFrame, command: str, column: str = "value") -> DataFrame:
    """Line-oriented script over a DataFrame column with Spark SQL
    ``TRANSFORM ... USING`` (no file boundaries; runs per partition)."""
    view = f"_sluice_transform_{abs(hash((command, id(lines))))}"
    lines.select(F.col(column).alias("value")).createOrReplaceTempView(view)
    cmd = command.replace("\\", "\\\\").replace("'", "\\'")
    return spark.sql(f"SELECT TRANSFORM(value) USING '{cmd}' AS (value STRING) FROM {view}")
