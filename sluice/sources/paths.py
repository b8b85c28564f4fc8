"""Load paths (S1) and glob patterns.

A load path is ``[s3://bucket/|hdfs://host/|file://]pattern``.  Spark's own
glob expansion does not give UNIX semantics (``dir/*`` also returned files
in sub-directories and ``**`` behaved like ``*``), so listing reads the
literal root recursively and filters by our own regex:
``*`` → one path segment, ``**`` → any depth, ``?`` → one character,
``[...]`` kept.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column
from pyspark.sql import functions as F

GLOB_CHARS = "*?["


class PathError(ValueError):
    pass


def has_magic(text: str) -> bool:
    return any(c in text for c in GLOB_CHARS)


@dataclass(frozen=True)
class LoadPath:
    """A resolved load path: scheme, bucket (S3 only) and key pattern."""

    scheme: str
    bucket: str | None
    pattern: str
    authority: str | None = None  # hdfs namenode host:port

    @property
    def root(self) -> str:
        """Deepest directory of the pattern without glob characters, as a
        Hadoop URI (``s3a://`` for S3)."""
        if has_magic(self.pattern):
            parts = self.pattern.split("/")
            fixed = []
            for p in parts[:-1]:
                if has_magic(p):
                    break
                fixed.append(p)
            rel = "/".join(fixed)
        else:
            rel = self.pattern  # a plain path lists exactly itself
        if self.scheme == "s3":
            return f"s3a://{self.bucket}/{rel}"
        if self.scheme == "hdfs":
            return f"hdfs://{self.authority or ''}{rel or '/'}"
        return "file:" + (rel or "/")

    @property
    def regex(self) -> str:
        """Anchored regex over the listed ``name`` (key for S3, absolute
        path otherwise)."""
        return "^" + glob_to_regex(self.pattern) + "$"


def _in_bucket(parsed, path: str) -> LoadPath:
    return LoadPath("s3", parsed.netloc, parsed.path[1:])


def _on_hdfs(parsed, path: str) -> LoadPath:
    return LoadPath("hdfs", None, "/" + parsed.path.lstrip("/"), authority=parsed.netloc or None)


def _on_disk(parsed, path: str) -> LoadPath:
    raw = parsed.netloc + parsed.path if parsed.scheme else path
    return LoadPath("file", None, os.path.abspath(raw) if not raw.startswith("/") else raw)


_BY_SCHEME = {"s3": _in_bucket, "hdfs": _on_hdfs, "file": _on_disk, "": _on_disk}

# what a path of each kind may not be: (applies to, is wrong, why)
_WRONG = (
    ("file", lambda p: "|" in p.pattern, "a local pattern has no alternatives: '|' is not allowed"),
    ("s3", lambda p: has_magic(p.bucket or ""), "the bucket must be a plain name without glob characters"),
    ("s3", lambda p: bool(p.bucket) and not p.pattern, "a key or pattern must follow the bucket"),
)


def resolve_path(path: str) -> LoadPath:
    """Scheme by prefix (none = local); errors for an unknown scheme,
    ``|`` in a local pattern, glob characters in a bucket, or a bucket with
    no key pattern."""
    parsed = urlparse(path)
    if parsed.scheme not in _BY_SCHEME:
        raise PathError(f"{path!r}: no reader for the scheme {parsed.scheme!r}; known: s3, hdfs, file")
    found = _BY_SCHEME[parsed.scheme](parsed, path)
    for scheme, wrong, why in _WRONG:
        if found.scheme == scheme and wrong(found):
            raise PathError(f"{path!r}: {why}")
    return found


def glob_to_regex(pattern: str) -> str:
    """Translate a UNIX glob with ``**`` into a Java/Python regex body."""
    out = []
    i, n = 0, len(pattern)
    while i < n:
        c = pattern[i]
        if c == "*":
            if pattern.startswith("**/", i):
                out.append("(?:.*/)?")
                i += 3
                continue
            if pattern.startswith("**", i):
                out.append(".*")
                i += 2
                continue
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[":
            j = pattern.find("]", i + 1)
            if j == -1:
                out.append(re.escape(c))
            else:
                body = pattern[i + 1:j]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append("[" + body.replace("\\", "\\\\") + "]")
                i = j + 1
                continue
        else:
            out.append(re.escape(c))
        i += 1
    return "".join(out)


# ---------------------------------------------------------------------------
# URI → (scheme, bucket, name) as Column expressions
# ---------------------------------------------------------------------------

def decode_file_path(c: Column) -> Column:
    """``_metadata.file_path`` / ``input_file_name()`` percent-encode blanks
    and ``%``; decode to the raw name (``+`` is protected first)."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def uri_scheme(uri: Column) -> Column:
    s = F.lower(F.regexp_extract(uri, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return (F.when(s.isin("s3", "s3a", "s3n"), F.lit("s3"))
            .when(s == "hdfs", F.lit("hdfs"))
            .otherwise(F.lit("file")))


def uri_bucket(uri: Column) -> Column:
    b = F.regexp_extract(uri, r"^[sS]3[an]?://([^/]+)/", 1)
    return F.when(b != "", b)


def uri_name(uri: Column) -> Column:
    """Name of a file in its scheme's namespace: S3 key without bucket,
    HDFS / local path without scheme and authority."""
    return (F.when(uri_scheme(uri) == "s3", F.regexp_extract(uri, r"^[^:]+://[^/]+/(.*)$", 1))
            .when(uri_scheme(uri) == "hdfs", F.regexp_replace(uri, r"^hdfs://[^/]*", ""))
            .otherwise(F.regexp_replace(uri, r"^file:(//)?", "")))
