"""the 64-bit file id of a file, from its bucket and name.

id = first 16 hex digits of SHA-256(UTF-8 of bucket || name), read as an
unsigned 64-bit integer.  No separator; the scheme is not part of it.  Values
reach 2**64 - 1, so the Spark type is DECIMAL(20,0), never BIGINT.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_id_string(name, bucket=None) -> Column:
    """Decimal text of the file id (``conv`` works on unsigned 64-bit)."""
    key = _col(name) if bucket is None else F.concat(F.coalesce(_col(bucket), F.lit("")), _col(name))
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10)


def file_id(name, bucket=None) -> Column:
    """File id as DECIMAL(20,0) — usable as a partition column."""
    return file_id_string(name, bucket).cast("decimal(20,0)")


def file_id_py(name: str, bucket: str | None = None) -> Decimal:
    """Driver-side twin, for literals (``F.lit`` needs a Decimal above 2**63)."""
    text = (bucket or "") + name
    return Decimal(int(hashlib.sha256(text.encode("utf-8")).hexdigest()[:16], 16))
