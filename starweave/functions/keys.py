"""Surrogate keys.

Keys are SHA-256 hex digests of the natural key text. Composite keys join
their parts with a pipe and write a null part as the text ``null`` so a null
never erases the whole key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator between key parts, text for a null part, and the
# timestamp text format used inside keys (millisecond precision).
KEY_SEPARATOR = "|"
NULL_PART = "null"
KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_text(c) -> Column:
    """Timestamp as fixed-format text; independent of session settings."""
    return F.date_format(_col(c), KEY_TS_FORMAT)


def hash_key(c) -> Column:
    """sha2(x, 256) of one part; null stays null."""
    return F.sha2(_col(c).cast("string"), 256)


def surrogate_key(*parts) -> Column:
    """sha2 of parts joined by ``|`` with null parts written as ``null``."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(KEY_SEPARATOR))
        pieces.append(F.coalesce(_col(p).cast("string"), F.lit(NULL_PART)))
    return F.sha2(F.concat(*pieces), 256)
