"""UTF-8 normalisation of raw bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_utf8(raw: Column, charset: str = "UTF-8") -> Column:
    """Bytes in ``charset`` to text; ill-formed UTF-8 becomes U+FFFD."""
    if charset.upper().replace("-", "") == "UTF8":
        return F.make_valid_utf8(raw.cast("string"))
    return F.decode(raw, charset)
