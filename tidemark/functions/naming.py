"""snake_case column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_WORD_EDGE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    spaced = _WORD_EDGE.sub("_", name.strip())
    cleaned = re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").lower()
    return cleaned or "col"


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column; a repeated name gets ``_2``, ``_3`` and so on."""
    taken: set[str] = set()
    names = []
    for column in df.columns:
        base = snake_case(column)
        name, n = base, 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        names.append(name)
    return df.toDF(*names)
