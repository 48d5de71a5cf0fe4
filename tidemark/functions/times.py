"""Epoch conversion, multi-format dates and fiscal periods."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_ts(ms: Column, precision: str = "second") -> Column:
    """Epoch milliseconds to a timestamp, whole seconds by default.

    Negative values floor towards the past. NULL stays NULL, zero is 1970-01-01.
    """
    exact = F.timestamp_millis(ms)
    if precision == "milli":
        return exact
    if precision == "second":
        return F.date_trunc("second", exact)
    raise ValueError(f"precision must be second or milli, not {precision}")


# Digits that each pattern letter run stands for; other letters are not guarded.
_DIGITS = {"yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}", "HH": r"\d{2}", "mm": r"\d{2}", "ss": r"\d{2}"}


def shape_of(pattern: str) -> str | None:
    """A regular expression for texts in the pattern, None if it has other letters."""
    out = []
    for run in re.findall(r"([A-Za-z])(\1*)|([^A-Za-z'])", pattern):
        letters, literal = run[0] + run[1], run[2]
        if literal:
            out.append(re.escape(literal))
        elif letters in _DIGITS:
            out.append(_DIGITS[letters])
        elif set(letters) == {"S"}:
            out.append(rf"\d{{{len(letters)}}}")
        else:
            return None
    return None if "'" in pattern else f"^{''.join(out)}$"


def parse_first(text: Column, formats: Sequence[str]) -> Column:
    """Timestamp by the first format in the list that fits, else NULL.

    Texts of another shape are not tried: a failed attempt costs an exception.
    """
    tries = []
    for pattern in formats:
        parsed = F.try_to_timestamp(text, F.lit(pattern))
        shape = shape_of(pattern)
        tries.append(F.when(text.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*tries)


def to_iso_date(text: Column, formats: Sequence[str]) -> Column:
    """Text in any of ``formats`` to ``yyyy-MM-dd`` text, NULL if none fits."""
    return F.date_format(parse_first(text, formats), "yyyy-MM-dd")


def fiscal_year(day: Column, start_month: int = 7) -> Column:
    """Fiscal year labelled by the calendar year in which it ends."""
    shift = (13 - start_month) % 12
    return F.year(F.add_months(day, shift))


def fiscal_quarter(day: Column, start_month: int = 7) -> Column:
    shift = (13 - start_month) % 12
    return F.quarter(F.add_months(day, shift))


def fiscal_period(day: Column, start_month: int = 7) -> Column:
    """Month number inside the fiscal year, 1 to 12."""
    shift = (13 - start_month) % 12
    return F.month(F.add_months(day, shift))
