"""Masking of personal data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The masks and what they replace.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
EMAIL_MASK = "***@***.com"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
SSN_MASK = "***-**-***"


def mask_email(text: Column) -> Column:
    """Most texts have no ``@``; a byte search spares them the regular expression."""
    return F.when(text.contains("@"), F.regexp_replace(text, EMAIL, EMAIL_MASK)).otherwise(text)


def mask_ssn(text: Column) -> Column:
    return F.when(text.contains("-"), F.regexp_replace(text, SSN, SSN_MASK)).otherwise(text)


def mask_pii(text: Column) -> Column:
    return mask_ssn(mask_email(text))


def tokenize(value: Column, salt: str) -> Column:
    """Salted SHA-256 hex digest; equal values keep equal tokens."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def mask_for_role(value: Column, role: str | Column, allowed: Iterable[str], mask: Column) -> Column:
    """The value for allowed roles, the mask for every other role."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.when(role.isin(*allowed), value).otherwise(mask)
