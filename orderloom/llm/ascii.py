"""Text forms that touch ASCII only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null stays null. ASCII texts take a shorter way to the same."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
