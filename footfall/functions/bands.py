"""Bands of visit length (seconds) and step length (actions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band name, first and last value. A value on a shared border belongs to the band
# named first; a visit of 0 seconds belongs to none.
VISIT_BANDS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BANDS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)


def in_band(length: str, first: int, last: int | None) -> Column:
    value = F.col(length)
    return value >= first if last is None else value.between(first, last)


def band_counts(length: str, bands: tuple, prefix: str) -> list[Column]:
    """One conditional count per band, for a single aggregate over all sessions."""
    return [
        F.count_if(in_band(length, first, last)).alias(f"{prefix}_{name}")
        for name, first, last in bands
    ]
