"""Numeric and categorical measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome labels.
HOME_WIN = "HOME_WIN"
AWAY_WIN = "AWAY_WIN"
DRAW = "DRAW"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(a: Column | str, b: Column | str) -> Column:
    """Sum of two scores, NULL when either is."""
    return _col(a) + _col(b)


def outcome(home: Column | str, away: Column | str) -> Column:
    """Which side scored more; a missing score counts as a draw."""
    h, a = _col(home), _col(away)
    return F.when(h > a, HOME_WIN).when(h < a, AWAY_WIN).otherwise(DRAW)


def percentage(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, NULL when ``whole`` is zero.

    Decimal division, so that halves round up exactly; the result is a double.
    """
    share = _col(part) * F.lit(100.0).cast("decimal(4,1)") / F.nullif(_col(whole), F.lit(0))
    return F.round(share, digits).cast("double")
