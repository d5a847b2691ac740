"""Divisions that never raise on a zero denominator.

SQL flavour gives NULL, BI flavour gives 0. Ratios are taken in double, money stays decimal until then.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonzero(c: Column) -> Column:
    """The value, NULL where it is 0.

    Not NULLIF: that puts a projection of its own under the expression, and a limit over a sort with two
    projections in between is planned as a full sort instead of a top-k.
    """
    return F.when(c != 0, c)


def div(num: Column | str, den: Column | str) -> Column:
    """num / den in double, NULL where den is 0."""
    return _col(num).cast("double") / nonzero(_col(den).cast("double"))


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Round a double the way decimals round.

    A quotient such as 42659.925 may be stored as 42659.924999999996; rounding at eight digits first takes
    that noise out before the tie is decided.
    """
    return F.round(F.round(c, 8), scale)


def per(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """num / den rounded."""
    return round_half_up(div(num, den), scale)


def pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """100 * num / den rounded."""
    return round_half_up(
        _col(num).cast("double") * 100.0 / nonzero(_col(den).cast("double")), scale
    )


def divide0(num: Column | str, den: Column | str) -> Column:
    """BI flavour: 0 where the denominator is 0 or missing."""
    return F.coalesce(div(num, den), F.lit(0.0))


def mean(total: Column, count: Column) -> Column:
    """Arithmetic mean taken as one double division, so it does not depend on the row order."""
    return div(total, count)
