"""Numeric helpers shared by every job."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(38,12)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, digits: int) -> Column:
    """Half-up rounding that does not depend on binary noise.

    The value is first fixed to 12 decimals (absorbing last-bit differences
    between engines and summation orders), then rounded half away from zero.
    NaN, infinities and values beyond decimal(38,12) fall back to
    ``round`` on the double.
    """
    x = _c(x)
    return F.coalesce(
        F.round(x.try_cast(_EXACT), digits).cast("double"),
        F.round(x, digits),
    )


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def stamp(now: _dt.datetime | None) -> Column:
    """Lineage timestamp: a constant when one is given, else the query's
    current_timestamp()."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now).cast("timestamp")
