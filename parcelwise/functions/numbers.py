"""Rounding, guarded ratios and exact means."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fixed(x: Column | str, places: int) -> Column:
    """Round half up at ``places`` and return a double.

    Going through a decimal avoids 61.725 being stored as 61.72499... and rounding down.
    """
    return F.round(_col(x).cast("decimal(28,8)"), places).cast("double")


def safe_ratio(num: Column | str, den: Column | str, places: int | None = None) -> Column:
    """``num / den`` as a double, NULL when the denominator is zero."""
    value = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return value if places is None else fixed(value, places)


def mean(x: Column | str, places: int | None = None, unit: str = "decimal(18,3)") -> Column:
    """Average whose sum is exact, so the result does not depend on row order."""
    exact = _col(x).cast(unit)
    return safe_ratio(F.sum(exact), F.count(exact), places)


def mean_if(cond: Column | str, x: Column | str, places: int | None = None,
            unit: str = "decimal(18,3)") -> Column:
    """Average over rows where ``cond`` is true; NULL conditions are left out."""
    return mean(F.when(_col(cond), _col(x)), places, unit)


def tally(cond: Column | str) -> Column:
    """Rows where ``cond`` is true.  NULL counts as not true."""
    return F.count_if(_col(cond))


def floored_ratio(num: Column | str, den: Column | str) -> Column:
    """Readout ratio whose denominator never falls below one."""
    return safe_ratio(num, F.greatest(_col(den).cast("double"), F.lit(1.0)))

