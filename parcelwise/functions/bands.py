"""Labels derived from ordered bounds or ordered rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..params import LATENESS_BUCKETS, NOT_DELIVERED, SEGMENTS, UNKNOWN_WEIGHT, WEIGHT_BANDS


def banded(x: Column, bands: Sequence[tuple[int | None, str]], null_label: str,
           inclusive: bool) -> Column:
    label = F.when(x.isNull(), null_label)
    for bound, name in bands:
        if bound is None:
            return label.otherwise(name)
        label = label.when(x <= bound if inclusive else x < bound, name)
    return label


def lateness_bucket(delay: Column) -> Column:
    return banded(delay, LATENESS_BUCKETS, NOT_DELIVERED, inclusive=True)


def weight_band(grams: Column) -> Column:
    return banded(grams, WEIGHT_BANDS, UNKNOWN_WEIGHT, inclusive=False)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """First matching rule wins, so the order of the rules matters."""
    champions, recent, at_risk, promising, dormant, rest = SEGMENTS
    return (
        F.when((m >= 4) & (r >= 4) & (f >= 3), champions)
        .when((m >= 4) & (r >= 3), recent)
        .when((m >= 4) & (r <= 2), at_risk)
        .when((r >= 4) & (f <= 2), promising)
        .when((m <= 2) & (r <= 2), dormant)
        .otherwise(rest)
    )
