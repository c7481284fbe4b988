"""Analytical cut-offs shared by every operator.  Nothing else hard-codes them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

# --- fixed values -----------------------------------------------------------
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")
UNKNOWN_REGION = "Unknown"
STATES_BY_REGION = {
    "Norte": "AC AP AM PA RO RR TO",
    "Nordeste": "AL BA CE MA PB PE PI RN SE",
    "Centro-Oeste": "DF GO MT MS",
    "Sudeste": "ES MG RJ SP",
    "Sul": "PR RS SC",
}
# Upper bounds are inclusive, in days against the promise; the last label has none.
LATENESS_BUCKETS = (
    (-8, "1. Very early (8+ days)"),
    (-1, "2. Early (1-7 days)"),
    (0, "3. On the promised day"),
    (3, "4. Late (1-3 days)"),
    (7, "5. Late (4-7 days)"),
    (15, "6. Late (8-15 days)"),
    (None, "7. Late (16+ days)"),
)
NOT_DELIVERED = "Not delivered"
# Upper bounds are exclusive, in grams.
WEIGHT_BANDS = (
    (500, "1. Light (<0.5kg)"),
    (2000, "2. Medium (0.5-2kg)"),
    (10000, "3. Heavy (2-10kg)"),
    (None, "4. Very heavy (10kg+)"),
)
UNKNOWN_WEIGHT = "Unknown"
SEGMENTS = (
    "1. Champions", "2. High value, recent", "3. At risk, high value",
    "4. New / promising", "5. Dormant, low value", "6. Occasional",
)


def _region_of_state() -> dict[str, str]:
    return {s: region for region, states in STATES_BY_REGION.items() for s in states.split()}


@dataclass(frozen=True)
class Params:
    as_of: date = date(2018, 10, 17)
    window_start: date = date(2016, 9, 1)
    window_end: date = date(2018, 10, 31)
    calendar_start: date = date(2016, 1, 1)
    calendar_end: date = date(2019, 1, 1)  # exclusive
    excluded_statuses: tuple[str, ...] = ("canceled", "unavailable")
    delivered_status: str = "delivered"
    min_orders: int = 30
    min_month_orders: int = 500
    top_categories: int = 10
    tiles: int = 5
    region_of_state: Mapping[str, str] = field(default_factory=_region_of_state, hash=False)

    def __post_init__(self) -> None:
        if not self.calendar_start < self.calendar_end:
            raise ValueError("calendar_start must lie before calendar_end")
