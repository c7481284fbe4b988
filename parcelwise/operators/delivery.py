"""Milestones to delivery measures.

Lateness compares dates, because the promise is a date.  Stage durations count complete
hours.  A missing delivery gives NULL lateness, never false; since every stage truncates
to the hour on its own, stages need not add up to the total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bands import lateness_bucket
from ..functions.dates import days_between, stage_days
from ..functions.numbers import fixed


def stages() -> dict[str, Column]:
    """Measures that the milestones alone determine."""
    return {
        "approval_days": stage_days("order_purchased_at", "order_approved_at"),
        "seller_handover_days": stage_days("order_approved_at", "order_handed_to_carrier_at"),
        "carrier_transit_days": stage_days("order_handed_to_carrier_at", "order_delivered_at"),
        "total_delivery_days": stage_days("order_purchased_at", "order_delivered_at"),
        "promised_delivery_days": days_between("order_purchased_at", "order_promised_at"),
        "delay_vs_promise_days": days_between("order_promised_at", "order_delivered_at"),
    }


def verdicts() -> dict[str, Column]:
    """Measures that the stages determine."""
    delay = F.col("delay_vs_promise_days")
    return {
        "is_late": delay > 0,
        "lateness_bucket": lateness_bucket(delay),
        "promise_slack_days": fixed(
            F.col("promised_delivery_days") - F.col("total_delivery_days"), 3),
    }


def delivery(orders: DataFrame) -> DataFrame:
    return orders.drop("_batch_id", "_loaded_at").withColumns(stages()).withColumns(verdicts())
