"""Scans of the action table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.params import TaskParams


def action_scan(actions: DataFrame, p: TaskParams) -> DataFrame:
    """Actions between the two dates, both included."""
    if p.start_date:
        actions = actions.filter(F.col("date") >= p.start_date)
    if p.end_date:
        actions = actions.filter(F.col("date") <= p.end_date)
    return actions


def click_scan(actions: DataFrame, p: TaskParams) -> DataFrame:
    """City and product of the clicks between the two dates."""
    return (
        action_scan(actions, p)
        .filter(F.col("click_product_id") != -1)
        .select("city_id", "click_product_id")
    )
