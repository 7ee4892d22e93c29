"""Category and session rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.ranking import top_per_group

KINDS = ("click", "order", "pay")


def category_events(actions: DataFrame) -> DataFrame:
    """One row per (session, kind, category) with its number of occurrences.

    A single pass over the actions. Counting per session first means that what is shuffled
    to join the sessions is bounded by the categories a session touches, not by its length.
    """
    clicked = F.when(F.col("click_category_id") != -1, F.col("click_category_id").cast("string"))
    ids = {"click": clicked, "order": F.col("order_category_ids"), "pay": F.col("pay_category_ids")}
    kinds = [F.struct(F.lit(kind).alias("kind"), ids[kind].alias("ids")) for kind in KINDS]
    return (
        actions.select("session_id", F.inline(F.array(*kinds)))
        .filter(F.col("ids").isNotNull())
        .select("session_id", "kind", F.explode(F.split("ids", ",")).alias("id"))
        .select("session_id", "kind", F.col("id").try_cast("bigint").alias("category_id"))
        .filter(F.col("category_id").isNotNull())
        .groupBy("session_id", "kind", "category_id")
        .agg(F.count("*").alias("n"))
    )


def session_category_events(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Category events of the given sessions; actions without an id are one session."""
    ids = sessions.select(F.col("session_id").alias("kept_id"))
    return category_events(actions).join(
        ids, F.col("session_id").eqNullSafe(F.col("kept_id")), "left_semi"
    )


def count_category_ids(actions: DataFrame) -> DataFrame:
    """How many order and payment ids there are, and how many :func:`category_events` drops."""
    ids = F.concat(*[
        F.coalesce(F.split(f"{kind}_category_ids", ","), F.array().cast("array<string>"))
        for kind in ("order", "pay")
    ])
    return actions.select(F.explode(ids).alias("id")).agg(
        F.count("*").alias("ids"),
        F.count_if(F.col("id").try_cast("bigint").isNull()).alias("malformed"),
    )


def category_counts(events: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category; 0 where a category has none."""
    return events.groupBy("category_id").agg(*[
        F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(f"{kind}_count")
        for kind in KINDS
    ])


def kind_counts(events: DataFrame, kind: str) -> DataFrame:
    return (
        events.filter(F.col("kind") == kind)
        .groupBy("category_id")
        .agg(F.sum("n").alias(f"{kind}_count"))
    )


def category_candidates(events: DataFrame) -> DataFrame:
    return events.select("category_id").distinct()


def top_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """Most clicked, then ordered, then paid."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
    ).limit(k)


def session_category_clicks(events: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per session and category for the top categories, from the category events.

    The events hold a row per session and category already, so the actions are not read again.
    """
    return (
        events.filter(F.col("kind") == "click")
        .join(top.select("category_id"), "category_id", "left_semi")
        .select("session_id", "category_id", F.col("n").alias("click_count"))
    )


def top_sessions(clicks: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most active sessions of every category."""
    return top_per_group(clicks, ["category_id"], [F.desc("click_count"), F.asc("session_id")], k)
