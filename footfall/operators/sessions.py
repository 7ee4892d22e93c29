"""Sessions: aggregation of actions, enrichment with user data, filters, band shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.bands import STEP_BANDS, VISIT_BANDS, band_counts
from footfall.functions.parsing import action_timestamp, blank_to_null, format_time
from footfall.params import TaskParams
from footfall.session import spread_join

USER_COLUMNS = ("user_id", "age", "professional", "sex", "city")


def _searched() -> Column:
    return blank_to_null(F.col("search_keyword"))


def _clicked() -> Column:
    return F.nullif(F.col("click_category_id"), F.lit(-1))


def keyword_list() -> Column:
    return F.array_sort(F.collect_set(_searched()))


def category_list() -> Column:
    return F.array_sort(F.collect_set(_clicked()))


def _any_match(value: Column, wanted: tuple) -> Column:
    """Aggregate: does any row carry a wanted value? Without wanted values everything matches."""
    return F.coalesce(F.bool_or(value.isin(*wanted)), F.lit(False)) if wanted else F.lit(True)


def aggregate_sessions(
    actions: DataFrame, p: TaskParams = TaskParams(), lists: bool = True
) -> DataFrame:
    """One row per session.

    ``keyword_match`` and ``category_match`` answer the task's keyword and category filters while
    aggregating. Jobs that only filter and count therefore pass ``lists=False`` and
    carry a few fixed-size columns per session through the shuffle instead of value lists.
    """
    start, end = F.min("ts"), F.max("ts")
    columns = [
        F.min("user_id").alias("user_id"),
        start.alias("start_time"),
        end.alias("end_time"),
        (F.unix_seconds(end) - F.unix_seconds(start)).alias("visit_length"),
        F.count("*").alias("step_length"),
        _any_match(_searched(), p.keywords).alias("keyword_match"),
        _any_match(_clicked(), p.category_ids).alias("category_match"),
    ]
    if lists:
        columns += [
            keyword_list().alias("search_keywords"),
            category_list().alias("click_category_ids"),
        ]
    return (
        actions.withColumn("ts", action_timestamp(F.col("action_time")))
        .groupBy("session_id")
        .agg(*columns)
    )


def enrich(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add the user's data; sessions of unknown users are dropped.

    The user table grows with the site, so the join strategy is left to its measured size.
    """
    return sessions.join(users.select(*USER_COLUMNS), "user_id")


def filter_sessions(full: DataFrame, p: TaskParams) -> DataFrame:
    """Sessions that satisfy every set parameter. An age range needs both bounds."""
    conditions = [F.col("keyword_match"), F.col("category_match")]
    if p.start_age is not None and p.end_age is not None:
        conditions.append(F.col("age").between(p.start_age, p.end_age))
    if p.professionals:
        conditions.append(F.col("professional").isin(*p.professionals))
    if p.cities:
        conditions.append(F.col("city").isin(*p.cities))
    if p.sex:
        conditions.append(F.col("sex") == p.sex)
    for condition in conditions:
        full = full.filter(condition)
    return full


def matching_sessions(
    actions: DataFrame, users: DataFrame, p: TaskParams, lists: bool = False
) -> DataFrame:
    """Aggregate, enrich and filter in one plan."""
    return filter_sessions(enrich(aggregate_sessions(actions, p, lists), users), p)


def render_sessions(sessions: DataFrame) -> DataFrame:
    """Times, and lists if there are any, as text: the form results are published in."""
    texts = {
        "start_time": format_time(F.col("start_time")),
        "end_time": format_time(F.col("end_time")),
        "search_keywords": blank_to_null(F.array_join("search_keywords", ",")),
        "click_category_ids": blank_to_null(
            F.array_join(F.col("click_category_ids").cast("array<string>"), ",")
        ),
    }
    texts = {name: text for name, text in texts.items() if name in sessions.columns}
    return sessions.withColumns(texts).drop("keyword_match", "category_match")


def session_values(actions: DataFrame) -> DataFrame:
    """Searched keywords and clicked categories in long form: session_id, kind, value, n.

    The same facts as the lists of :func:`aggregate_sessions`, a row for each distinct value, so a
    session may have any number of them.
    """
    values = F.array(
        F.struct(F.lit("keyword").alias("kind"), _searched().alias("value")),
        F.struct(F.lit("category").alias("kind"), _clicked().cast("string").alias("value")),
    )
    return (
        actions.select("session_id", F.inline(values))
        .filter(F.col("value").isNotNull())
        .groupBy("session_id", "kind", "value")
        .agg(F.count("*").alias("n"))
    )


def keep_session_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions; those without an id are one session.

    The actions of a very long session are dealt into parts by their time and page.
    """
    return spread_join(actions, sessions.select("session_id"), ["session_id"],
                       ["action_time", "page_id"], "left_semi", salts=8)


def band_totals(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions, and of those in every band."""
    return sessions.agg(
        F.count("*").alias("session_count"),
        *band_counts("visit_length", VISIT_BANDS, "visit_length"),
        *band_counts("step_length", STEP_BANDS, "step_length"),
    )


def _histogram(sessions: DataFrame, bands: tuple, prefix: str) -> DataFrame:
    cells = [
        F.struct(F.lit(name).alias("band"), F.col(f"{prefix}_{name}").alias("sessions"))
        for name, _, _ in bands
    ]
    return band_totals(sessions).select(F.inline(F.array(*cells)))


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    return _histogram(sessions, VISIT_BANDS, "visit_length")


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    return _histogram(sessions, STEP_BANDS, "step_length")


def band_ratios(sessions: DataFrame) -> DataFrame:
    """The share of every band, two decimals; zeros when there is no session."""
    names = [f"visit_length_{name}" for name, _, _ in VISIT_BANDS]
    names += [f"step_length_{name}" for name, _, _ in STEP_BANDS]
    divisor = F.greatest(F.col("session_count"), F.lit(1))
    return band_totals(sessions).select(
        "session_count",
        *[F.round(F.col(name) / divisor, 2).alias(f"{name}_ratio") for name in names],
    )
