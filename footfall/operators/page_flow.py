"""Page-flow conversion: which page follows which inside a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.parsing import action_timestamp

# Places where crowded sessions may be cut, and the share of rows (one of so many) they are
# drawn from. Both only balance tasks; no result depends on them.
CUTS = 16384
DRAWN = 64


def _ordering(columns: list[str], direction: str) -> list[Column]:
    if direction not in ("desc", "asc"):
        raise ValueError("direction is 'desc' (newest first) or 'asc' (oldest first)")
    return [F.desc(c) if direction == "desc" else F.asc(c) for c in columns]


def _cut_places(rows: DataFrame, keys: list[str], cuts: int, drawn: int) -> DataFrame:
    """Sorted order keys of up to ``cuts`` rows, as one list for each session and hour they are in.

    The rows are those with the least hash of each of ``cuts`` hash ranges, the same ones each
    time this is evaluated. A session-hour gets as many as its share of all rows; one with fewer
    than two is no more crowded than a range and is left whole.
    """
    return (
        rows.filter(F.pmod("number", F.lit(drawn)) == 0)
        .groupBy(F.pmod(F.shiftright("number", 20), F.lit(cuts)).alias("range"))
        .agg(F.min(F.struct("number", "session_hash", "hour_key", F.struct(*keys).alias("place")))
             .alias("least"))
        .groupBy("least.session_hash", "least.hour_key")
        .agg(F.array_sort(F.collect_set("least.place")).alias("places"))
        .filter(F.size("places") > 1)
    )


def _with_parts(rows: DataFrame, keys: list[str], cuts: int, drawn: int) -> DataFrame:
    """Number of the cut places below each row's order key, found by halving."""
    # At most ``cuts`` places in all, so the lists have a fixed size.
    listed = rows.join(F.broadcast(_cut_places(rows, keys, cuts, drawn)),
                       ["session_hash", "hour_key"], "left")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(cuts.bit_length()))])
    here = F.struct(*keys)
    below = F.aggregate(steps, F.lit(0), lambda found, step: found + F.when(
        (found + step <= F.size("places")) & (F.get("places", found + step - 1) < here), step
    ).otherwise(0))
    part = F.coalesce(F.when(F.col("places").isNotNull(), below), F.lit(0))
    return listed.withColumn("part", part).drop("places", "session_hash", "number")


def following_pages(actions: DataFrame, direction: str = "desc", cuts: int = CUTS,
                    drawn: int = DRAWN) -> DataFrame:
    """Every action with the page that follows it in its session; null after the last one.

    ``direction`` orders a session newest first (``desc``) or oldest first (``asc``). Equal times
    are ordered by ``event_id`` where the table has one, else by page. An action whose time cannot
    be read counts as older than all others. Actions without a session id form one session.

    A session is ordered in ranges: hour by hour, and a crowded hour in parts between places
    drawn from its rows, so that neither a session's length nor a burst matters to a task. The
    last action of a range takes its following page from the session's next range; for that the
    first page of each range is enough, a small aggregate on the same keys. Rows equal in session,
    time and ``event_id`` (or page) stay together.
    """
    order = [c for c in ("event_id",) if c in actions.columns]
    keys = ["ts", *(order or ["page_id"])]
    number = F.xxhash64("session_id", "action_time", "page_id")
    if order:
        number = F.when(F.col("event_id").isNotNull(), F.xxhash64("event_id")).otherwise(number)
    # Keys without nulls, so that the join finds the rows where the window has left them.
    rows = actions.select(
        "session_id", "action_time", *order, "page_id",
        action_timestamp(F.col("action_time")).alias("ts"),
    ).withColumns({
        "session_key": F.coalesce(F.concat(F.lit("s"), "session_id"), F.lit("")),
        "session_hash": F.xxhash64("session_id"),
        # From the row's own id where it has one, else from the columns as they were read, so that
        # times are parsed for drawn rows alone.
        "number": number,
        "hour_key": F.coalesce(F.unix_seconds(F.date_trunc("hour", "ts")), F.lit(-(2**63))),
    })
    rows = _with_parts(rows, keys, cuts, drawn)
    ranges = ["session_key", "hour_key", "part"]
    inside = Window.partitionBy(*ranges).orderBy(*_ordering(keys, direction))
    rows_after = rows.withColumns({
        "next_page_id": F.lead("page_id").over(inside),
        "is_last": F.lead(F.lit(1)).over(inside).isNull(),
    })
    first = F.max_by if direction == "desc" else F.min_by
    along = Window.partitionBy("session_key").orderBy(*_ordering(["hour_key", "part"], direction))
    borders = (
        rows.groupBy(*ranges)
        .agg(first("page_id", F.struct(*keys)).alias("first_page"))
        .withColumn("page_after", F.lead("first_page").over(along))
        .select(*ranges, "page_after")
    )
    return rows_after.join(borders, ranges).select(
        "session_id", "action_time", *order, "page_id",
        F.when(F.col("is_last"), F.col("page_after")).otherwise(F.col("next_page_id"))
        .alias("next_page_id"),
    )


def page_pairs(following: DataFrame) -> DataFrame:
    """Adjacent page pairs, named ``p_q``."""
    return following.filter(F.col("next_page_id").isNotNull()).withColumn(
        "pair", F.concat_ws("_", "page_id", "next_page_id")
    )


def target_pairs(flow: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """Step number, page and next page of a page flow."""
    if len(flow) < 2:
        raise ValueError("a page flow has at least two pages")
    return [(i + 1, a, b) for i, (a, b) in enumerate(zip(flow, flow[1:]))]


def _flow_totals(following: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """One row: actions on the first page, and occurrences of every target pair."""
    return following.agg(
        F.count_if(F.col("page_id") == flow[0]).alias("start_count"),
        *[
            F.count_if((F.col("page_id") == a) & (F.col("next_page_id") == b)).alias(f"pair_{step}")
            for step, a, b in target_pairs(flow)
        ],
    )


def page_pair_counts(following: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    cells = [
        F.struct(F.lit(step).alias("step"), F.lit(f"{a}_{b}").alias("pair"),
                 F.col(f"pair_{step}").alias("pair_count"))
        for step, a, b in target_pairs(flow)
    ]
    return _flow_totals(following, flow).select(F.inline(F.array(*cells)))


def page_convert_rates(following: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """Chained rates: the first pair over the first page's actions, each next pair over its
    predecessor. A pair that never occurs has rate 0 and leaves the next rate null."""
    cells = []
    for step, a, b in target_pairs(flow):
        before = F.col("start_count") if step == 1 else F.col(f"pair_{step - 1}")
        rate = F.col(f"pair_{step}") / F.nullif(before, F.lit(0))
        cells.append(F.struct(
            F.lit(step).alias("step"), F.lit(f"{a}_{b}").alias("pair"),
            F.col(f"pair_{step}").alias("pair_count"), rate.alias("rate"),
        ))
    return _flow_totals(following, flow).select(F.inline(F.array(*cells)))


def page_convert_string(rates: DataFrame, digits: int | None = None) -> DataFrame:
    """All rates in one string, ``1_2=r|2_3=r…``, in flow order (one row per step goes in)."""
    rate = F.col("rate")
    if digits is not None:
        rate = F.round(rate, digits).cast(f"decimal(20,{digits})")
    text = F.concat("pair", F.lit("="), F.coalesce(rate.cast("string"), F.lit("")))
    steps = F.array_sort(F.collect_list(F.struct("step", text.alias("text"))))
    return rates.agg(F.array_join(F.transform(steps, lambda s: s["text"]), "|").alias("convertRate"))
