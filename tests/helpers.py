from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ACTION_FIELDS = (
    "date STRING, user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING, "
    "search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT, "
    "order_category_ids STRING, pay_category_ids STRING, city_id BIGINT, event_id BIGINT"
)


def actions(spark: SparkSession, *rows: dict) -> DataFrame:
    """Actions with the given fields set; the others say "no action of this kind"."""
    full = []
    for i, row in enumerate(rows):
        full.append((
            row.get("date", "2024-01-01"), row.get("user", 1), row.get("session", "s"),
            row.get("page", 0), row.get("time", "2024-01-01 10:00:00"), row.get("keyword"),
            row.get("click", -1), row.get("product", -1), row.get("order"), row.get("pay"),
            row.get("city", 0), row.get("id", i),
        ))
    return spark.createDataFrame(full, ACTION_FIELDS)


def users(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Users as (user_id, age, professional, city, sex)."""
    return spark.createDataFrame(
        rows, "user_id BIGINT, age INT, professional STRING, city STRING, sex STRING"
    )


def lines(spark: SparkSession, *values: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Sorted plain rows."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(v) for v in r))


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
