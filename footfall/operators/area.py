"""Product popularity by area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.sql_functions import concat_long_string, group_concat_distinct
from footfall.operators.ranking import top_per_group


def area_click_detail(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with city and area; clicks of unknown cities are dropped."""
    return clicks.join(cities, "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("pid")
    )


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Click count and city list per area and product.

    Clicks are counted per city and product before the dimension is joined, so the
    join and the distinct list see one row per city and product instead of every click.
    """
    per_city = clicks.groupBy("city_id", "click_product_id").agg(F.count("*").alias("n"))
    info = concat_long_string(F.col("city_id"), F.col("city_name"))
    return (
        per_city.join(cities, "city_id")
        .groupBy("area", F.col("click_product_id").alias("pid"))
        .agg(F.sum("n").alias("click_count"), group_concat_distinct(info).alias("city_infos"))
    )


def top_area_products(area_clicks: DataFrame, k: int = 3) -> DataFrame:
    return top_per_group(area_clicks, ["area"], [F.desc("click_count"), F.asc("pid")], k)
