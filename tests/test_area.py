from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from footfall.functions import sql_functions
from footfall.operators import area
from footfall.sources.dims import cities
from tests.helpers import rows


def _clicks(spark):
    data = [(0, 5)] * 3 + [(1, 5)] * 2 + [(2, 5)] + [(2, 6)] * 4 + [(1, 7)] + [(1, 8)] + [(77, 5)]
    return spark.createDataFrame(data, "city_id BIGINT, click_product_id BIGINT")


def test_detail_drops_unknown_cities(spark):
    detail = area.area_click_detail(_clicks(spark), cities(spark))
    assert detail.count() == 12
    assert rows(detail.filter("pid = 6").distinct()) == [(2, "南京", "华东", 6)]


def test_product_clicks(spark):
    got = rows(area.area_product_clicks(_clicks(spark), cities(spark)))
    assert got == sorted([
        ("华北", 5, 3, "0:北京"), ("华东", 5, 3, "1:上海,2:南京"), ("华东", 6, 4, "2:南京"),
        ("华东", 7, 1, "1:上海"), ("华东", 8, 1, "1:上海"),
    ], key=lambda r: tuple(map(str, r)))


def test_top_products_break_ties_by_id(spark):
    top = area.top_area_products(area.area_product_clicks(_clicks(spark), cities(spark)))
    assert rows(top.filter("area = '华东'"), "pid") == [(5,), (6,), (7,)]


def test_group_concat_is_exact(spark):
    df = spark.createDataFrame(
        [("g", v) for v in ("11:x", "1:x", "1:x", "", None, "2:y")] + [("empty", None)],
        "g STRING, v STRING",
    )
    got = df.groupBy("g").agg(sql_functions.group_concat_distinct(F.col("v")).alias("v"))
    assert rows(got) == [("empty", ""), ("g", "11:x,1:x,2:y")]


def test_sql_functions(spark):
    sql_functions.register(spark)
    area.area_click_detail(_clicks(spark), cities(spark)).createOrReplaceTempView("detail")
    got = spark.sql("""
        SELECT area, pid, count(*) AS click_count,
               group_concat_distinct(collect_set(concat_long_string(city_id, city_name, ':')))
                 AS city_infos
        FROM detail GROUP BY area, pid
    """)
    assert rows(got) == rows(area.area_product_clicks(_clicks(spark), cities(spark)))


def test_statement_with_an_aggregate_call(spark):
    """The report's statement as SQL users write it, without collecting anything themselves."""
    sql_functions.register(spark)
    area.area_click_detail(_clicks(spark), cities(spark)).createOrReplaceTempView("detail")
    statement = """
        SELECT area, pid, count(*) AS click_count, -- group_concat_distinct(x)
               Group_Concat_Distinct (concat_long_string(city_id, city_name, ':')) AS city_infos
        FROM detail GROUP BY area, pid
    """
    with pytest.raises(AnalysisException):
        spark.sql(statement)
    got = spark.sql(sql_functions.with_aggregates(statement))
    assert rows(got) == rows(area.area_product_clicks(_clicks(spark), cities(spark)))


def test_only_bare_aggregate_calls_change():
    same = ["SELECT (a) FROM t", "SELECT group_concat_distinct( collect_set(x)) FROM t",
            "SELECT 'it\\'s group_concat_distinct(x)', `group_concat_distinct(` FROM t",
            "SELECT 1 /* group_concat_distinct(x) */", "SELECT my_group_concat_distinct(x)", ""]
    assert [sql_functions.with_aggregates(s) for s in same] == same
    assert sql_functions.with_aggregates(
        "SELECT group_concat_distinct(concat(a, ')', f(b))), max((c)) FROM t"
    ) == "SELECT group_concat_distinct(collect_set(concat(a, ')', f(b)))), max((c)) FROM t"
