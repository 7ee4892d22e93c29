"""Small fixed dimensions. Their size is the length of the lists below, so they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# City id, city name, area.
CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

# Course id, course name.
COURSES = [
    (112, "spark in action"),
    (128, "spark streaming"),
    (130, "deep learning"),
    (131, "spark"),
    (145, "Hbase in action"),
    (146, "machine learning"),
]


def cities(spark: SparkSession) -> DataFrame:
    return F.broadcast(
        spark.createDataFrame(CITIES, "city_id BIGINT, city_name STRING, area STRING")
    )


def courses(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(COURSES, "course_id INT, name STRING"))
