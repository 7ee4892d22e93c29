"""Task parameters: what a user of the batch jobs may restrict."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Field names of the JSON task description (fixed values).
JSON_FIELDS = (
    "startDate", "endDate", "startAge", "endAge", "professionals",
    "cities", "sex", "keywords", "categoryIds", "targetPageFlow",
)


@dataclass(frozen=True)
class TaskParams:
    """An unset parameter (None or empty) does not restrict anything."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = field(default=(1, 2, 3, 4, 5, 6, 7))


def task_params_from_json(spark: SparkSession, text: str) -> TaskParams:
    """Read a JSON task description; field names may be unquoted, ``""`` means unset."""
    schema = ", ".join(f"{name} STRING" for name in JSON_FIELDS)
    options = {"allowUnquotedFieldNames": "true", "mode": "FAILFAST"}
    row = (
        spark.range(1)
        .select(F.from_json(F.lit(text), schema, options).alias("p"))
        .select(*[F.nullif(F.trim(f"p.{name}"), F.lit("")).alias(name) for name in JSON_FIELDS])
        .first()
    )

    def items(name: str) -> tuple[str, ...]:
        return tuple(part.strip() for part in row[name].split(",")) if row[name] else ()

    def number(name: str) -> int | None:
        return int(row[name]) if row[name] else None

    return TaskParams(
        start_date=row["startDate"],
        end_date=row["endDate"],
        start_age=number("startAge"),
        end_age=number("endAge"),
        professionals=items("professionals"),
        cities=items("cities"),
        sex=row["sex"],
        keywords=items("keywords"),
        category_ids=tuple(int(i) for i in items("categoryIds")),
        target_page_flow=tuple(int(i) for i in items("targetPageFlow")),
    )
