"""Expressions that take values out of log lines.

A value that cannot be read becomes null; the operators decide what to drop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_fields(
    lines: DataFrame, separator: str, fields: dict[str, Callable[[Callable[[int], Column]], Column]]
) -> DataFrame:
    """Split every line once and derive the named fields from its parts.

    ``inline`` stands between the fields and later filters: without it Catalyst moves a filter on
    a field below the projection and evaluates the parsing expressions again for it.
    """
    parts = lines.select(F.split("value", separator).alias("parts"))

    def part(i: int) -> Column:
        return F.get("parts", F.lit(i))

    row = F.struct(*[derive(part).alias(name) for name, derive in fields.items()])
    return parts.select(F.inline(F.array(row)))


def action_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, each field but the year with one digit or two.

    Other forms (zoned, fractional, a bare date, a ``T`` in between) are no such time.
    """
    return F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s"))


def format_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def day_key(day: Column) -> Column:
    """A date or time as ``yyyyMMdd``."""
    return F.date_format(day, "yyyyMMdd")


def course_id(request: Column) -> Column:
    """Course number in a quoted request line; 0 for pages that are not class pages.

    ``"GET /class/<number>.html HTTP/1.1"``: the third part of the path without its extension.
    """
    url = F.get(F.split(request, " "), F.lit(1))
    page = F.get(F.split(url, "/"), F.lit(2))
    number = F.regexp_extract(page, r"^(.*)\.[^.]*$", 1).try_cast("int")
    return F.when(url.startswith("/class"), number).otherwise(F.lit(0))


def referer_host(referer: Column) -> Column:
    """Host of a referer that names more than a host; null for any other referer."""
    collapsed = F.regexp_replace(F.replace(referer, F.lit("//"), F.lit("/")), "/+$", "")
    parts = F.split(collapsed, "/")
    return F.when(F.size(parts) > 2, blank_to_null(F.get(parts, F.lit(1))))
