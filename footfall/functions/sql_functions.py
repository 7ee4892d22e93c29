"""String functions of the area report, for DataFrames and for SQL text."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def concat_long_string(number: Column, text: Column, separator: str = ":") -> Column:
    return F.concat_ws(separator, number.cast("string"), text)


def group_concat_distinct(text: Column, separator: str = ",") -> Column:
    """Aggregate: the distinct non-empty values of a group in order, as one string.

    Duplicates are dropped on the map side, so a group ships its distinct values only.
    """
    return F.array_join(F.array_sort(F.collect_set(F.nullif(text, F.lit("")))), separator)


def register(spark: SparkSession) -> None:
    """Offer the functions to SQL text. Both are inlined by Catalyst, no Python is run.

    ``concat_long_string(id, name, ':')`` is a scalar function. ``group_concat_distinct`` takes
    the collected group: ``group_concat_distinct(collect_set(x))``, since SQL text cannot define
    aggregates. ``with_aggregates`` turns a statement that has ``group_concat_distinct(x)`` into
    one that Spark can run; a text column without either fails when the statement is analysed. In
    one word, but without dropping empty values:
    ``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``.
    """
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, sep STRING)
        RETURNS STRING
        RETURN concat_ws(sep, CAST(v1 AS STRING), v2)
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION group_concat_distinct(items ARRAY<STRING>)
        RETURNS STRING
        RETURN array_join(array_sort(array_remove(array_distinct(items), '')), ',')
    """)


# A literal, a quoted name or a comment, which are left as they are; the call; or a parenthesis.
_TOKENS = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
    r"""|\bgroup_concat_distinct\s*\(|[()]""", re.IGNORECASE | re.DOTALL)
_COLLECTED = re.compile(r"\s*collect_(?:set|list)\s*\(", re.IGNORECASE)


def with_aggregates(statement: str) -> str:
    """The statement with every ``group_concat_distinct(x)`` over the collected group.

    ``x`` becomes ``collect_set(x)``, so Spark drops duplicates on the map side. Calls that already
    collect stay, and so does whatever stands in literals, quoted names and comments.
    """
    out, open_calls, done = [], [], 0
    for token in _TOKENS.finditer(statement):
        text = token.group()
        if text == ")" and open_calls:
            if open_calls.pop():
                out += [statement[done:token.start()], ")"]
                done = token.start()
        elif text.endswith("(") and not text.startswith(("'", '"', "`", "-", "/")):
            wraps = len(text) > 1 and not _COLLECTED.match(statement, token.end())
            open_calls.append(wraps)
            if wraps:
                out += [statement[done:token.end()], "collect_set("]
                done = token.end()
    return "".join(out) + statement[done:]
