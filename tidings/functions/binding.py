"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` worked out once per row.

    A column used in several places of an expression is copied into each of them, and nested
    copies multiply into code too large to compile. A one-element transform keeps one copy."""
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """`frame` with `value` as a new column that is worked out once a row. Spark moves filters down
    past plain columns and copies their expressions into the filter; past an explode it does not."""
    return frame.select("*", F.explode(F.array(value)).alias(name))
