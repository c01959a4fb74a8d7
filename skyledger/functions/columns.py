"""Helpers for writing column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def no_strings() -> Column:
    return F.expr("cast(array() as array<string>)")


def once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is worked out once per row. Catalyst moves a filter below a projection and repeats there the expressions
    of the columns it tests; below a generated column it cannot go."""
    return rows.select("*", F.explode(F.array(value)).alias(name))
