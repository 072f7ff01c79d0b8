"""Evaluate a costly expression once inside a larger one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row.

    Spark does not share subexpressions inside CASE branches and lambdas. A
    one-element array gives the value a name there.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
