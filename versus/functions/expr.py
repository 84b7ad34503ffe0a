"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def r6(value: Column) -> Column:
    return F.round(value, 6)
