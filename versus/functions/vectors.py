"""Array-of-double expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleave(first: Column, second: Column, third: Column | None = None) -> Column:
    """a0, b0, (c0,) a1, b1, (c1,) …; as long as the shortest input."""
    if third is None:
        length = F.least(F.size(first), F.size(second))
        pairs = F.zip_with(first, second, lambda a, b: F.array(a, b))
        return F.slice(F.flatten(pairs), F.lit(1), length * 2)
    length = F.least(F.size(first), F.size(second), F.size(third))
    pairs = F.zip_with(first, second, lambda a, b: F.array(a, b))
    triples = F.zip_with(pairs, third, lambda p, c: F.concat(p, F.array(c)))
    return F.slice(F.flatten(F.slice(triples, F.lit(1), length)), F.lit(1), length * 3)


def first_n(vec: Column, n: int) -> Column:
    return F.slice(vec, 1, n)


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v
    )


def l2_normalize(vec: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, v: acc + v * v))
    safe = F.when(norm == 0, F.lit(1.0)).otherwise(norm)
    return F.transform(vec, lambda v: v / safe)
