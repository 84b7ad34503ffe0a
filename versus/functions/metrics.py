"""Word overlap, simple METEOR and the three-way preference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def preference(first: Column, second: Column) -> Column:
    """1 when the first score is higher, 0 on a tie, -1 otherwise; NULL when a score is NULL."""
    return (
        F.when(first.isNull() | second.isNull(), F.lit(None).cast("int"))
        .when(first > second, 1)
        .when(first == second, 0)
        .otherwise(-1)
    )


def meteor(hits: Column, hyp_len: Column, ref_len: Column, alpha: Column | float = 0.1) -> Column:
    """Weighted harmonic mean of precision and recall of matched words.

    The order of operations is part of the result: ties are decided on exact doubles.
    """
    a = F.lit(alpha) if isinstance(alpha, (int, float)) else alpha
    p = hits.cast("double") / hyp_len.cast("double")
    r = hits.cast("double") / ref_len.cast("double")
    return F.when(hits == 0, F.lit(0.0)).otherwise((p * r) / ((F.lit(1.0) - a) * r + a * p))


def accuracy_of(gold: Column, pred: Column) -> Column:
    return F.avg((gold == pred).cast("double"))
