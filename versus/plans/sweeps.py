"""Parameter sweeps as one job each.

Matches are counted once. Rows that agree in everything a metric reads (match counts, lengths,
label) are merged into one weighted profile before the parameters are unfolded, so the unfolded
volume depends on the number of distinct profiles, not on the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versus.functions import bleu as B
from versus.functions.expr import let
from versus.functions.metrics import meteor, preference

TECHNIQUES = (4, 5, 6, 7)


def fractions(start: int, stop: int, step: int, divisor: int) -> Column:
    """The doubles start/divisor, (start+step)/divisor, … below stop/divisor, as an array."""
    last = F.lit(stop - 1 - (stop - 1 - start) % step)
    return F.transform(
        F.sequence(F.lit(start), last, F.lit(step)),
        lambda i: i.cast("double") / F.lit(float(divisor)),
    )


def profiles(counts: DataFrame, gold: DataFrame, on: str) -> DataFrame:
    """Weighted distinct profiles of the labelled rows."""
    labelled = counts.join(gold, on)
    keys = [
        c
        for c in labelled.columns
        if c == "gold" or c.endswith(("_hits", "_len", "_match"))
    ]
    return labelled.groupBy(*keys).agg(F.count(F.lit(1)).alias("weight"))


def _accuracy_by(judged: DataFrame, by: list[str]) -> DataFrame:
    right = F.when(F.col("pred") == F.col("gold"), F.col("weight")).otherwise(0)
    known = F.when(F.col("pred").isNotNull(), F.col("weight")).otherwise(0)
    return (
        judged.groupBy(*by)
        .agg(
            F.sum(known).alias("n_judged"),
            F.sum(right).alias("n_right"),
            F.sum(F.col("weight") - known).alias("n_undefined"),
        )
        .withColumn("accuracy", F.try_divide(F.col("n_right"), F.col("n_judged")))
    )


def meteor_alpha_sweep(overlaps: DataFrame, gold: DataFrame, on: str, alphas: Column) -> DataFrame:
    """(alpha, accuracy, …) for every alpha of the array."""
    rows = profiles(overlaps, gold, on).withColumn("alpha", F.explode(alphas))
    scores = [
        meteor(F.col(f"{h}_hits"), F.col(f"{h}_len"), F.col("ref_len"), F.col("alpha"))
        for h in ("h1", "h2")
    ]
    return _accuracy_by(rows.withColumn("pred", preference(*scores)), ["alpha"])


def _apart(score: Column) -> Column:
    """Keep a long expression out of the stage's generated method, which has a size limit.

    Only distinct profiles pass here, so the slower evaluation does not matter.
    """
    return let(F.lit(0), lambda _: score)


def _unfold(rows: DataFrame, name: str, scores: dict[object, tuple[Column, Column]]) -> DataFrame:
    """One output row per (input row, parameter)."""
    entries = [
        F.struct(
            F.lit(key).alias(name),
            _apart(first).alias("h1_score"),
            _apart(second).alias("h2_score"),
        )
        for key, (first, second) in scores.items()
    ]
    out = rows.select("gold", "weight", F.inline(F.array(*entries)))
    return out.withColumn("pred", preference(F.col("h1_score"), F.col("h2_score")))


def bleu_order_sweep(
    counts: DataFrame, gold: DataFrame, on: str, orders: range = range(1, 5)
) -> DataFrame:
    """Unsmoothed BLEU with each maximum order."""
    scores = {
        n: tuple(B.bleu(B.Precisions(h, max_n=n)) for h in ("h1", "h2")) for n in orders
    }
    return _accuracy_by(_unfold(profiles(counts, gold, on), "max_n", scores), ["max_n"])


def bleu_weight_sweep(
    counts: DataFrame, gold: DataFrame, on: str, settings: list[tuple[float, ...]]
) -> DataFrame:
    """Weighted BLEU with each tuple of weights."""
    scores = {
        i: tuple(
            B.bleu_weighted(B.Precisions(h, max_n=len(w)), list(w)) for h in ("h1", "h2")
        )
        for i, w in enumerate(settings)
    }
    return _accuracy_by(_unfold(profiles(counts, gold, on), "setting", scores), ["setting"])


def bleu_smoothing_sweep(
    counts: DataFrame,
    gold: DataFrame,
    on: str,
    techniques: tuple[int, ...] = TECHNIQUES,
    epsilon: float = 0.1,
    alpha: float = 5.0,
    k: float = 5.0,
    max_n: int = 4,
    smooth_h1: int | None = None,
) -> DataFrame:
    """Smoothed BLEU with each technique, on both hypotheses or only on the second."""

    def score(h: str, technique: int) -> Column:
        return B.bleu_smoothed(B.Precisions(h, max_n=max_n), technique, epsilon, alpha, k)

    scores = {
        t: (score("h1", t if smooth_h1 is None else smooth_h1), score("h2", t))
        for t in techniques
    }
    return _accuracy_by(_unfold(profiles(counts, gold, on), "technique", scores), ["technique"])


def best_settings(sweep: DataFrame, n: int = 10, tie: str = "alpha") -> DataFrame:
    """The ``n`` most accurate rows; ties keep the order of ``tie``."""
    return sweep.orderBy(F.desc("accuracy"), F.asc(tie)).limit(n)
