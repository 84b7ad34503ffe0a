"""Min-max scaling, row normalisation and ANOVA feature scores on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versus.functions.vectors import l2_normalize


def fit_minmax(df: DataFrame, dim: int, col: str = "features") -> Column:
    """Per-dimension minima and ranges, as a one-value subquery."""
    return df.agg(
        F.struct(
            F.array(*[F.min(F.get(col, F.lit(i))) for i in range(dim)]).alias("low"),
            F.array(
                *[F.max(F.get(col, F.lit(i))) - F.min(F.get(col, F.lit(i))) for i in range(dim)]
            ).alias("span"),
        ).alias("fit")
    ).scalar()


def minmax_scale(df: DataFrame, fit: Column, col: str = "features") -> DataFrame:
    """Scale to [0, 1] by a fit; a constant dimension becomes 0."""
    fitted = df.withColumn("__fit", fit)
    shifted = F.zip_with(col, F.col("__fit")["low"], lambda v, low: v - low)
    scaled = F.zip_with(
        shifted, F.col("__fit")["span"], lambda v, s: F.coalesce(F.try_divide(v, s), F.lit(0.0))
    )
    return fitted.withColumn(col, scaled).drop("__fit")


def scale_and_normalize(df: DataFrame, dim: int, fit: Column | None = None) -> DataFrame:
    """Min-max scaling (fitted on ``df`` itself unless a fit is given), then unit length."""
    scaled = minmax_scale(df, fit_minmax(df, dim) if fit is None else fit)
    return scaled.withColumn("features", l2_normalize(F.col("features")))


def anova_f(df: DataFrame, label: str = "label", col: str = "features") -> DataFrame:
    """(dim, f): between-class over within-class variance of every dimension; null where there is
    one class only, or a class for every row, or no variance inside the classes."""
    values = df.select(label, F.posexplode(col).alias("dim", "v"))
    v = F.col("v")
    classes = values.groupBy("dim", label).agg(
        F.count(v).alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("ss")
    )
    per_dim = classes.groupBy("dim").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum("s").alias("s"),
        F.sum("ss").alias("ss"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"),
    )
    correction = F.col("s") * F.col("s") / F.col("n")
    between = F.try_divide(F.col("between") - correction, F.col("k") - 1)
    within = F.try_divide(F.col("ss") - F.col("between"), F.col("n") - F.col("k"))
    return per_dim.select("dim", F.try_divide(between, within).alias("f"))


def anova_select(scores: DataFrame, percentile: float) -> DataFrame:
    """(dim, f) of the best ``percentile`` percent of dimensions."""
    if percentile >= 100:
        return scores
    threshold = scores.agg(
        F.percentile("f", F.lit((100.0 - percentile) / 100.0)).alias("t")
    ).scalar()
    return scores.where(F.col("f") > threshold)


def project(df: DataFrame, selected: DataFrame, col: str = "features") -> DataFrame:
    """Keep the selected dimensions, in order."""
    dims = selected.agg(F.sort_array(F.collect_list("dim")).alias("dims")).scalar()
    out = df.withColumn("__dims", dims)
    return out.withColumn(col, F.transform("__dims", lambda i: F.get(col, i))).drop("__dims")
