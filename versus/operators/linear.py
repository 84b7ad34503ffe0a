"""Linear classifiers by stochastic subgradients of the hinge loss, one against the rest.

An epoch passes the rows in batches that a hash of the id and the seed fixes. In a step every task
turns its rows of the batch into one partial sum of subgradients (classes x dimensions numbers), the
sums are added up by Spark, and the weights, which have a fixed size, go out with the next step.
Nothing depends on how rows are dealt over tasks but the rounding of sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versus.session import materialize

ALPHA = 1e-4
EPOCHS = 5
BATCHES = 8


def batch_of(by: str = "id", seed: int = 42, batches: int = BATCHES) -> Column:
    digest = F.md5(F.concat(F.col(by).cast("string"), F.lit(f":{seed}:batch")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % batches).cast("int")


def rate(step: int, alpha: float = ALPHA) -> float:
    """The learning rate of a step: 1 / (alpha (start + step)), which begins near 1."""
    return 1.0 / (alpha * (1.0 / alpha + step))


def fit_hinge(
    rows: DataFrame,
    dim: int,
    classes: list[int],
    alpha: float = ALPHA,
    epochs: int = EPOCHS,
    batches: int = BATCHES,
    seed: int = 42,
) -> np.ndarray:
    """Weights (classes, dim + 1), the intercept last, which is not shrunk; ``rows`` have id,
    features and label. A batch without rows only shrinks the weights."""
    stored = materialize(
        rows.select("features", "label", batch_of("id", seed, batches).alias("batch")), partition_by=("batch",)
    )
    weights = np.zeros((len(classes), dim + 1))
    target = np.array(classes)

    for step in range(epochs * batches):

        def partial(parts: Iterator[pd.DataFrame], weights: np.ndarray = weights) -> Iterator[pd.DataFrame]:
            total, n = np.zeros_like(weights), 0
            for part in parts:
                if not len(part):
                    continue
                x = np.column_stack([np.stack(part["features"].to_numpy()), np.ones(len(part))])
                y = np.where(part["label"].to_numpy()[:, None] == target, 1.0, -1.0)
                inside = y * (x @ weights.T) < 1.0
                total += (y * inside).T @ x
                n += len(part)
            values = np.append(total.ravel(), n)
            yield pd.DataFrame({"i": np.arange(len(values)), "v": values})

        sums = (
            stored.where(F.col("batch") == step % batches)
            .select("features", "label")
            .mapInPandas(partial, "i int, v double")
            .groupBy("i")
            .agg(F.sum("v").alias("v"))
            .collect()  # classes x dimensions numbers
        )
        values = np.zeros(weights.size + 1)
        for r in sums:
            values[r["i"]] = r["v"]
        eta = rate(step, alpha)
        shrunk = weights * (1.0 - eta * alpha)
        shrunk[:, -1] = weights[:, -1]
        weights = shrunk + eta * values[:-1].reshape(weights.shape) / max(values[-1], 1.0)
    return weights


def weight_table(rows: DataFrame, weights: np.ndarray, classes: list[int]) -> DataFrame:
    """(class, weights): one row per class, for storage and prediction."""
    data = [(c, [float(x) for x in w]) for c, w in zip(classes, weights, strict=True)]
    return rows.sparkSession.createDataFrame(data, "class int, weights array<double>")


def predict(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(id, pred): the class with the largest margin, rounded to 9 digits; ties to the smaller one."""
    models = model.agg(F.array_sort(F.collect_list(F.struct("class", "weights"))).alias("m")).scalar()

    def margin(m: Column) -> Column:
        products = F.zip_with(F.concat("features", F.array(F.lit(1.0))), m["weights"], lambda a, b: a * b)
        return F.round(F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v), 9)

    scored = F.transform("__m", lambda m: F.struct(margin(m).alias("margin"), (-m["class"]).alias("c")))
    return rows.withColumn("__m", models).select("id", (-F.array_max(scored)["c"]).alias("pred"))
