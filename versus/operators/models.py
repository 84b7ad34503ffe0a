"""Preference models on MLlib: scaling, selection, classifiers, cross-validated search, storage."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Binarizer,
    MinMaxScaler,
    Normalizer,
    UnivariateFeatureSelector,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
# Rows of a task in a search: fits take hundreds of passes, so small tables must not be cut further.
SEARCH_ROWS = 20_000
HIDDEN_UNITS = 100


def to_ml(df: DataFrame, classes: list[int] | None = None) -> DataFrame:
    """Array features to vectors; ``label`` to its 0-based class index ``y`` where present."""
    out = df.withColumn("features", array_to_vector("features"))
    if classes is None:
        return out
    index = F.array(*[F.lit(c) for c in classes])
    return out.withColumn("y", (F.array_position(index, F.col("label")) - 1).cast("double"))


def from_ml(df: DataFrame, classes: list[int]) -> DataFrame:
    """``prediction`` back to the class it stands for, as ``pred``."""
    index = F.array(*[F.lit(c) for c in classes])
    return df.withColumn("pred", F.get(index, F.col("prediction").cast("int")))


def preparation(percentile: float | None = None) -> list:
    """Min-max scaling and unit length, then ANOVA selection of a share of the features."""
    stages = [
        MinMaxScaler(inputCol="features", outputCol="scaled"),
        Normalizer(p=2.0, inputCol="scaled", outputCol="unit"),
    ]
    if percentile is not None:
        stages.append(selector(percentile))
    return stages


def selector(percentile: float) -> UnivariateFeatureSelector:
    """``percentile`` is a fraction of the features."""
    out = UnivariateFeatureSelector(
        featuresCol="unit", labelCol="y", outputCol="chosen", selectionMode="percentile"
    )
    return (
        out.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(percentile)
    )


def classifier(
    kind: str,
    dim: int,
    n_classes: int,
    features: str = "unit",
    max_iter: int = 100,
    n_trees: int = 100,
) -> Estimator:
    """One classifier by name; ``*_ovr`` is one classifier per class against the rest."""
    cols = {"featuresCol": features, "labelCol": "y"}
    svc = LinearSVC(**cols, maxIter=max_iter, regParam=0.01)

    def network(outputs: int) -> MultilayerPerceptronClassifier:
        return MultilayerPerceptronClassifier(
            **cols, layers=[dim, HIDDEN_UNITS, outputs], maxIter=max_iter, seed=SEED
        )

    if kind == "decision_tree":
        return DecisionTreeClassifier(**cols, seed=SEED)
    if kind == "random_forest":
        return RandomForestClassifier(**cols, numTrees=n_trees, seed=SEED)
    if kind == "mlp":
        return network(n_classes)
    if kind == "linear_svc":
        return OneVsRest(classifier=svc, **cols)
    if kind == "tree_ovr":
        # A probabilistic score ranks the classes; a single tree is a forest of one.
        tree = RandomForestClassifier(
            **cols, numTrees=1, featureSubsetStrategy="all", bootstrap=False, seed=SEED
        )
        return OneVsRest(classifier=tree, **cols)
    if kind == "mlp_ovr":
        return OneVsRest(classifier=network(2), **cols)
    raise ValueError(f"unknown classifier {kind!r}")


def pipeline(kind: str, dim: int, n_classes: int, percentile: float | None = None) -> Pipeline:
    stages = preparation(percentile)
    features = "unit" if percentile is None else "chosen"
    return Pipeline(stages=[*stages, classifier(kind, dim, n_classes, features)])


def bernoulli_nb() -> Pipeline:
    """Bernoulli naive Bayes on the signs of the features."""
    return Pipeline(
        stages=[
            Binarizer(threshold=0.0, inputCol="features", outputCol="signs"),
            NaiveBayes(featuresCol="signs", labelCol="y", modelType="bernoulli"),
        ]
    )


def train_and_predict(
    estimator: Estimator, train: DataFrame, rows: DataFrame, classes: list[int]
) -> DataFrame:
    """Fit on (features, label), predict (id, features): gives (id, pred)."""
    model = estimator.fit(to_ml(train, classes))
    return predict(model, rows, classes)


def predict(model, rows: DataFrame, classes: list[int], refit_scaling: bool = False) -> DataFrame:
    """(id, pred). ``refit_scaling`` scales the rows by their own range, not the training range."""
    data = to_ml(rows)
    if refit_scaling:
        stages = [
            MinMaxScaler(inputCol="features", outputCol="scaled").fit(data)
            if type(stage).__name__ == "MinMaxScalerModel"
            else stage
            for stage in model.stages
        ]
        model = PipelineModel(stages=stages)
    return from_ml(model.transform(data), classes).select("id", "pred")


def one_vs_one(
    train: DataFrame, rows: DataFrame, classes: list[int], max_iter: int = 100
) -> DataFrame:
    """A linear SVC per pair of classes; most votes win, ties go to the smallest class.

    The fits are a few; every prediction is one pass, and the votes are counted per row.
    """
    prep = Pipeline(stages=preparation()).fit(to_ml(train, classes))
    scaled = prep.transform(to_ml(train, classes)).select("id", "unit", "label")
    asked = prep.transform(to_ml(rows)).select("id", "unit")
    votes = []
    for low, high in combinations(classes, 2):
        pair = scaled.where(F.col("label").isin(low, high)).select(
            "unit", (F.col("label") == high).cast("double").alias("y")
        )
        model = LinearSVC(featuresCol="unit", labelCol="y", maxIter=max_iter, regParam=0.01).fit(pair)
        picked = F.when(F.col("prediction") == 1.0, high).otherwise(low)
        votes.append(model.transform(asked).select("id", picked.alias("label")))
    tally = reduce(DataFrame.unionAll, votes).groupBy("id", "label").agg(F.count(F.lit(1)).alias("v"))
    best = F.max_by("label", F.struct(F.col("v"), -F.col("label")))
    return tally.groupBy("id").agg(best.alias("pred"))


def _macro(counts: np.ndarray, axis: int) -> float:
    """Mean over the classes that occur of right answers among those given (axis 0) or due (1)."""
    right, total = np.diag(counts), counts.sum(axis)
    seen = counts.sum(0) + counts.sum(1) > 0
    return float(np.where(total > 0, right / np.maximum(total, 1), 0.0)[seen].mean()) if seen.any() else 0.0


#: Scores of a search, from (truth, prediction) counts as a square array.
METRICS: dict[str, Callable[[np.ndarray], float]] = {
    "accuracy": lambda c: float(np.trace(c) / max(c.sum(), 1)),
    "macro_precision": lambda c: _macro(c, 0),
    "macro_recall": lambda c: _macro(c, 1),
}


def search(
    folded: DataFrame,
    classes: list[int],
    settings: dict[str, Estimator],
    metrics: tuple[str, ...] = ("accuracy",),
    parallelism: int = 8,
) -> tuple[list[tuple[str, str, float, float]], PipelineModel, str]:
    """Every setting fitted on all folds but one and scored on that one; then the best setting by
    the first metric (ties: the first) refitted on all rows. Settings work on the column ``unit``:
    scaling is fitted once per fold, on the fold's training rows.

    Gives rows of (setting, metric, mean, std over folds), the refitted model and its setting.
    A fit is a Spark job of its own; ``parallelism`` of them run at a time. Each returns
    classes x classes counts. ``folded`` is read for every fit: store it.
    """
    data = to_ml(folded, classes)
    n_folds = folded.agg(F.max("fold")).first()[0] + 1
    tasks = max(1, -(-folded.count() // SEARCH_ROWS))
    prepared = Pipeline(stages=preparation())
    kept = ["y", "unit", "fold"]
    parts = []
    for fold in range(n_folds):
        ready = prepared.fit(data.where(F.col("fold") != fold)).transform(data).select(*kept)
        parts.append(ready.coalesce(tasks).persist())  # read by every setting; lost blocks are worked out again

    def one(fold: int, name: str) -> tuple[str, np.ndarray]:
        model = settings[name].fit(parts[fold].where(F.col("fold") != fold))
        held = parts[fold].where(F.col("fold") == fold)
        rows = model.transform(held).groupBy("y", "prediction").count().collect()
        counts = np.zeros((len(classes), len(classes)))
        for r in rows:
            counts[int(r["y"]), int(r["prediction"])] += r["count"]
        return name, counts

    scores: dict[str, list[np.ndarray]] = {name: [] for name in settings}
    jobs = [(fold, name) for fold in range(n_folds) for name in settings]
    with ThreadPoolExecutor(parallelism) as pool:
        for name, counts in pool.map(lambda job: one(*job), jobs):
            scores[name].append(counts)
    for part in parts:
        part.unpersist()
    out = []
    for name, found in scores.items():
        for metric in metrics:
            values = [METRICS[metric](c) for c in found]
            out.append((name, metric, float(np.mean(values)), float(np.std(values))))
    first = [r for r in out if r[1] == metrics[0]]
    best = max(first, key=lambda r: r[2])[0]
    first_stages = prepared.fit(data)
    last = settings[best].fit(first_stages.transform(data))
    return out, PipelineModel(stages=[first_stages, last]), best


def tree_settings(classes: list[int], percentiles: tuple[int, ...]) -> dict[str, Estimator]:
    """A decision tree on each share (in percent) of the features."""
    return {
        str(p): Pipeline(
            stages=[selector(p / 100.0), classifier("decision_tree", 0, len(classes), "chosen")]
        )
        for p in percentiles
    }


def svc_settings(costs: tuple[float, ...], max_iter: int = 100) -> dict[str, Estimator]:
    """Linear SVCs, one against the rest, at each cost."""
    cols = {"featuresCol": "unit", "labelCol": "y"}
    return {
        str(c): OneVsRest(classifier=LinearSVC(**cols, maxIter=max_iter, regParam=1.0 / c), parallelism=3, **cols)
        for c in costs
    }


def best_setting(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.max_by("setting", "mean").alias("setting"), F.max("mean").alias("mean")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
