"""Forests, hinge loss, the stored neighbour classifier, stored stages, restarts, odd input."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from versus.operators import bitmap as B
from versus.operators import embed as EM
from versus.operators import forest as T
from versus.operators import knn as K
from versus.operators import knn_model as KM
from versus.operators import linear as L
from versus.operators import scaling as SC
from versus.operators.lookup import lookup
from versus.streaming import judge_stream as JS

ROWS = "id long, features array<double>, label int"


def clusters(spark, n=120, dim=6, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    own = rng.integers(0, classes, n)
    x = 3.0 * rng.normal(size=(classes, dim))[own] + 0.5 * rng.normal(size=(n, dim))
    return spark.createDataFrame(
        [(i, [float(v) for v in row], int(c)) for i, (row, c) in enumerate(zip(x, own, strict=True))], ROWS
    )


def cells(df, train="id % 4 <> 0"):
    return df.select(F.lit("").alias("forest"), "id", "label", F.expr(train).alias("train"))


def test_forest_learns_is_repeatable_and_predicts_from_storage(spark, tmp_path):
    df = clusters(spark)
    nodes, judged = T.grow(cells(df), df, T.whole(df, 6), trees=5, max_depth=8)
    rows = {r.id: (r.label, r.pred) for r in judged.collect()}
    assert set(rows) == set(range(0, 120, 4))
    assert np.mean([a == b for a, b in rows.values()]) > 0.9
    again, _ = T.grow(cells(df), df.repartition(3), T.whole(df, 6), trees=5, max_depth=8)
    assert sorted(map(str, nodes.collect())) == sorted(map(str, again.collect()))
    nodes.write.parquet(f"{tmp_path}/forest")
    stored = T.predict(spark.read.parquet(f"{tmp_path}/forest"), df.where("id % 4 = 0"), trees=5)
    assert {r.id: r.pred for r in stored.collect()} == {i: p for i, (_, p) in rows.items()}


def test_forest_leaves(spark):
    """Splits separate every node's rows into two parts that are not empty; leaves end in one
    label, equal rows, or the depth."""
    rows = [(i, [float(i % 5), 1.0], i % 2) for i in range(20)] + [(30, [2.0, 1.0], 0), (31, [2.0, 1.0], 1)]
    df = spark.createDataFrame(rows, ROWS)
    nodes, _ = T.grow(cells(df, "true"), df, T.whole(df, 2), trees=3)
    for tree in range(3):
        held = {1: rows}
        found = {r.node: r for r in nodes.where(F.col("tree") == tree).collect()}
        for number in sorted(found):
            node, own = found[number], held[number]
            assert sum(c.n for c in node.counts) == len(own)
            if node.threshold is not None:
                left = [r for r in own if r[1][node.dim] <= node.threshold]
                assert 0 < len(left) < len(own)
                held[2 * number] = left
                held[2 * number + 1] = [r for r in own if r not in left]
    one = spark.createDataFrame([(1, [1.0, 2.0], 7)], ROWS)
    nodes, judged = T.grow(cells(one, "true"), one, T.whole(one, 2), trees=2)
    assert nodes.count() == 2 and judged.count() == 0
    with pytest.raises(ValueError):
        T.grow(cells(one), one, T.whole(one, 2), max_depth=61)


def test_forest_search(spark):
    df = clusters(spark, 60).withColumn("fold", (F.col("id") % 3).cast("int"))
    selected = K.select_by_fold(K.fold_statistics(df), [50, 100])
    scores = T.search(df, selected, trees=3, max_depth=6)
    rows = {r.percentile: r.mean for r in scores.collect()}
    assert set(rows) == {50, 100} and min(rows.values()) > 0.8
    assert T.best_percentile(scores) == max(rows, key=lambda p: (round(rows[p], 9), -p))


@pytest.mark.parametrize("cells_held", [0, 40, 200])
def test_forests_held_by_tasks_and_joined_ones_are_the_same(spark, monkeypatch, cells_held):
    """With lacking, strange and repeated values, from whatever level on the trees outgrow the tasks."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(0, 6, 4)], int(rng.integers(0, 3))) for i in range(60)]
    rows += [rows[5], rows[7], (70, [1.0, None, 2.0, 0.5], 1), (71, [1.0, 2.0], None), (72, None, 2), (73, [float("nan")] * 4, 0)]
    rows += [(74, [1.0, None, 2.0, 0.5], 1), (76, [float("nan"), 2.0, 1.0, 4.0], 2)]
    df = spark.createDataFrame(rows, ROWS)

    def grown():
        nodes, judged = T.grow(cells(df), df, T.whole(df, 4), trees=4, max_depth=5)
        pred = T.predict(nodes, df, trees=4)
        return [sorted(map(str, x.collect())) for x in (nodes, judged, pred)]

    held = grown()
    monkeypatch.setattr(T, "HELD_CELLS", cells_held)
    assert grown() == held
    assert len(held[0]) > 20


def test_forest_shuffles_no_row_for_each_tree(spark, monkeypatch):
    """At a level, tasks hand on their nodes' sums; the working table of the joined way is never made."""
    monkeypatch.setattr(T, "_grow_joined", None)
    df = clusters(spark)
    nodes, _ = T.grow(cells(df), df, T.whole(df, 6), trees=5, max_depth=3)
    assert nodes.count() > 5


def test_hinge_against_numpy(spark):
    df = clusters(spark, 80)
    weights = L.fit_hinge(df.repartition(3), 6, [0, 1, 2], epochs=2, batches=3)
    rows = df.withColumn("b", L.batch_of(batches=3)).collect()
    w = np.zeros((3, 7))
    for step in range(6):
        part = [r for r in rows if r.b == step % 3]
        eta = L.rate(step)
        new = w * (1 - eta * L.ALPHA)
        new[:, -1] = w[:, -1]
        for c in range(3):
            for r in part:
                x, y = np.array([*r.features, 1.0]), 1.0 if r.label == c else -1.0
                if y * (x @ w[c]) < 1:
                    new[c] += eta * y * x / len(part)
        w = new
    assert np.allclose(weights, w, atol=1e-9)
    model = L.weight_table(df, weights, [0, 1, 2])
    pred = {r.id: r.pred for r in L.predict(df, model).collect()}
    assert np.mean([pred[r.id] == r.label for r in rows]) > 0.9
    assert not L.fit_hinge(df.limit(0), 6, [0, 1]).any()


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski", "wminkowski", "seuclidean", "mahalanobis"])
def test_knn_model_store_and_load(spark, tmp_path, metric):
    df = clusters(spark, 60)
    kind = KM.KnnClassifier(percentile=70.0, metric=metric, p=3.0, factors=[1.0, 2.0, 1.0, 0.5, 1.0, 1.0], weights="distance")
    model = Pipeline(stages=[kind]).fit(df)
    model.write().overwrite().save(f"{tmp_path}/{metric}")
    loaded = PipelineModel.load(f"{tmp_path}/{metric}")
    assert sorted(loaded.transform(df).collect()) == sorted(model.transform(df).collect())
    right = loaded.transform(df).join(df, "id").where("pred = label").count()
    assert right >= 54


def test_best_classifier(spark):
    scores = spark.createDataFrame(
        [(50, "manhattan", "uniform", 0.5), (80, "euclidean", "distance", 0.7), (90, "euclidean", "uniform", 0.7)],
        "percentile int, metric string, weights string, mean double",
    )
    best = KM.best_classifier(scores, k=3)
    assert [best.getOrDefault(n) for n in ("percentile", "metric", "weights", "k")] == [80.0, "euclidean", "distance", 3]


@pytest.mark.parametrize("measure", [K.Metric(1), K.METRICS["chebyshev"], K.minkowski(3), K.minkowski(3, [1.0, 2.5] * 6), K.Metric(2, (1.0,) * 12)])
def test_sums_in_single_precision_skip_pairs_and_keep_the_nearest(measure, monkeypatch):
    monkeypatch.setattr(K, "_COLUMNS", 200)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 12)) * 30
    x[100:400] = x[7]  # copies: equal distances
    x[500] = x[8] + 1e-8
    q, ids = x[:30], rng.permutation(3000)
    sets = [np.arange(4), np.arange(12)]
    near = K.near_pairs(measure if measure.weights is None else K.Metric(measure.p), q, x, 5, sets)
    assert max(len(row) for row, _ in near) < 0.2 * 30 * 3000
    row, col, dist = K.nearest_rows(measure, q, x, ids, 5)
    exact = measure.distances(q, x)
    for i in range(30):
        order = np.lexsort((ids, exact[i]))[:5]
        assert col[row == i].tolist() == order.tolist()
        assert dist[row == i].tolist() == exact[i][order].tolist()
    strange = x.copy()
    strange[3, 2], strange[4, 1] = np.nan, np.inf
    row, col, dist = K.nearest_rows(measure, q, strange, ids, 5)
    assert np.isfinite(dist).all() and not {3, 4} & set(col.tolist())


def test_neighbours_of_copies_stay_few(monkeypatch):
    """A group of copies makes every pair as near as the k-th; a piece is cut before it is kept."""
    kept = []
    plain = K._first_k
    monkeypatch.setattr(K, "_first_k", lambda row, *x: kept.append(len(row)) or plain(row, *x))
    x = np.ones((20_000, 3))
    row, col, _ = K.nearest_rows(K.Metric(1), x[:64], x, np.arange(20_000), 5)
    assert col.tolist() == [0, 1, 2, 3, 4] * 64 and max(kept) <= 16 * 4_096
    K.nearest_rows(K.Metric(2), x[:64], x, np.arange(20_000), 5)
    assert max(kept) <= 64 * 4_096


def test_bounds_skip_pairs_and_keep_the_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 64))
    x[100:140] = x[7]  # copies: equal distances
    q, ids = x[:40], rng.permutation(500)
    row, col = K.candidates(q, x, 5)
    assert len(row) < 0.05 * 40 * 500
    row, col, dist = K.nearest_rows(K.Metric(2), q, x, ids, 5)
    for i in range(40):
        exact = np.round(np.sqrt(((q[i] - x) ** 2).sum(1)), K.DIGITS)
        order = np.lexsort((ids, exact))[:5]
        assert col[row == i].tolist() == order.tolist()
        assert dist[row == i].tolist() == exact[order].tolist()


def test_knn_join_leaves_out_rows_without_vector(spark):
    df = spark.createDataFrame([(1, [0.0], 1), (2, None, 1), (3, [2.0], 0)], ROWS)
    got = {(r.id, r.train_id) for r in K.knn_join(df, df, 5).collect()}
    assert got == {(1, 1), (1, 3), (3, 3), (3, 1)}


def test_degenerate_features(spark):
    one_class = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(4)], ROWS)
    assert [r.f for r in SC.anova_f(one_class).collect()] == [None, None]
    each = spark.createDataFrame([(i, [float(i)], i) for i in range(4)], ROWS)
    assert [r.f for r in SC.anova_f(each).collect()] == [None]
    folded = each.withColumn("fold", (F.col("id") % 2).cast("int"))
    assert {r.f for r in K.fold_statistics(folded).collect()} == {None}
    scaled = K.standardize(one_class, one_class, dim=2)[1]
    assert {r.features[1] for r in scaled.collect()} == {1.0}


def test_stored_stages(spark, tmp_path):
    text = spark.createDataFrame(
        [(1, ["a", "b"], ["b"], ["a", "a"]), (2, ["c"], ["a"], ["b", "x"])],
        "id long, h1 array<string>, h2 array<string>, ref array<string>",
    )
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [3.0, 1.0])], "word string, vec array<double>")
    names = EM.embed(text, vectors, 2, EM.MEAN).columns
    for i, stage in enumerate((EM.MeanEmbedding(vectors, 2), EM.TfidfEmbedding(vectors, 2))):
        model = Pipeline(stages=[stage]).fit(text)
        model.write().save(f"{tmp_path}/{i}")
        loaded = PipelineModel.load(f"{tmp_path}/{i}").transform(text).select(names)
        assert sorted(loaded.collect()) == sorted(model.transform(text).select(names).collect())
    Pipeline(stages=[EM.TfidfEmbedding(vectors, 2)]).write().save(f"{tmp_path}/unfitted")
    fitted = Pipeline.load(f"{tmp_path}/unfitted").fit(text)
    assert sorted(fitted.transform(text).collect()) == sorted(model.transform(text).collect())


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    source, check = tmp_path / "in", str(tmp_path / "state")
    gold = spark.createDataFrame([(i, i % 2) for i in range(20)], "id long, gold int")

    def add(ids):
        rows = spark.createDataFrame([(i, i % 3 - 1) for i in ids], "id long, pred int")
        rows.coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema("id long, pred int").parquet(str(source))
        return sorted(map(tuple, JS.run_to_end(JS.running_counts(stream, gold, "id"), check).collect()))

    def batch():
        joined = spark.read.parquet(str(source)).join(gold, "id")
        return sorted(map(tuple, joined.groupBy("gold", "pred").agg(F.count("*").alias("cnt")).collect()))

    add(range(0, 8))
    assert run() == batch()
    assert run() == batch()  # nothing new: the state that was kept
    add(range(8, 20))
    assert run() == batch()


def test_bitmap_keeps_every_key_and_drops_misses(spark):
    table = spark.range(3_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"), F.lit(1).alias("v"))
    rows = spark.range(0, 12_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
    rows = rows.unionByName(spark.createDataFrame([(None, "1"), (1, None)], "k long, s string"))
    pieces = B.build_filter(table, ["k", "s"])
    kept = B.may_hold(rows, pieces, ["k", "s"])
    assert kept.where("k < 3000").count() == 3_000
    assert kept.count() < 3_200
    joined = lookup(rows, table, ["k", "s"], max_broadcast_rows=0)
    assert joined.count() == 3_000 and joined.columns == ["k", "s", "v"]
