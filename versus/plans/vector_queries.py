"""Queries over word vectors, scaling, neighbours, folds, models and the stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versus.functions.expr import r6
from versus.functions.tokens import PUNCTUATION, strip_punct, unicode_tokens
from versus.operators import embed as EM
from versus.operators import features as FX
from versus.operators import judge as J
from versus.operators import knn as K
from versus.operators import models as M
from versus.operators import rank as R
from versus.operators import scaling as SC
from versus.plans import fixtures as X
from versus.plans import oracle_base as O
from versus.plans.feature_queries import CHAR_PRF as _CHAR_PRF
from versus.plans.feature_queries import WORDS as _WORDS
from versus.session import materialize, scratch_dir
from versus.sources import tables as TB
from versus.sources import text as TX
from versus.streaming import judge_stream as JS

DIM = 64
SIDES = ("h1", "h2", "ref")
NEIGHBOURS = 5
CLASSES = [-1, 0, 1]


def stripped_triples(spark, d) -> DataFrame:
    """(id, h1, h2, ref) as punctuation-stripped tokens of the sentences."""
    return X.text_triples(spark, d).select(
        "id", *[strip_punct(unicode_tokens(F.col(s))).alias(s) for s in SIDES]
    )


def word_vectors(spark, d) -> DataFrame:
    """(word, vec): a word of the corpus takes the embedding its hash points at.

    A quarter of the hash range points past the table, so some words have no vector.
    """
    words = (
        stripped_triples(spark, d)
        .select(F.explode("ref").alias("word"))
        .where("word <> ''")
        .distinct()
    )
    table = X.table(spark, d, "embeddings")
    size = table.agg(F.floor(F.count(F.lit(1)) * 4 / 3).alias("m")).scalar()
    slot = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint") % size
    slotted = words.withColumn("vec_id", slot)
    # as stored: single-precision vectors travel at half the size, means are in double precision
    return slotted.join(table, "vec_id").select("word", F.col("embedding").alias("vec"))


def _inputs(spark, d) -> tuple[DataFrame, DataFrame]:
    return stripped_triples(spark, d), materialize(word_vectors(spark, d))


def _averaged(means: DataFrame) -> DataFrame:
    """(side, dim, value): the corpus mean of each number of the sentence vectors."""
    rows = means.select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("v")) for s in SIDES]))
    ).select("side", F.posexplode("v").alias("dim", "v"))
    return rows.groupBy("side", "dim").agg(r6(F.avg("v")).alias("value"))


def _digest(vectors: DataFrame) -> DataFrame:
    """(id, size, total, weighted): sums that change when any number moves or changes place."""
    weighted = F.aggregate(
        F.transform("features", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v
    )
    total = F.aggregate("features", F.lit(0.0), lambda a, v: a + v)
    return vectors.select(
        "id", F.size("features").alias("size"), r6(total).alias("total"), r6(weighted).alias("weighted")
    )


def wordvec_mean(spark, d):
    df, vec = _inputs(spark, d)
    return _averaged(EM.sentence_vectors(df, vec, DIM))


def wordvec_tfidf(spark, d):
    df, vec = _inputs(spark, d)
    return _averaged(EM.sentence_vectors(df, vec, DIM, weighted_rows=True))


def embed_mean(spark, d):
    df, vec = _inputs(spark, d)
    return _digest(EM.embed(df, vec, DIM, EM.MEAN))


def embed_row_idf(spark, d):
    df, vec = _inputs(spark, d)
    return _digest(EM.embed(df, vec, DIM, EM.ROW_IDF))


def embed_corpus_idf(spark, d):
    df, vec = _inputs(spark, d)
    return _digest(EM.embed(df, vec, DIM, EM.CORPUS_IDF))


def idf_row(spark, d):
    """Per triple: how many words, and the smallest, largest and summed IDF."""
    out = EM.row_idf_summary(stripped_triples(spark, d))
    return out.select("id", "n_words", *[r6(F.col(c)).alias(c) for c in ("min_idf", "max_idf", "sum_idf")])


def _idf(idf: DataFrame) -> DataFrame:
    return idf.select("word", "df", r6(F.col("idf")).alias("idf"))


def idf_corpus(spark, d):
    return _idf(EM.corpus_idf(EM.word_bags(stripped_triples(spark, d))))


def idf_corpus_char(spark, d):
    return _idf(EM.char_idf(stripped_triples(spark, d)))


def vector_merge(spark, d):
    """The 120 lexical features followed by the 3 x 64 word-vector means."""
    words = materialize(X.word_triples(spark, d).drop("doc_id"))
    lexical = FX.feature_vector(words)
    df, vec = _inputs(spark, d)
    merged = EM.merge_vectors(lexical, EM.embed(df, vec, DIM, EM.MEAN))
    tail = _digest(merged.select("id", F.slice("features", F.lit(121), F.lit(3 * DIM)).alias("features")))
    return tail.join(
        merged.select(
            "id", F.size("features").alias("all"), r6(F.get("features", F.lit(0))).alias("first")
        ),
        "id",
    ).select("id", "all", "first", "total", "weighted")


def _long(df: DataFrame) -> DataFrame:
    return df.select("id", F.posexplode("features").alias("dim", "v")).select(
        "id", "dim", r6(F.col("v")).alias("value")
    )


def minmax_scale(spark, d):
    v = X.vectors(spark, d)
    return _long(SC.minmax_scale(v, SC.fit_minmax(v, DIM)))


def l2_normalize(spark, d):
    return _long(SC.scale_and_normalize(X.vectors(spark, d), DIM))


def anova_f(spark, d):
    return SC.anova_f(X.vectors(spark, d)).select("dim", F.round("f", 5).alias("f"))


def anova_select(spark, d):
    chosen = SC.anova_select(SC.anova_f(X.vectors(spark, d)), 50)
    return chosen.select("dim")


def _split(spark, d, scaled: bool = True) -> tuple[DataFrame, DataFrame]:
    v = X.vectors(spark, d)
    v = SC.scale_and_normalize(v, DIM) if scaled else v
    parts = materialize(R.holdout(v))
    return parts.where("is_test").drop("is_test"), parts.where("NOT is_test").drop("is_test")


def _knn(weights: str):
    def query(spark, d):
        test, train = _split(spark, d)
        return K.knn_classify(test, train, NEIGHBOURS, weights)

    return query


def knn_neighbours(spark, d):
    test, train = _split(spark, d)
    out = K.knn_join(test, train, NEIGHBOURS)
    return out.select("id", "rank", "train_id", r6(F.col("dist")).alias("dist"))


MINKOWSKI_P = 3.0
METRIC_WEIGHTS = [1.0 + (i % 4) * 0.5 for i in range(DIM)]


def _by_metric(test: DataFrame, train: DataFrame) -> dict[str, DataFrame]:
    std_train, std_test = _standardized(train, test)
    return {
        "manhattan": K.knn_join(test, train, NEIGHBOURS, "manhattan"),
        "chebyshev": K.knn_join(test, train, NEIGHBOURS, "chebyshev"),
        "minkowski": K.knn_join(test, train, NEIGHBOURS, K.minkowski(MINKOWSKI_P)),
        "wminkowski": K.knn_join(
            test, train, NEIGHBOURS, K.minkowski(MINKOWSKI_P, METRIC_WEIGHTS)
        ),
        "seuclidean": K.knn_join(std_test, std_train, NEIGHBOURS),
    }


def _standardized(train: DataFrame, test: DataFrame) -> list[DataFrame]:
    return [materialize(df) for df in K.standardize(train, test, dim=DIM)]


def knn_metrics(spark, d):
    test, train = _split(spark, d)
    out = None
    for name, found in _by_metric(test, train).items():
        part = K.vote(found).select(F.lit(name).alias("metric"), "id", "pred")
        out = part if out is None else out.unionAll(part)
    return out


def knn_mahalanobis(spark, d):
    test, train = _split(spark, d, scaled=False)
    white = [materialize(df) for df in K.whiten(train, test, dim=DIM)]
    return K.knn_classify(white[1], white[0], NEIGHBOURS)


def knn_cv(spark, d):
    """Stratified 3-fold accuracy of the neighbour classifier."""
    v = SC.scale_and_normalize(X.vectors(spark, d), DIM)
    folded = materialize(R.stratified_kfold(v, 3))
    scores = K.cross_validate(folded, 3, NEIGHBOURS)
    return scores.select("fold", "n", "n_right", r6(F.col("accuracy")).alias("accuracy"))


GRID_FOLDS = 10
GRID_PERCENTILES = list(range(5, 101, 5))
GRID_METRICS = {
    "euclidean": K.Metric(2),
    "manhattan": K.Metric(1),
    "chebyshev": K.METRICS["chebyshev"],
    "minkowski": K.minkowski(MINKOWSKI_P),
    "wminkowski": K.minkowski(MINKOWSKI_P, METRIC_WEIGHTS),
    "seuclidean": "seuclidean",
}


def _grid(spark, d, metrics) -> DataFrame:
    v = SC.scale_and_normalize(X.vectors(spark, d), DIM)
    folded = materialize(R.kfold(v, GRID_FOLDS))
    found = K.grid_neighbours(folded, DIM, GRID_PERCENTILES, metrics, NEIGHBOURS)
    summary = K.score_summary(K.grid_scores(found), ("percentile", "metric", "weights"))
    return summary.select(
        "percentile", "metric", "weights", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std")
    )


def knn_grid(spark, d):
    """Share of selected dimensions x metric x vote weights over ten folds: mean and deviation."""
    return _grid(spark, d, GRID_METRICS)


def knn_grid_mahalanobis(spark, d):
    """The same grid for the Mahalanobis distance."""
    return _grid(spark, d, {"mahalanobis": "mahalanobis"})


def kfold_assign(spark, d):
    return R.kfold(X.vectors(spark, d).select("id"), 10)


def stratified_kfold_assign(spark, d):
    return R.stratified_kfold(X.vectors(spark, d).select("id", "label"), 3).select("id", "fold")


def holdout_split(spark, d):
    return R.holdout(X.vectors(spark, d).select("id"))


def text_round_trip(spark, d):
    """Write triples as text lines, read them back by position: (line, h1, h2, ref sizes, hash)."""
    path = scratch_dir(spark)
    TX.write_triples(X.text_triples(spark, d), path)
    rows, _ = TX.read_triples(spark, path, "text")
    return rows.select("id", F.md5(F.concat_ws("|", "h1", "h2", "ref")).alias("digest"))


def stream_confusion(spark, d):
    def judge(stream: DataFrame) -> DataFrame:
        docs = stream.select("doc_id", "text")
        return J.judge_meteor(X.triples_of(docs)).select("doc_id", "pred")

    counts = JS.stream_judgements(
        spark, d, "documents.parquet", judge, X.judgements(spark, d), "doc_id"
    )
    return J.confusion(counts)


# ---- models: rows only, no SQL equivalent


def _model_data(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors with a three-way label, as (all rows, train, test)."""
    v = X.vectors(spark, d).withColumn("label", (F.col("label") % 3 - 1).cast("int"))
    parts = R.holdout(v)
    return v, parts.where("NOT is_test").drop("is_test"), parts.where("is_test").drop("is_test")


def _classifier(kind: str):
    def query(spark, d):
        rows, train, _ = _model_data(spark, d)
        estimator = M.pipeline(kind, DIM, len(CLASSES))
        return M.train_and_predict(estimator, train, rows.drop("label"), CLASSES)

    return query


def bernoulli_nb(spark, d):
    rows, train, _ = _model_data(spark, d)
    return M.train_and_predict(M.bernoulli_nb(), train, rows.drop("label"), CLASSES)


def ovo_vote(spark, d):
    rows, train, _ = _model_data(spark, d)
    return M.one_vs_one(train, rows.drop("label"), CLASSES)


TREE_PERCENTILES = tuple(range(5, 101, 5))
SVC_COSTS = (1.0, 10.0, 100.0, 1000.0)


def _searched(spark, d, n_folds: int, settings, metrics: tuple[str, ...]) -> DataFrame:
    """(setting, metric, mean, std, chosen, n_right): n_right, of the chosen setting only, are the
    right predictions of the model refitted on the training rows for the held-out rows."""
    _, train, test = _model_data(spark, d)
    folded = materialize(R.kfold(train, n_folds))
    scores, model, best = M.search(folded, CLASSES, settings, metrics)
    pred = M.predict(model, test.drop("label"), CLASSES).join(test.select("id", "label"), "id")
    right = pred.agg(F.sum((F.col("pred") == F.col("label")).cast("long"))).first()[0]
    rows = [(*r, r[0] == best, right if r[0] == best else None) for r in scores]
    return spark.createDataFrame(
        rows, "setting string, metric string, mean double, std double, chosen boolean, n_right long"
    )


def decision_tree_grid(spark, d):
    """A decision tree on 5 to 100 percent of the features, ten folds, then the best refitted."""
    return _searched(spark, d, 10, M.tree_settings(CLASSES, TREE_PERCENTILES), ("accuracy",))


def svc_grid(spark, d):
    """Linear SVCs at four costs, five folds, by macro precision and macro recall."""
    return _searched(spark, d, 5, M.svc_settings(SVC_COSTS), ("macro_precision", "macro_recall"))


def knn_ovr(spark, d):
    """One yes/no vote of the neighbours per class; the largest share wins."""
    test, train = _split(spark, d)
    return K.vote_one_vs_rest(K.knn_join(test, train, NEIGHBOURS))


def embed_char_idf(spark, d):
    """TF-IDF means with weights of single characters: longer words take the largest weight."""
    df, vec = _inputs(spark, d)
    idf = materialize(EM.char_idf(df))
    return _digest(EM.embed(df, vec, DIM, EM.CORPUS_IDF, idf))


HEAD = 16


def embed_batch(spark, d):
    """Two vector tables (whole vectors, and their first 16 numbers) times three ways of averaging."""
    df, vec = _inputs(spark, d)
    head = vec.select("word", F.slice("vec", 1, HEAD).alias("vec"))
    out = EM.embed_batch(df, {"whole": (vec, DIM), "head": (head, HEAD)})
    digests = _digest(out.select(F.struct("source", "mode", "id").alias("id"), "features"))
    return digests.select("id.source", "id.mode", "id.id", "size", "total", "weighted")


def model_round_trip(spark, d):
    """Fit, store, load, predict everything, store and load the judgements: how many rows, and
    how many on which the loaded model differs from the fitted one."""
    rows, train, _ = _model_data(spark, d)
    path = scratch_dir(spark)
    fitted = M.pipeline("decision_tree", DIM, len(CLASSES), 0.5).fit(M.to_ml(train, CLASSES))
    M.save_model(fitted, f"{path}/model")
    TB.save_judgements(M.predict(M.load_model(f"{path}/model"), rows, CLASSES), f"{path}/pred")
    loaded = TB.load_judgements(spark, f"{path}/pred").withColumnRenamed("pred", "again")
    both = M.predict(fitted, rows, CLASSES).join(loaded, "id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum((~F.col("pred").eqNullSafe(F.col("again"))).cast("int")), F.lit(0)).alias("n_differing"),
    )


def held_out_accuracy(spark, d):
    """(model, n, n_right, accuracy) on the held-out rows, for every kind of model."""
    _, train, test = _model_data(spark, d)
    train, test = materialize(train), materialize(test)
    out = None
    for kind in (*MODEL_KINDS, "bernoulli_nb"):
        model = M.bernoulli_nb() if kind == "bernoulli_nb" else M.pipeline(kind, DIM, len(CLASSES))
        pred = M.train_and_predict(model, train, test.drop("label"), CLASSES)
        hits = pred.join(test.select("id", "label"), "id").agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("pred") == F.col("label")).cast("int")).alias("n_right")
        )
        part = hits.select(
            F.lit(kind).alias("model"), "n", "n_right", r6(F.col("n_right") / F.col("n")).alias("accuracy")
        )
        out = part if out is None else out.unionAll(part)
    return out


MODEL_KINDS = ("decision_tree", "random_forest", "mlp", "linear_svc", "tree_ovr", "mlp_ovr")

QUERIES = {
    "wordvec_mean": wordvec_mean,
    "wordvec_tfidf": wordvec_tfidf,
    "embed_mean": embed_mean,
    "embed_row_idf": embed_row_idf,
    "embed_corpus_idf": embed_corpus_idf,
    "idf_row": idf_row,
    "idf_corpus": idf_corpus,
    "idf_corpus_char": idf_corpus_char,
    "vector_merge": vector_merge,
    "minmax_scale": minmax_scale,
    "l2_normalize": l2_normalize,
    "anova_f": anova_f,
    "anova_select": anova_select,
    "knn_neighbours": knn_neighbours,
    "knn_uniform": _knn("uniform"),
    "knn_distance": _knn("distance"),
    "knn_metrics": knn_metrics,
    "knn_mahalanobis": knn_mahalanobis,
    "knn_cv": knn_cv,
    "knn_grid": knn_grid,
    "knn_grid_mahalanobis": knn_grid_mahalanobis,
    "kfold_assign": kfold_assign,
    "stratified_kfold_assign": stratified_kfold_assign,
    "holdout_split": holdout_split,
    "text_round_trip": text_round_trip,
    "stream_confusion": stream_confusion,
    **{k: _classifier(k) for k in MODEL_KINDS},
    "bernoulli_nb": bernoulli_nb,
    "ovo_vote": ovo_vote,
    "decision_tree_grid": decision_tree_grid,
    "svc_grid": svc_grid,
    "knn_ovr": knn_ovr,
    "embed_char_idf": embed_char_idf,
    "embed_batch": embed_batch,
    "model_round_trip": model_round_trip,
    "held_out_accuracy": held_out_accuracy,
}

# ---------------------------------------------------------------- oracle SQL

_PUNCT = "'" + PUNCTUATION.replace("'", "''") + "'"
_STRIPPED = f"""
stripped AS (SELECT id, {", ".join(f"list_transform({s}, lambda t: trim(t, {_PUNCT})) AS {s}" for s in SIDES)}
  FROM triples)"""
_UNITS = f"""
{O.sides_of("stripped")},
uses AS (SELECT id, side, word, count(*) AS n FROM (SELECT id, side, unnest(t) AS word FROM sides) GROUP BY ALL)"""
_VECTORS = """
vocabulary AS (SELECT DISTINCT unnest(ref) AS word FROM stripped),
word_vectors AS (SELECT word, embedding::DOUBLE[] AS vec FROM (
    SELECT word, ('0x' || substr(md5(word), 1, 8))::BIGINT % ((SELECT count(*) FROM embeddings) * 4 // 3) AS vec_id
    FROM vocabulary WHERE word <> '') JOIN embeddings USING (vec_id))"""
_ROW_IDF = """
row_idf AS (SELECT id, word, ln(4::DOUBLE / (1 + count(*))::DOUBLE) + 1 AS idf FROM uses GROUP BY id, word)"""
_CORPUS_IDF = """
corpus_df AS (SELECT word, count(*) AS df FROM uses GROUP BY word),
corpus_idf AS (SELECT word, df, ln((1 + 3 * (SELECT count(*) FROM triples))::DOUBLE / (1 + df)::DOUBLE) + 1 AS idf
  FROM corpus_df)"""


def _means_sql(weight_join: str = "", weight: str = "1") -> str:
    return f"""
weighted AS (SELECT u.id, u.side, u.n, v.vec, u.n * {weight} AS w
  FROM uses u JOIN word_vectors v ON v.word = u.word {weight_join}),
known AS (SELECT id, side, sum(n) AS k FROM weighted GROUP BY ALL),
sums AS (SELECT id, side, dim, sum(w * x) AS s FROM (
    SELECT id, side, w, unnest(vec) AS x, unnest(range({DIM})) AS dim FROM weighted) GROUP BY ALL),
means AS (SELECT s.id, s.side, o.dim, coalesce(x.s / k.k, 0) AS v
  FROM sides s CROSS JOIN range({DIM}) AS o(dim)
  LEFT JOIN known k ON k.id = s.id AND k.side = s.side
  LEFT JOIN sums x ON x.id = s.id AND x.side = s.side AND x.dim = o.dim)"""


_ROW_JOIN = ("JOIN row_idf i ON i.id = u.id AND i.word = u.word", "i.idf")
_CORPUS_JOIN = (
    "LEFT JOIN corpus_idf i ON i.word = u.word",
    "coalesce(i.idf, (SELECT max(idf) FROM corpus_idf))",
)
_EMBED_CTES = (O.TRIPLES, _STRIPPED, _UNITS, _VECTORS)
_AVERAGED = "SELECT side, dim, round(avg(v), 6) AS value FROM means GROUP BY ALL"


_CHAR_IDF = """
word_uses AS (SELECT word, sum(n) AS n FROM uses GROUP BY word),
char_df AS (SELECT word, sum(n)::BIGINT AS df FROM (
  SELECT unnest(list_distinct(string_split(word, ''))) AS word, n FROM word_uses WHERE word <> '') GROUP BY word),
corpus_idf AS (SELECT word, df, ln((1 + (SELECT sum(n) FROM word_uses))::DOUBLE / (1 + df)::DOUBLE) + 1 AS idf
  FROM char_df)"""


def _batch_sql() -> str:
    """The means of each way once, digested whole and for the first numbers only."""
    parts, union = [], []
    for mode, (join, weight) in enumerate([("", "1"), _ROW_JOIN, _CORPUS_JOIN], 1):
        names = ("weighted", "known", "sums", "means")
        sql = _means_sql(join, weight)
        for name in names:
            sql = re.sub(rf"\b{name}\b", f"{name}_{mode}", sql)
        parts.append(sql)
        for source, size in (("whole", DIM), ("head", HEAD)):
            place = "dim * 3 + k" if mode == 1 else f"k * {size} + dim"
            union.append(
                f"""SELECT '{source}' AS source, {mode} AS mode, id, count(*)::INTEGER AS size,
  round(sum(v), 6) AS total, round(sum(v * ({place} + 1)), 6) AS weighted
FROM (SELECT *, CASE side WHEN 'h1' THEN 0 WHEN 'h2' THEN 1 ELSE 2 END AS k FROM means_{mode} WHERE dim < {size})
GROUP BY id"""
            )
    return O.with_ctes(*_EMBED_CTES, _ROW_IDF, _CORPUS_IDF, *parts, " UNION ALL ".join(union))


def _digest_sql(position: str) -> str:
    return f"""SELECT id, count(*)::INTEGER AS size, round(sum(v), 6) AS total,
  round(sum(v * ({position} + 1)), 6) AS weighted
FROM (SELECT *, CASE side WHEN 'h1' THEN 0 WHEN 'h2' THEN 1 ELSE 2 END AS k FROM means) GROUP BY id"""


_SCALED = f"""
raw_values AS (SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS v, unnest(range({DIM})) AS dim FROM embeddings),
fit AS (SELECT dim, min(v) AS low, max(v) - min(v) AS span FROM raw_values GROUP BY dim),
scaled AS (SELECT id, label, dim, coalesce((v - low) / nullif(span, 0), 0) AS v FROM raw_values JOIN fit USING (dim)),
norms AS (SELECT id, sqrt(sum(v * v)) AS norm FROM scaled GROUP BY id),
unit AS (SELECT id, label, dim, v / (CASE WHEN norm = 0 THEN 1 ELSE norm END) AS v FROM scaled JOIN norms USING (id))"""
_SPLIT = """
points AS (SELECT id, any_value(label) AS label, list(v ORDER BY dim) AS f,
  ('0x' || substr(md5(id::VARCHAR || ':42'), 1, 8))::BIGINT % 10 = 0 AS is_test FROM {source} GROUP BY id)"""
_TEST_PAIRS = "points q JOIN points t ON q.is_test AND NOT t.is_test"


def _sum_over(expr: str) -> str:
    return f"list_sum(list_transform(range(1, {DIM + 1}), lambda i: {expr}))"


_EUCLID = "sqrt(" + _sum_over("(q.f[i] - t.f[i]) * (q.f[i] - t.f[i])") + ")"
_NEAR = """
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, train_id) AS rank
  FROM distances) WHERE rank <= 5)"""


def _distances(expr: str, pairs: str = _TEST_PAIRS) -> str:
    return f"""
distances AS (SELECT q.id, t.id AS train_id, t.label, round({expr}, 9) AS dist FROM {pairs})"""


_VOTE_UNIFORM = """tally AS (SELECT id, label, count(*) AS w FROM near GROUP BY ALL)"""
_VOTE_DISTANCE = """
zeroed AS (SELECT *, max((dist = 0)::INTEGER) OVER (PARTITION BY id) AS z FROM near),
tally AS (SELECT id, label, round(sum(CASE WHEN z = 1 THEN (dist = 0)::INTEGER::DOUBLE ELSE 1.0::DOUBLE / dist END), 9) AS w
  FROM zeroed GROUP BY ALL)"""
_WINNER = """SELECT id, label AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY w DESC, label) AS r FROM tally) WHERE r = 1"""


def _knn_sql(expr: str, vote: str = _VOTE_UNIFORM) -> str:
    return O.with_ctes(_SCALED, _SPLIT.format(source="unit"), _distances(expr), _NEAR, vote, _WINNER)


def _metric_sql() -> str:
    weights = "[" + ", ".join(str(w) for w in METRIC_WEIGHTS) + "]"
    exprs = {
        "manhattan": _sum_over("abs(q.f[i] - t.f[i])"),
        "chebyshev": _sum_over("abs(q.f[i] - t.f[i])").replace("list_sum", "list_max", 1),
        "minkowski": f"pow({_sum_over('pow(abs(q.f[i] - t.f[i]), 3.0)')}, 1.0::DOUBLE / 3.0)",
        "wminkowski": f"pow({_sum_over('pow(abs(q.f[i] - t.f[i]) * ' + weights + '[i], 3.0)')}, 1.0::DOUBLE / 3.0)",
        "seuclidean": "sqrt("
        + _sum_over("(q.f[i] / q.s[i] - t.f[i] / q.s[i]) * (q.f[i] / q.s[i] - t.f[i] / q.s[i])")
        + ")",
    }
    union = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, q.id, t.id AS train_id, t.label, round({e}, 9) AS dist "
        f"FROM (SELECT * FROM points, stds) q JOIN points t ON q.is_test AND NOT t.is_test"
        for m, e in exprs.items()
    )
    return O.with_ctes(
        _SCALED,
        _SPLIT.format(source="unit"),
        """stds AS (SELECT list(sd ORDER BY dim) AS s FROM (
  SELECT dim, stddev_samp(v) AS sd FROM unit JOIN points USING (id) WHERE NOT is_test GROUP BY dim))""",
        f"distances AS ({union})",
        """near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY metric, id ORDER BY dist, train_id) AS rank
  FROM distances) WHERE rank <= 5)""",
        "tally AS (SELECT metric, id, label, count(*) AS w FROM near GROUP BY ALL)",
        """SELECT metric, id, label AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, id ORDER BY w DESC, label) AS r FROM tally) WHERE r = 1""",
    )


def _fold_sql(rank: str, total: str, k: int) -> str:
    size, longer = f"({total} // {k})", f"({total} % {k})"
    edge = f"({longer} * ({size} + 1))"
    return (
        f"(CASE WHEN {rank} < {edge} THEN {rank} // ({size} + 1) "
        f"ELSE {longer} + ({rank} - {edge}) // {size} END)::INTEGER"
    )


_STRATA = f"""
strata AS (SELECT id, label, {_fold_sql('r', 'n', 3)} AS fold FROM (
  SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS r,
    count(*) OVER (PARTITION BY label) AS n FROM embeddings))"""
_ANOVA = """
class_sums AS (SELECT dim, label, count(*) AS n, sum(v) AS s, sum(v * v) AS ss FROM {source} GROUP BY ALL),
dim_sums AS (SELECT dim, sum(n) AS n, count(*) AS k, sum(s) AS s, sum(ss) AS ss, sum(s * s / n) AS b
  FROM class_sums GROUP BY dim),
scores AS (SELECT dim, ((b - s * s / n) / (k - 1)) / ((ss - b) / (n - k)) AS f FROM dim_sums)"""


def _cv_ctes() -> tuple[str, ...]:
    pairs = "points q JOIN points t ON q.fold <> t.fold"
    return (
        _SCALED,
        _STRATA,
        """points AS (SELECT id, any_value(u.label) AS label, any_value(fold) AS fold, list(v ORDER BY dim) AS f
  FROM unit u JOIN strata USING (id) GROUP BY id)""",
        _distances(_EUCLID, pairs),
        _NEAR,
        _VOTE_UNIFORM,
        f"winners AS ({_WINNER})",
    )


#: Scores and cuts of the rows outside each fold, from ``own`` (id, dim, v, label, fold) and ``folds``.
_SHARES = "[" + ", ".join(map(str, GRID_PERCENTILES)) + "]"
_CUTS = "[" + ", ".join(str((100.0 - p) / 100.0) for p in GRID_PERCENTILES) + "]"
FOLD_SCORES = (
    """sums AS (SELECT fold, dim, label, count(*) AS n, sum(v) AS s, sum(v * v) AS ss FROM own GROUP BY ALL)""",
    """rest AS (SELECT h.fold, dim, label, sum(n) AS n, sum(s) AS s, sum(ss) AS ss
  FROM (SELECT DISTINCT fold FROM folds) h JOIN sums ON sums.fold <> h.fold GROUP BY ALL)""",
    """dim_rest AS (SELECT fold, dim, sum(n) AS n, count(*) AS k, sum(s) AS s, sum(ss) AS ss,
  sum(s * s / n) AS b FROM rest GROUP BY ALL)""",
    """scores AS (SELECT fold, dim, ((b - s * s / n) / (k - 1)) / ((ss - b) / (n - k)) AS f,
  sqrt((ss - s * s / n) / (n - 1)) AS sd FROM dim_rest)""",
    f"""cuts AS (SELECT fold, unnest({_SHARES}) AS percentile, unnest(cuts) AS cut
  FROM (SELECT fold, quantile_cont(f, {_CUTS}) AS cuts FROM scores GROUP BY fold))""",
)


def _grid_sql() -> str:
    """Each pair's differences are put in the order of the fold's scores; a share of the
    dimensions is then the head of that list."""
    weights = "[" + ", ".join(str(w) for w in METRIC_WEIGHTS) + "]"
    dims = f"range(1, {DIM + 1})"
    head = "[1:n]"
    distances = {
        "euclidean": f"sqrt(list_sum(e2{head}))",
        "manhattan": f"list_sum(e{head})",
        "chebyshev": f"list_max(e{head})",
        "minkowski": f"pow(list_sum(e3{head}), 1.0::DOUBLE / 3.0)",
        "wminkowski": f"pow(list_sum(w3{head}), 1.0::DOUBLE / 3.0)",
        "seuclidean": f"sqrt(list_sum(s2{head}))",
    }
    best = ", ".join(
        f"min({{'d': round({e}, 9), 't': train_id, 'l': label}}, {NEIGHBOURS}) AS {m}" for m, e in distances.items()
    )
    union = " UNION ALL ".join(
        f"SELECT percentile, '{m}' AS metric, fold, id, truth, unnest({m}) AS x FROM best" for m in distances
    )
    rank = _fold_sql("r", "n", GRID_FOLDS)
    return O.with_ctes(
        _SCALED,
        f"""folds AS (SELECT id, {rank} AS fold FROM (SELECT vec_id AS id,
  row_number() OVER (ORDER BY vec_id) - 1 AS r, count(*) OVER () AS n FROM embeddings))""",
        "own AS (SELECT u.*, fold FROM unit u JOIN folds USING (id))",
        *FOLD_SCORES[:4],
        """orders AS (SELECT fold, list(dim + 1 ORDER BY f DESC) AS o, list(sd ORDER BY f DESC) AS sd FROM scores
  GROUP BY fold)""",
        FOLD_SCORES[4],
        """shares AS (SELECT fold, percentile, count(*) FILTER (percentile >= 100 OR f > cut) AS n FROM scores
  JOIN cuts USING (fold) GROUP BY ALL)""",
        """points AS (SELECT id, any_value(label) AS label, any_value(fold) AS fold, list(v ORDER BY dim) AS v
  FROM own GROUP BY id)""",
        f"""pairs AS (SELECT q.id, q.fold, q.label AS truth, t.id AS train_id, t.label, o, sd,
    list_transform(o, lambda i: abs(q.v[i] - t.v[i])) AS e
  FROM points q JOIN points t ON q.fold <> t.fold JOIN orders ON orders.fold = q.fold)""",
        f"""powers AS (SELECT *, list_transform(e, lambda x: x * x) AS e2, list_transform(e, lambda x: x * x * x) AS e3,
    list_transform({dims}, lambda i: pow(e[i] * {weights}[o[i]], 3)) AS w3,
    list_transform({dims}, lambda i: pow(e[i] / sd[i], 2)) AS s2 FROM pairs)""",
        f"""best AS (SELECT percentile, p.fold, id, truth, {best}
  FROM powers p JOIN shares s ON s.fold = p.fold GROUP BY ALL)""",
        f"near AS ({union})",
        """zeroed AS (SELECT *, x.d AS dist, x.l AS label,
  max((x.d = 0)::INTEGER) OVER (PARTITION BY percentile, metric, id) AS z FROM near)""",
        """tally AS (SELECT percentile, metric, fold, id, truth, label, count(*)::DOUBLE AS uniform,
    round(sum(CASE WHEN z = 1 THEN (dist = 0)::INTEGER::DOUBLE ELSE 1.0::DOUBLE / dist END), 9) AS near
  FROM zeroed GROUP BY ALL)""",
        """winners AS (
  SELECT percentile, metric, 'uniform' AS weights, fold, truth, max({'w': uniform, 'l': -label}).l AS l
    FROM tally GROUP BY percentile, metric, fold, truth, id
  UNION ALL
  SELECT percentile, metric, 'distance', fold, truth, max({'w': near, 'l': -label}).l
    FROM tally GROUP BY percentile, metric, fold, truth, id)""",
        """fold_scores AS (SELECT percentile, metric, weights, fold, avg((truth = -l)::INTEGER::DOUBLE) AS accuracy
  FROM winners GROUP BY ALL)""",
        """SELECT percentile::INTEGER AS percentile, metric, weights, round(avg(accuracy), 6) AS mean,
  round(stddev_pop(accuracy), 6) AS std FROM fold_scores GROUP BY ALL""",
    )


ORACLE = {
    "wordvec_mean": O.with_ctes(*_EMBED_CTES, _means_sql(), _AVERAGED),
    "wordvec_tfidf": O.with_ctes(*_EMBED_CTES, _ROW_IDF, _means_sql(*_ROW_JOIN), _AVERAGED),
    "embed_mean": O.with_ctes(*_EMBED_CTES, _means_sql(), _digest_sql("dim * 3 + k")),
    "embed_row_idf": O.with_ctes(
        *_EMBED_CTES, _ROW_IDF, _means_sql(*_ROW_JOIN), _digest_sql(f"k * {DIM} + dim")
    ),
    "embed_corpus_idf": O.with_ctes(
        *_EMBED_CTES, _CORPUS_IDF, _means_sql(*_CORPUS_JOIN), _digest_sql(f"k * {DIM} + dim")
    ),
    "embed_char_idf": O.with_ctes(
        *_EMBED_CTES, _CHAR_IDF, _means_sql(*_CORPUS_JOIN), _digest_sql(f"k * {DIM} + dim")
    ),
    "embed_batch": _batch_sql(),
    "knn_ovr": _knn_sql(_EUCLID),
    "idf_row": O.with_ctes(
        O.TRIPLES,
        _STRIPPED,
        _UNITS,
        _ROW_IDF,
        """SELECT id, count(*) AS n_words, round(min(idf), 6) AS min_idf, round(max(idf), 6) AS max_idf,
  round(sum(idf), 6) AS sum_idf FROM row_idf GROUP BY id""",
    ),
    "idf_corpus": O.with_ctes(
        O.TRIPLES, _STRIPPED, _UNITS, _CORPUS_IDF, "SELECT word, df, round(idf, 6) AS idf FROM corpus_idf"
    ),
    "idf_corpus_char": O.with_ctes(
        O.TRIPLES,
        _STRIPPED,
        _UNITS,
        "word_uses AS (SELECT word, sum(n) AS n FROM uses GROUP BY word)",
        """char_df AS (SELECT word, sum(n)::BIGINT AS df FROM (
  SELECT unnest(list_distinct(string_split(word, ''))) AS word, n FROM word_uses WHERE word <> '') GROUP BY word)""",
        """SELECT word, df, round(ln((1 + (SELECT sum(n) FROM word_uses))::DOUBLE / (1 + df)::DOUBLE) + 1, 6) AS idf
FROM char_df""",
    ),
    "minmax_scale": O.with_ctes(_SCALED, "SELECT id, dim::INTEGER AS dim, round(v, 6) AS value FROM scaled"),
    "l2_normalize": O.with_ctes(_SCALED, "SELECT id, dim::INTEGER AS dim, round(v, 6) AS value FROM unit"),
    "anova_f": O.with_ctes(
        _SCALED, _ANOVA.format(source="raw_values"), "SELECT dim::INTEGER AS dim, round(f, 5) AS f FROM scores"
    ),
    "anova_select": O.with_ctes(
        _SCALED,
        _ANOVA.format(source="raw_values"),
        "SELECT dim::INTEGER AS dim FROM scores WHERE f > (SELECT quantile_cont(f, 0.5) FROM scores)",
    ),
    "knn_neighbours": O.with_ctes(
        _SCALED,
        _SPLIT.format(source="unit"),
        _distances(_EUCLID),
        _NEAR,
        "SELECT id, rank, train_id, round(dist, 6) AS dist FROM near",
    ),
    "knn_uniform": _knn_sql(_EUCLID),
    "knn_distance": _knn_sql(_EUCLID, _VOTE_DISTANCE),
    "knn_metrics": _metric_sql(),
    "knn_cv": O.with_ctes(
        *_cv_ctes(),
        """SELECT fold, count(*) AS n, (count(*) FILTER (pred = label)) AS n_right,
  round((count(*) FILTER (pred = label))::DOUBLE / count(*), 6) AS accuracy
FROM winners JOIN points USING (id) GROUP BY fold""",
    ),
    "knn_grid": _grid_sql(),
    "vector_merge": O.with_ctes(
        *_EMBED_CTES,
        _WORDS,
        _CHAR_PRF,
        _means_sql(),
        f"digest AS ({_digest_sql('dim * 3 + k')})",
        f"""SELECT d.id, (120 + d.size)::INTEGER AS "all", round(c.h1_0, 6) AS first, d.total, d.weighted
FROM digest d JOIN char_prf c ON c.id = d.id""",
    ),
    "model_round_trip": "SELECT count(*) AS n_rows, 0::BIGINT AS n_differing FROM embeddings",
    "bernoulli_nb": O.with_ctes(
        """points AS (SELECT vec_id AS id, label % 3 - 1 AS label, embedding AS v,
  ('0x' || substr(md5(vec_id::VARCHAR || ':42'), 1, 8))::BIGINT % 10 = 0 AS is_test FROM embeddings)""",
        "long AS (SELECT id, label, is_test, unnest(v) > 0 AS x, unnest(range(len(v))) AS dim FROM points)",
        "sizes AS (SELECT label, count(*) AS n FROM points WHERE NOT is_test GROUP BY label)",
        """theta AS (SELECT label, dim, (sum(x::INTEGER) + 1.0) / (any_value(n) + 2.0) AS p
  FROM long JOIN sizes USING (label) WHERE NOT is_test GROUP BY label, dim)""",
        """scored AS (SELECT l.id, t.label, sum(CASE WHEN x THEN ln(p) ELSE ln(1 - p) END)
    + any_value(ln((n + 1.0) / ((SELECT sum(n) FROM sizes) + (SELECT count(*) FROM sizes)))) AS s
  FROM long l JOIN theta t USING (dim) JOIN sizes z ON z.label = t.label GROUP BY ALL)""",
        "SELECT id, arg_max(label, s) AS pred FROM scored GROUP BY id",
    ),
    "kfold_assign": f"""SELECT id, {_fold_sql('r', 'n', 10)} AS fold FROM (
  SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) - 1 AS r, count(*) OVER () AS n FROM embeddings)""",
    "stratified_kfold_assign": O.with_ctes(_STRATA, "SELECT id, fold FROM strata"),
    "holdout_split": """SELECT vec_id AS id,
  ('0x' || substr(md5(vec_id::VARCHAR || ':42'), 1, 8))::BIGINT % 10 = 0 AS is_test FROM embeddings""",
    "text_round_trip": O.with_ctes(
        O.TRIPLES,
        """SELECT row_number() OVER (ORDER BY id) - 1 AS id,
  md5(array_to_string(h1, ' ') || '|' || array_to_string(h2, ' ') || '|' || array_to_string(ref, ' ')) AS digest
FROM triples""",
    ),
}
