"""Frequencies, features, embeddings, neighbours, folds, models and the stream."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from versus.functions.tokens import word_tokens
from versus.functions.vectors import interleave
from versus.operators import embed as EM
from versus.operators import features as FX
from versus.operators import frequency as FQ
from versus.operators import judge as J
from versus.operators import knn as K
from versus.operators import lexical as L
from versus.operators import lookup as LK
from versus.operators import models as M
from versus.operators import rank as R
from versus.operators import scaling as SC
from versus.operators.lookup import lookup
from versus.session import materialize, scratch_dir


def test_quartiles_cut_at_truncated_boundaries(spark):
    rows = [(1, f"g{i}", i) for i in range(1, 11)] + [(2, f"t{i:03d}", 1) for i in range(101)]
    freq = spark.createDataFrame(rows, "n int, gram string, cnt bigint")
    out = FQ.with_quartiles(materialize(freq)).groupBy("n", "quartile").count().collect()
    sizes = {(r["n"], r["quartile"]): r["count"] for r in out}
    assert [sizes[1, q] for q in (1, 2, 3, 4)] == [2, 3, 2, 3]
    assert [sizes[2, q] for q in (1, 2, 3, 4)] == [25, 25, 25, 26]


def test_lookup_with_hot_keys_equals_broadcast(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("word")
    )
    table = materialize(
        spark.range(40).select(F.concat(F.lit("w"), F.col("id")).alias("word"), "id").withColumnRenamed("id", "v")
        .unionAll(spark.createDataFrame([("hot", 7)], "word string, v bigint"))
    )
    for how in ("inner", "left"):
        small = lookup(rows, table, ["word"], how)
        large = lookup(rows, table, ["word"], how, max_broadcast_rows=5)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.select(small.columns).collect()))


def test_lookup_with_many_entries_and_null_keys(spark, monkeypatch):
    """A hot key with more entries than a broadcast may hold, rows without a key, one pass."""
    monkeypatch.setattr(LK, "MAX_ENTRIES", 3)
    rows = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "few").alias("word")
    )
    table = materialize(
        spark.range(12).select(F.lit("hot").alias("word"), F.col("id").alias("v"))
        .unionAll(spark.range(2).select(F.lit("few"), F.col("id")))
    )
    for how, size in (("inner", 200 * 14), ("left", 200 * 15)):
        small = lookup(rows, table, ["word"], how)
        large = lookup(rows, table, ["word"], how, max_broadcast_rows=5)
        narrow = lookup(rows, table, ["word"], how, max_broadcast_bytes=100)
        want = sorted(map(str, small.collect()))
        assert len(want) == size
        assert sorted(map(str, large.select(small.columns).collect())) == want
        assert sorted(map(str, narrow.select(small.columns).collect())) == want


def test_frequencies_store_and_shares(spark, triples):
    df = triples([("a b a b", "a a", "x"), ("a b c", "", "x")])
    freq = FQ.build_frequencies(df)
    counts = {(r["n"], r["gram"]): r["cnt"] for r in freq.collect()}
    assert counts[1, "a"] == 5 and counts[2, "a b"] == 3 and (1, "x") not in counts
    path = scratch_dir(spark)
    FQ.save_frequencies(freq, path)
    loaded = FQ.load_frequencies(spark, path)
    assert sorted(map(str, loaded.collect())) == sorted(map(str, freq.select(loaded.columns).collect()))
    out = {(r["id"], r["side"]): r for r in FQ.shares(df, loaded, max_broadcast_rows=1).collect()}
    assert out[0, "h1"]["share"][0] == pytest.approx((5 + 3 + 5 + 3) / 3)
    assert list(out[1, "h2"]["share"]) == [0, 0, 0, 0]
    assert len(out[0, "h1"]["quartile_share"]) == 16


def test_tags_by_list_and_by_table_agree(spark, triples):
    df = triples([("the cats sat , 12 !", "running", "who knows ?"), ("", "x", "of")])
    built_in = L.with_tags(df, list(FX.SIDES))
    words = [(w, t) for t, ws in L.LEXICON.items() for w in ws]
    table = materialize(spark.createDataFrame(words, "token string, tag string"))
    joined = L.with_lexicon_tags(df, table, list(FX.SIDES))
    cols = ["id", "h1_tags", "h2_tags", "ref_tags"]
    assert sorted(map(str, built_in.select(cols).collect())) == sorted(map(str, joined.select(cols).collect()))
    assert built_in.where("id = 0").first()["h1_tags"] == ["DT", "NNS", "NN", ",", "CD", "."]


def test_rows_of_an_id_share_tags_others_stay_in_their_row(spark, monkeypatch):
    kind = "id bigint, h1 array<string>, h2 array<string>, ref array<string>"
    rows = [(1, ["the", "x9", None], ["cat"], ["sits"]), (2, ["a", "b"], ["b~"], ["b"]), (2, ["c"], None, ["c~", "a"]),
            (3, None, None, None), (None, ["the", "q"], ["q"], ["r"]), (4, ["z", "y", "z"], ["y"], ["zz", "za", None])]
    df = spark.createDataFrame(rows, kind)
    lexicon = materialize(spark.createDataFrame([("the", "DT"), ("x9", "ODD"), ("cat", None)], "token string, tag string"))

    def found(out):
        return sorted(map(str, out.collect()))

    tags = L.with_lexicon_tags(df, lexicon, ["h1", "h2", "ref"])
    assert found(tags) == found(L._joined_tags(df, lexicon, ["h1", "h2", "ref"]))
    # rows of their own ids: no token leaves its row
    monkeypatch.setattr(L, "_joined_tags", None)
    assert L.with_lexicon_tags(df.where("id <> 2"), lexicon, ["h1"]).where("id = 1").first()["h1_tags"] == ["DT", "ODD", "NN"]


def test_split_and_synonyms(spark, triples):
    df = triples([("big cat cat dog", "a large", "a large cat")])
    row = L.match_split(df).first()
    assert (row["h1_in"], row["h1_out"]) == (["cat", "cat"], ["big", "dog"])
    assert (row["ref_in"], row["ref_out"]) == (["a", "large", "cat"], [])
    syn = materialize(
        spark.createDataFrame([("big", "large"), ("big", "huge"), ("dog", "hound")], "word string, syn string")
    )
    row = L.synonym_split(df, syn).first()
    assert row["h1"] == ["large", "cat", "cat", "dog"] and row["h1_out"] == ["dog"]
    row = L.synonym_split(df, syn, max_broadcast_rows=1).first()
    assert row["h1_in"] == ["large", "cat", "cat"]


def test_feature_vector_layout(spark):
    text = spark.createDataFrame(
        [(0, "the cat sat.", "a dog ran", "the cat ran."), (1, "x", "y z", "x y")],
        "id bigint, h1_text string, h2_text string, ref_text string",
    )
    df = text.withColumns({s: word_tokens(F.col(f"{s}_text")) for s in FX.SIDES})
    df = materialize(df)
    out = {r["id"]: r["features"] for r in FX.feature_vector(df, FQ.build_frequencies(df)).collect()}
    assert {len(v) for v in out.values()} == {120}
    hyp, ref = "the cat sat.", "the cat ran."
    common = sum((Counter(hyp) & Counter(ref)).values())
    assert out[0][0] == pytest.approx((common + 1) / (len(hyp) + 1))
    # Word, function, punctuation, content difference of the second hypothesis (one token short).
    assert out[0][2 * 13 + 1] == pytest.approx(1 / 4)
    assert out[0][2 * 15 + 1] == pytest.approx(1 / 4)
    assert list(out[0][114:]) == pytest.approx([3 / 4, 1 / 4, 1 / 4, 2 / 4, 4 / 4, 0])


def test_interleave(spark):
    row = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], [5.0, 6.0])], "a array<double>, b array<double>, c array<double>")
    cols = [F.col(c) for c in "abc"]
    got = row.select(interleave(*cols[:2]).alias("p"), interleave(*cols).alias("t")).first()
    assert list(got["p"]) == [1, 3, 2, 4] and list(got["t"]) == [1, 3, 5, 2, 4, 6]


def test_embedding_modes_equal_recomputation(spark, triples):
    data = [("a b b", "q", "a c"), ("c c", "a a q", "b")]
    vec = {"a": np.array([1.0, 2.0]), "b": np.array([-1.0, 0.5]), "c": np.array([0.0, 3.0])}
    table = materialize(
        spark.createDataFrame([(w, v.tolist()) for w, v in vec.items()], "word string, vec array<double>")
    )
    df = triples(data)
    docs = [s.split() for row in data for s in row]

    def idf(corpus):
        n = len(corpus)
        seen = {w for s in corpus for w in s}
        return {w: math.log((1 + n) / (1 + sum(w in s for s in corpus))) + 1 for w in seen}

    def mean(tokens, weight):
        known = [vec[t] * weight.get(t, 1) for t in tokens if t in vec]
        return np.mean(known, axis=0) if known else np.zeros(2)

    whole = idf(docs)
    for mode in (1, 2, 3):
        out = {r["id"]: np.array(r["features"]) for r in EM.embed(df, table, 2, mode).collect()}
        for i, row in enumerate(data):
            sides = [s.split() for s in row]
            weight = {1: {}, 2: idf(sides), 3: whole}[mode]
            parts = [mean(s, weight) for s in sides]
            want = np.stack(parts).T.ravel() if mode == 1 else np.concatenate(parts)
            assert out[i] == pytest.approx(want)
    fitted = EM.TfidfEmbedding(table, 2).fit(df)
    stage = {r["id"]: list(r["features"]) for r in fitted.transform(df).collect()}
    direct = {r["id"]: list(r["features"]) for r in EM.embed(df, table, 2, 3).collect()}
    assert all(stage[i] == pytest.approx(v) for i, v in direct.items())


def points(seed, n, dim=4, copies=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, dim)), 2)
    if copies:
        x[:copies] = x[0]
    return [(i, x[i].tolist(), int(i % 3)) for i in range(n)], x


SCHEMA = "id bigint, features array<double>, label int"


@pytest.mark.parametrize("metric", ["euclidean", "chebyshev"])
def test_knn_equals_brute_force_with_many_copies(spark, metric):
    rows, x = points(5, 150, copies=50)
    df = materialize(spark.createDataFrame(rows, SCHEMA))
    queries, train = df.where("id % 4 = 0"), df.where("id % 4 <> 0")
    out = K.knn_join(queries, train, 5, metric, block=7).collect()
    got = {}
    for r in out:
        got.setdefault(r["id"], {})[r["rank"]] = r["train_id"]
    pool = [i for i in range(150) if i % 4]
    for q in range(0, 150, 4):
        diff = x[pool] - x[q]
        dist = np.sqrt((diff**2).sum(axis=1)) if metric == "euclidean" else np.abs(diff).max(axis=1)
        want = [i for _, i in sorted(zip(np.round(dist, 9), pool))[:5]]
        assert [got[q][k] for k in range(1, 6)] == want


def test_mahalanobis_equals_brute_force(spark):
    rows, x = points(6, 80)
    df = materialize(spark.createDataFrame(rows, SCHEMA))
    queries, train = df.where("id < 10"), df.where("id >= 10")
    white_train, white_queries = (materialize(d) for d in K.whiten(train, queries, dim=4))
    out = K.knn_join(white_queries, white_train, 3, block=9).where("rank = 1").collect()
    inverse = np.linalg.inv(np.cov(x[10:].T))
    for r in out:
        diff = x[10:] - x[r["id"]]
        dist = np.sqrt(np.einsum("ij,jk,ik->i", diff, inverse, diff))
        assert r["train_id"] == 10 + int(dist.argmin())
        assert r["dist"] == pytest.approx(dist.min(), abs=1e-6)


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 10, 2, 0.0), (1, 11, 1, 0.5), (1, 12, 1, 0.5), (2, 10, 2, 1.0), (2, 11, 1, 1.0)],
        "id int, train_id int, label int, dist double",
    )
    assert {r["id"]: r["pred"] for r in K.vote(near).collect()} == {1: 1, 2: 1}
    assert {r["id"]: r["pred"] for r in K.vote(near, "distance").collect()} == {1: 2, 2: 1}


def test_folds_and_scaling(spark):
    rows, _ = points(7, 23)
    df = spark.createDataFrame(rows, SCHEMA)
    folds = {r["id"]: r["fold"] for r in R.kfold(df, 5).collect()}
    assert [folds[i] for i in range(23)] == [f for f, n in enumerate((5, 5, 5, 4, 4)) for _ in range(n)]
    strata = R.stratified_kfold(df, 3).groupBy("label", "fold").count().collect()
    assert {(r["label"], r["fold"]): r["count"] for r in strata}[0, 0] == 3
    flat = spark.createDataFrame([(0, [1.0, 5.0], 0), (1, [3.0, 5.0], 1)], SCHEMA)
    out = {r["id"]: list(r["features"]) for r in SC.scale_and_normalize(flat, 2).collect()}
    assert out == {0: [0.0, 0.0], 1: [1.0, 0.0]}


def test_models_fit_store_and_predict(spark):
    rng = random.Random(3)
    rows = [
        (i, [float(c) + rng.gauss(0, 0.1), -float(c), rng.random()], c)
        for i in range(60)
        for c in [i % 3 - 1]
    ]
    df = R.kfold(spark.createDataFrame(rows, SCHEMA), 3)
    df = materialize(df)
    classes = [-1, 0, 1]
    model = M.pipeline("decision_tree", 3, 3, 0.7).fit(M.to_ml(df, classes))
    path = scratch_dir(spark)
    M.save_model(model, path)
    for refit in (False, True):
        pred = M.predict(M.load_model(path), df, classes, refit).join(df, "id")
        assert pred.where("pred = label").count() >= 57
    ovo = M.one_vs_one(df, df, classes).join(df, "id")
    assert ovo.where("pred = label").count() >= 57
    settings = M.tree_settings(classes, (34, 100))
    scores, best, name = M.search(df, classes, settings, ("accuracy", "macro_recall"), 2)
    assert len(scores) == 4 and max(s[2] for s in scores) > 0.9
    assert name == max((s for s in scores if s[1] == "accuracy"), key=lambda s: s[2])[0]
    assert M.predict(best, df, classes).join(df, "id").where("pred = label").count() >= 57
    table = spark.createDataFrame(scores, "setting string, metric string, mean double, std double")
    assert M.best_setting(table.where("metric = 'accuracy'")).first()["setting"] == name
    counts = np.array([[3, 1, 0], [2, 2, 0], [0, 0, 0]])
    assert M.METRICS["macro_precision"](counts) == pytest.approx((3 / 5 + 2 / 3) / 2)
    assert M.METRICS["macro_recall"](counts) == pytest.approx((3 / 4 + 2 / 4) / 2)


def test_knn_grid_selects_by_fold(spark):
    """Against a loop that fits the selection on the rows outside each fold."""
    rng = np.random.default_rng(5)
    label = rng.integers(0, 3, 60)
    x = rng.normal(size=(60, 6)) + label[:, None] * np.array([2, 0, 1, 0, 0.5, 0])
    df = spark.createDataFrame([(i, x[i].tolist(), int(label[i])) for i in range(60)], SCHEMA)
    folded = materialize(R.kfold(df, 5))
    fold = {r.id: r.fold for r in folded.collect()}
    metrics = {"l2": K.Metric(2), "w": K.minkowski(3, [1, 2, 3, 4, 5, 6]), "s": "seuclidean", "m": "mahalanobis"}
    got = {}
    for r in K.grid_neighbours(folded, 6, [50, 100], metrics, 3, block=11).collect():
        got.setdefault((r["percentile"], r["metric"], r["id"]), []).append((r["rank"], r["train_id"]))
    for f in range(5):
        rest = [i for i in range(60) if fold[i] != f]
        t = x[rest]
        groups = [t[label[rest] == c] for c in range(3)]
        between = sum(len(g) * (g.mean(0) - t.mean(0)) ** 2 for g in groups) / 2
        within = sum(((g - g.mean(0)) ** 2).sum(0) for g in groups) / (len(rest) - 3)
        score = between / within
        for p in (50, 100):
            dims = np.flatnonzero(score > np.percentile(score, 50)) if p == 50 else np.arange(6)
            inverse = np.linalg.inv(np.cov(t[:, dims].T))
            for i in (i for i in range(60) if fold[i] == f):
                d = t[:, dims] - x[i, dims]
                w = np.arange(1, 7)[dims]
                want = {
                    "l2": (d**2).sum(1), "w": (np.abs(d * w) ** 3).sum(1),
                    "s": ((d / t[:, dims].std(0, ddof=1)) ** 2).sum(1), "m": ((d @ inverse) * d).sum(1),
                }
                for m, dist in want.items():
                    near = [rest[j] for j in np.argsort(dist)[:3]]
                    assert [t_id for _, t_id in sorted(got[p, m, i])] == near


def test_a_grid_task_returns_a_bounded_number_of_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist(), i % 3) for i in range(40)], SCHEMA)
    folded = materialize(R.kfold(df, 4))
    metrics = {"l2": K.Metric(2), "s": "seuclidean"}
    want = sorted(map(str, K.grid_neighbours(folded, 4, [50, 100], metrics, 3).collect()))
    blocks, in_blocks = [], K._in_blocks

    def watched(queries, train, block, asked=None):
        blocks.append(asked)
        return in_blocks(queries, train, block, asked)

    monkeypatch.setattr(K, "_in_blocks", watched)
    monkeypatch.setattr(K, "RESULTS", 2 * 2 * 3 * 5)
    assert sorted(map(str, K.grid_neighbours(folded, 4, [50, 100], metrics, 3).collect())) == want
    assert blocks == [5] and len(want) == 2 * 2 * 3 * 40


def test_stream_equals_batch(spark, data_dir):
    from versus.plans import registry

    stream = registry.QUERIES["stream_confusion"](spark, data_dir).collect()
    batch = registry.QUERIES["confusion_matrix"](spark, data_dir).collect()
    assert sorted(stream) == sorted(batch)
    assert sum(sum(r[1:]) for r in batch) > 0
    assert J.LABELS == (-1, 0, 1)


def test_stream_reads_a_table_stored_as_a_folder(spark, data_dir):
    from versus.plans import registry

    folder = scratch_dir(spark)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{data_dir}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    stream = registry.QUERIES["stream_confusion"](spark, folder).collect()
    batch = registry.QUERIES["confusion_matrix"](spark, data_dir).collect()
    assert sorted(stream) == sorted(batch)


def test_sentence_counts_stay_in_the_row(spark):
    """Rows of one id are merged, empty and null arrays and tokens are kept apart; other rows are not shuffled."""
    rows = [(1, ["a", "b", "a", "b"], ["x"]), (1, ["a"], []), (2, ["c", None, "c"], None), (None, ["a", "a"], ["x"])]
    df = spark.createDataFrame(rows, "id bigint, h1 array<string>, h2 array<string>")
    out = {tuple(r)[:4]: r["cnt"] for r in FQ.sentence_gram_counts(df, ["h1", "h2"], 2).collect()}
    want = Counter()
    for i, *sides in rows:
        for side, t in zip(("h1", "h2"), sides):
            for n in (1, 2):
                for w in zip(*[(t or [])[k:] for k in range(n)]):
                    want[i, side, n, None if None in w else " ".join(w)] += 1
    assert out == want
    alone = FQ.sentence_gram_counts(df.where("id = 2"), ["h1", "h2"], 2)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()


def test_corpus_counts_send_one_row_per_window(spark, monkeypatch):
    tokens = [["a", "b", "c", "a", "b", "c"], ["a b", "c"], ["a", "b c"], ["", None, "a"], [], None]
    df = spark.createDataFrame(list(enumerate(tokens)), "id bigint, t array<string>")
    want, flagged = Counter(), Counter()
    for i, t in enumerate(tokens):
        for n in (1, 2, 3):
            for w in zip(*[(t or [])[k:] for k in range(n)]):
                gram = n, None if None in w else " ".join(w)
                want[gram] += 1
                flagged[gram] += i % 2
    for chunk in (FQ.CHUNK_TOKENS, 2):
        monkeypatch.setattr(FQ, "CHUNK_TOKENS", chunk)
        out = FQ.corpus_gram_counts(df, ["t"], 3, flag=F.col("id") % 2 == 1).collect()
        assert {(r["n"], r["gram"]): (r["cnt"], r["n_flagged"]) for r in out} == {g: (want[g], flagged[g]) for g in want}
    batch = FQ._sum_windows(
        [pa.record_batch([pa.array([["a", "b", "c"]] * 5), pa.array([False] * 5)], names=["t", "f"])], 3
    ).to_pydict()
    assert sorted(zip(batch["n"], batch["gram"], batch["cnt"])) == [
        (-3, "a b c", 5), (-2, "b c", 5), (1, "a", 5), (1, "b", 5), (1, "c", 5)
    ]


def test_vectors_travel_once_for_a_part_and_word(spark, monkeypatch):
    """Means against a plain recomputation: ids that repeat or are null, words with several vectors,
    null tokens, arrays and numbers, short vectors, batches that split an id. Triples are not exploded
    into rows that carry vectors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rng = random.Random(3)
    words = ["a", "b", "c", "d", "", "unknown", None]
    side = lambda: None if rng.random() < 0.1 else [rng.choice(words) for _ in range(rng.randrange(6))]
    rows = [(rng.choice([None, *range(25)]), side(), side(), side()) for _ in range(60)]
    vec = [("a", [1.0, 2.0]), ("a", [3.0, None]), ("b", [0.5]), ("c", None), ("d", [-1.0, 4.0]), ("", [9.0, 9.0])]
    weights = {"a": 2.0, "b": 3.0, "c": 1.0, "d": 0.5, "": 1.0}
    df = spark.createDataFrame(rows, "id bigint, h1 array<string>, h2 array<string>, ref array<string>")
    table = spark.createDataFrame(vec, "word string, vec array<double>")
    scaled = spark.createDataFrame([(w, v, weights[w]) for w, v in vec], "word string, vec array<double>, weight double")
    triples = {i: [[t for r in rows if r[0] == i for t in r[k] or []] for k in (1, 2, 3)] for i in {r[0] for r in rows}}
    for mode, got in (
        (1, EM.sentence_vectors(df, table, 2)),
        (2, EM.sentence_vectors(df, table, 2, weighted_rows=True)),
        (3, EM.sentence_vectors(df, scaled, 2)),
    ):
        got = got.collect()
        assert len(got) == len(triples)
        for r in got:
            for k, t in enumerate(triples[r["id"]]):
                met = [(w, v) for w in t for x, v in vec if x == w and v is not None]
                weight = lambda w: (1.0, math.log(4 / (1 + sum(w in s for s in triples[r["id"]]))) + 1, weights[w])[mode - 1]
                for j in (0, 1):
                    given = [v[j] * weight(w) for w, v in met if j < len(v) and v[j] is not None]
                    want = sum(given) / len(met) if given else None if met else 0.0
                    assert r[1 + k][j] == (None if want is None else pytest.approx(want))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    none = EM.sentence_vectors(df, table.where("false"), 2).collect()
    assert len(none) == len(triples) and all(r["h1"] == [0.0, 0.0] for r in none)
    plan = EM.sentence_vectors(df, table, 2)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "sum(" not in plan
