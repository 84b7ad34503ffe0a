"""Validation, agreement, text readers, logs, sweeps."""

import os

import pytest
from pyspark.sql import functions as F

from versus.operators import judge as J
from versus.plans import sweeps as S
from versus.session import scratch_dir
from versus.sources import logs, tables, text


def write(path, name, content):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as out:
        out.write(content)


def test_validate_splits_rows(spark):
    raw = spark.createDataFrame([(0, "1"), (1, " -1 "), (2, "2"), (3, "x"), (4, None)], "id int, raw string")
    ok, bad = J.validate(raw)
    assert {r["id"]: r["pred"] for r in ok.collect()} == {0: 1, 1: -1}
    assert {r["id"]: r["reason"] for r in bad.collect()} == {
        2: "out of range", 3: "not an integer", 4: "not an integer"
    }


def test_length_mismatch_counts_exactly(spark):
    inputs, preds = spark.range(10), spark.range(3, 14)
    row = J.length_mismatch(inputs, preds).first()
    assert (row["n_inputs"], row["n_predictions"], row["n_missing"], row["n_extra"]) == (10, 11, 3, 4)


def test_confusion_accuracy_report(spark):
    preds = spark.createDataFrame([(0, 1), (1, 1), (2, -1), (3, None), (9, 0)], "id int, pred int")
    gold = spark.createDataFrame([(0, 1), (1, 0), (2, -1), (3, 1)], "id int, gold int")
    counts = J.gold_pred_counts(preds, gold)
    matrix = {r["gold"]: (r["pred_neg"], r["pred_zero"], r["pred_pos"]) for r in J.confusion(counts).collect()}
    assert matrix == {-1: (1, 0, 0), 0: (0, 0, 1), 1: (0, 0, 1)}
    acc = J.accuracy(counts).first()
    assert (acc["n_judged"], acc["n_right"], acc["n_undefined"]) == (3, 2, 1)
    assert acc["accuracy"] == pytest.approx(2 / 3)
    report = {r["label"]: r for r in J.classification_report(counts).collect()}
    assert report[1]["precision"] == 0.5 and report[1]["recall"] == 1.0
    assert report[0]["f_score"] == 0.0 and report[0]["support"] == 1
    assert J.accuracy(counts.where("false")).first()["accuracy"] is None


def test_triples_reader_rejects_and_numbers_lines(spark, tmp_path):
    folder = str(tmp_path / "t")
    write(folder, "a.txt", "a  b ||| c ||| d\nbad line\n ||| x ||| (y z).\n")
    write(folder, "b.txt", "p ||| q ||| r\n")
    rows, rejects = text.read_triples(spark, folder)
    got = {r["id"]: (r["h1"], r["h2"], r["ref"]) for r in rows.collect()}
    assert got == {
        0: (["a", "b"], ["c"], ["d"]),
        2: ([], ["x"], ["(y", "z)."]),
        3: (["p"], ["q"], ["r"]),
    }
    assert [(r["id"], r["value"]) for r in rejects.collect()] == [(1, "bad line")]
    stripped, _ = text.read_triples(spark, folder, "stripped")
    assert {r["id"]: r["ref"] for r in stripped.collect()}[2] == "y z"


def test_line_ids_across_splits(spark, tmp_path):
    folder = str(tmp_path / "n")
    write(folder, "1.txt", "".join(f"{i}\n" for i in range(5000)))
    write(folder, "2.txt", "".join(f"{i}\n" for i in range(5000, 6000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = text.read_lines(spark, folder)
        assert rows.where(F.col("id") != F.col("value").cast("long")).count() == 0
        assert rows.count() == 6000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_labels_and_judgement_round_trip(spark):
    path = scratch_dir(spark)
    df = spark.range(100).select("id", (F.col("id") % 3 - 1).cast("int").alias("pred"))
    tables.save_judgements(df.repartition(5), f"{path}/text", "text")
    back = text.read_judgements(spark, f"{path}/text")
    assert back.join(df, "id").where("gold <> pred").count() == 0 and back.count() == 100
    tables.save_judgements(df, f"{path}/table")
    assert tables.load_judgements(spark, f"{path}/table").count() == 100


def test_vectors_round_trip(spark):
    path = scratch_dir(spark)
    df = spark.createDataFrame([(1, [0.5, -1.0]), (2, [2.0, 3.0])], tables.VECTOR_SCHEMA)
    tables.save_vectors(df, path)
    assert sorted(tables.load_vectors(spark, path).collect()) == sorted(df.collect())


def test_word_vectors_last_duplicate_wins(spark, tmp_path):
    folder = str(tmp_path / "v")
    write(folder, "v.txt", "a 1 2\nb 3 4\na 5 6\nc 1 oops\nd\n\n")
    good, bad = text.read_word_vectors(spark, folder)
    assert {r["word"]: list(r["vec"]) for r in good.collect()} == {"a": [5.0, 6.0], "b": [3.0, 4.0]}
    assert {r["value"] for r in bad.collect()} == {"c 1 oops", "d"}


def test_sweep_log_and_ranking(spark, tmp_path):
    values = [(0.5, 0.7), (0.6, 0.9), (0.7, 0.9), (0.8, 0.1)]
    log = "".join(
        f"Alpha: {a}\nAccuracy = {acc:.6f}\n\n{logs.BLOCK_END}\n" for a, acc in values
    )
    write(str(tmp_path / "log"), "x", log)
    parsed = logs.read_sweep_log(spark, str(tmp_path / "log"))
    best = S.best_settings(parsed, 3, "id").collect()
    assert [(r["alpha"], r["accuracy"]) for r in best] == [(0.6, 0.9), (0.7, 0.9), (0.5, 0.7)]


def test_sweep_point_equals_single_run(spark, triples):
    rows = [("a b", "a", "a b c"), ("x", "a c", "a b"), ("a", "a", "a"), ("b", "a b x y", "a b")]
    gold = spark.createDataFrame([(0, 1), (1, -1), (2, 0), (3, 1)], "id bigint, gold int")
    counts = J.overlap_counts(triples(rows))
    sweep = S.meteor_alpha_sweep(counts, gold, "id", S.fractions(1, 10, 2, 10))
    got = {r["alpha"]: r["accuracy"] for r in sweep.collect()}
    assert sorted(got) == [0.1, 0.3, 0.5, 0.7, 0.9]
    for alpha, accuracy in got.items():
        single = J.accuracy(J.gold_pred_counts(J.score_meteor(counts, alpha), gold)).first()
        assert single["accuracy"] == accuracy


def test_bleu_sweeps_equal_single_runs(spark, triples):
    rows = [("a b c d e", "a b d e", "a b c d e f"), ("a", "b a", "a b"), ("a b c", "c b a", "a b c d")]
    gold = spark.createDataFrame([(0, 1), (1, -1), (2, 1)], "id bigint, gold int")
    counts = J.bleu_counts(triples(rows))
    smooth = {r["technique"]: r for r in S.bleu_smoothing_sweep(counts, gold, "id").collect()}
    for technique, row in smooth.items():
        one = J.score_bleu_smoothed(counts, technique, technique)
        single = J.accuracy(J.gold_pred_counts(one, gold)).first()
        assert (single["n_judged"], single["n_right"]) == (row["n_judged"], row["n_right"])
    orders = {r["max_n"]: r["n_right"] for r in S.bleu_order_sweep(counts, gold, "id").collect()}
    single = J.accuracy(J.gold_pred_counts(J.score_bleu(counts, 2), gold)).first()
    assert orders[2] == single["n_right"] and len(orders) == 4


def test_validation_works_out_a_judgement_once(spark):
    rows = spark.range(6).select("id", F.reverse(F.element_at(F.array(*map(F.lit, ["1", "2", "x", " 0", None, "1-"])), F.col("id").cast("int") + 1)).alias("raw"))
    valid, errors = J.validate(rows)
    assert {r["id"]: r["pred"] for r in valid.collect()} == {0: 1, 3: 0, 5: -1}
    assert {r["id"]: r["reason"] for r in errors.collect()} == {1: "out of range", 2: "not an integer", 4: "not an integer"}
    for out in (valid, errors):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1
