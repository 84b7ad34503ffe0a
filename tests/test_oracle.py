"""A part of the registered queries against their oracle SQL, on the smallest tables."""

import math
import os

import pytest

from versus.plans import registry

duckdb = pytest.importorskip("duckdb")

CHECKED = [
    "meteor_scores",
    "classification_report",
    "invalid_judgements",
    "sweep_topk",
    "bleu_default",
    "bleu_smoothing_sweep",
    "freq_quartiles",
    "quartile_share",
    "char_ngram_prf",
    "word_length_stats",
    "synonym_match",
    "embed_corpus_idf",
    "anova_select",
    "knn_distance",
    "stratified_kfold_assign",
    "text_round_trip",
    "sgd_hinge",
    "knn_refit",
    "missing_grams",
]


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for name in os.listdir(data_dir):
        view = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{data_dir}/{name}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_oracle_belongs_to_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_oracle(spark, duck, data_dir, name):
    df = registry.QUERIES[name](spark, data_dir)
    result = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())
