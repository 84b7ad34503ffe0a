import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from versus.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=5, positives=5, negatives=3):
    """All pairs; rows are (id, vector, label) of equal lengths."""
    seen = {(i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, lab in rows
            if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, lab, v in seen:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, m) for b, m, w in seen if b != a)
        for s, p, _ in [x for x in scored if x[2] == lab][:positives]:
            fit = [(b, -t) for t, b, m in scored if m != lab and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, r + 1, b, -s, t) for r, (b, t) in enumerate(fit[:negatives])]
    return sorted(out)


def result(df, every=5):
    return sorted(map(tuple, ng.mine(df, F.col("id") % every == 0, F.col("label")).collect()))


def vectors(seed, n, d=20, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 2, d))
    own = rng.integers(0, len(centres), n)
    x = centres[own] + 0.6 * rng.normal(size=(n, d))
    x[rng.random(n) < 0.2] = x[0]  # ties
    return [(int(i), [float(y) for y in v], int(k % labels)) for i, v, k in zip(rng.permutation(n), x, own, strict=True)]


@pytest.mark.parametrize("seed, blocks", [(1, (16_384, 4_096, 128, 256)), (2, (40, 7, 3, 5)), (3, (17, 100, 128, 1))])
def test_against_all_pairs(spark, monkeypatch, seed, blocks):
    for name, value in zip(("ROWS", "ANCHORS", "BATCH", "SEED"), blocks, strict=True):
        monkeypatch.setattr(ng, name, value)
    rows = vectors(seed, 300)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_threshold_join_prunes_and_is_exact():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(500, 40)) / np.arange(1, 41))
    q, least = x[:20], np.full(20, 100_000.0)
    index = ng.Index(x)
    at, row, score = ng.threshold_join(index, q, least)
    full = q @ x.T
    assert sorted(zip(at, row, score, strict=True)) == sorted(
        (i, j, full[i, j]) for i, j in zip(*np.nonzero(full >= 100_000), strict=True)
    )
    most = (ng.remaining(q, index.cuts) / 100_000).max(0)
    lists = [len(p) for p in index.postings(most)]
    assert lists[-1] < lists[0] < 500  # dimensions covered by the bound are not indexed


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 2.5], 1), (None, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1),
        (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 2), (6, [2.0, 2.0], 1), (7, [1.0, 1.0], 2), (8, [1.0, 1.0], 2),
        (9, [0.0, 0.0], 2), (10, [-1.0, -2.0], 1), (11, [1.0, 1.0], None), (12, [-0.0, 0.0], 1), (15, [0.0, 0.0], 3),
        (16, [-1.0, 0.001], 3), (17, [1.2, 1.7], 2), (20, [3e5, 4e5], 1), (21, [3e5, 3e5], 1), (22, [2e5, 3e5], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == brute(rows)
    clash = df.selectExpr("*", "1 as id", "2 as v", "3 as a", "4 as b", "5 as blocks")
    assert result(clash) == brute(rows)
    assert result(df.limit(0)) == []
    short = spark.createDataFrame([(0, [1.0, 1.0], 1), (1, [1.0], 1), (2, [0.7], 2), (3, [], 2)], SCHEMA)
    assert result(short) == [(0, 1, 1, 2, 65536, 179 * 256)]


def test_large_numbers(spark):
    rows = [(i, [3e9 + 1e6 * i, 7e8 - 1e6 * i], i % 3 % 2) for i in range(12)]
    rows += [(20 + i, [1.5e9 + 1e6 * i, 4e8], 1) for i in range(4)]
    rows = [(i, [x / 400 for x in v], k) for i, v, k in rows]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_query_against_sql(spark, data_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{os.path.join(data_dir, 'embeddings.parquet')}')")
    expected = sorted(con.execute(ng.ORACLE["op13_hard_negatives"]).fetchall())
    got = sorted(map(tuple, ng.op13_hard_negatives(spark, data_dir).collect()))
    assert got == expected and expected
