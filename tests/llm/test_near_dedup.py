import random
import re

import pytest

from versus.llm import near_dedup as nd


def brute(rows, size, percent=80):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    s = [(d, shingles(t)) for d, t, *_ in rows]
    parent = {d: d for d, _ in s}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(s):
        for b, y in s[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a2, b2 = root(a), root(b)
                parent[max(a2, b2)] = min(a2, b2)
    return sorted((d, len(x), root(d), root(d) == d) for d, x in s)


def chained(seed, n):
    """Near copies of near copies: links that no common centre has."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(9)):
            text[rng.randrange(60)] = rng.choice(vocab)
        if rng.random() < 0.2:
            base = text
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    rows = chained(seed, 150) + [(1000 + i, t) for i, (_, t) in enumerate(chained(seed, 40))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, nd.near_duplicates(df, 2).collect())) == brute(rows, 2)


def test_query_against_all_pairs(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, nd.op10_near_dedup(spark, data_dir).collect()))
    assert got == brute([tuple(r) for r in docs], 2)


def test_odd_rows(spark):
    rows = [(3, None, 1), (1, "", 2), (2, "one", 3), (9, "ONE", 4), (None, "one", 5), (4, "a b " * 20000, 6), (5, "a b " * 20000, 7), (5, "a b " * 20000, 7), (6, " \t ", 8), (7, "a b c d", 9), (8, "a b c d e", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = {r.doc_id: tuple(r)[1:] for r in nd.near_duplicates(df).collect()}
    assert got[3] == (0, 3, True) and got[1] == (0, 1, True) and got[2] == (1, 2, True)
    assert got[9] == (1, 2, False) and got[None][1:] == (None, True)
    assert got[4] == (2, 4, True) and got[5] == (2, 4, False)
    assert got[7][1] == 7 and got[8][1] == 8
    assert nd.near_duplicates(df.limit(0)).collect() == []
    kept = nd.near_dedup_stage(spark, df, "")
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
