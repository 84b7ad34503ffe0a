"""Shares by blocks of sentences, and words counted inside their row."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from versus.operators import embed as EM
from versus.operators import frequency as FQ

KIND = "id bigint, h1 array<string>, h2 array<string>"
ROWS = [
    (1, ["a", "b", "a", "b"], ["a b", "c"]),
    (1, ["a"], None),
    (2, ["a", "b c"], []),
    (3, ["a", "b", "a", "b", "c"], ["b", None, "a", "b"]),
    (None, ["c", "a", "b"], ["z"]),
    (None, ["q"], ["a"]),
]


def grams(tokens):
    for n in FQ.ORDERS:
        for i in range(len(tokens or []) - n + 1):
            window = tokens[i : i + n]
            yield n, None if None in window else " ".join(window)


def expected(asked, counted):
    counts = Counter(g for _, *sides in counted for t in sides for g in grams(t))
    distinct = Counter(n for n, _ in counts)
    sums = Counter()
    for i, *sides in asked:
        for side, tokens in zip(("h1", "h2"), sides):
            sums.update({(i, side, n): 0 for n in FQ.ORDERS})
            for n, g in grams(tokens):
                sums[i, side, n] += counts[n, g] if g is not None else 0
    return {k: v / distinct[k[2]] if distinct[k[2]] else None for k, v in sums.items()}


def found(out):
    return {(r["id"], r["side"], n): r["share"][n - 1] for r in out.collect() for n in FQ.ORDERS}


@pytest.mark.parametrize("tokens", [FQ.BLOCK_TOKENS, 3])
def test_shares_of_blocks_equal_counts_by_hand(spark, monkeypatch, tokens):
    monkeypatch.setattr(FQ, "BLOCK_TOKENS", tokens)
    df = spark.createDataFrame(ROWS, KIND)
    assert found(FQ.corpus_shares(df)) == pytest.approx(expected(ROWS, ROWS))
    even = [r for r in ROWS if r[0] == 2]
    odd = [r for r in ROWS if r[0] in (1, 3)]
    parts = FQ.corpus_shares(df, asked=F.col("id") % 2 == 1, counted=F.col("id") % 2 == 0)
    assert found(parts) == pytest.approx(expected(odd, even))


@pytest.mark.parametrize("nulls", [True, False])
def test_shares_of_the_corpus_equal_shares_of_its_stored_frequencies(spark, nulls):
    plain = [(i, [t for t in a if t], [t for t in b or [] if t]) for i, a, b in ROWS]
    df = spark.createDataFrame(ROWS if nulls else plain, KIND)
    freq = FQ.build_frequencies(df)
    want = sorted(map(str, FQ.corpus_shares(df, parity_denominator=False).collect()))
    for options in ({}, {"max_broadcast_rows": 0}):
        out = FQ.shares(df, freq, parity_denominator=False, **options)
        assert sorted(map(str, out.collect())) == want


def test_a_block_asks_for_a_gram_once(spark):
    rows = [(i, ["the", "cat", "sat"], ["the", "cat"]) for i in range(200)]
    flags = spark.createDataFrame(rows, KIND).withColumns({"asked": F.lit(True), "counted": F.lit(True)})
    blocks, n_blocks = FQ._blocks(flags, ["h1", "h2"])
    asked = FQ._requests(blocks, ["h1", "h2"])
    assert asked.count() <= 6 * n_blocks
    assert asked.groupBy("n", "gram").agg(F.sum("cnt").alias("c")).where("gram = 'the cat'").first()["c"] == 400


def test_only_words_of_shared_ids_leave_their_row(spark, monkeypatch):
    kind = "id bigint, h1 array<string>, h2 array<string>, ref array<string>"
    rows = [(1, ["a", "b", "a", None], ["b"], ["b", "c"]), (2, [], None, []), (3, ["x"], ["y"], None),
            (4, ["a"], ["b"], ["c"]), (4, ["b"], ["b"], ["b"]), (None, ["n"], [], ["n"])]
    df = spark.createDataFrame(rows, kind)
    bags = EM.row_idf(EM.word_bags(df)).where("word IS NOT NULL")
    w = F.col("weight")
    want = bags.groupBy("id").agg(F.count(F.lit(1)), F.min(w), F.max(w), F.sum(w)).collect()
    out = {r[0]: list(r)[1:] for r in EM.row_idf_summary(df).collect()}
    assert set(out) == {r[0] for r in want} == {1, 3, 4, None}
    for r in want:
        assert out[r[0]] == pytest.approx(list(r)[1:])
    monkeypatch.setattr(EM, "word_bags", None)
    assert EM.row_idf_summary(df.where("id <> 4")).count() == 2
