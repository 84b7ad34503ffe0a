"""Grams that travel as blobs: what a task holds is bounded, and counts stay exact."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from versus.operators import frequency as FQ
from versus.operators import packed as P

RNG = random.Random(5)
WORDS = ["a", "b", "c", "", "ä b", None, "z" * 300, "~"]
LISTS = [None if i % 11 == 0 else [RNG.choice(WORDS) for _ in range(RNG.randrange(9))] for i in range(80)]


def test_a_task_sums_no_more_tokens_than_a_chunk_or_one_row():
    """Also where one batch of rows holds many chunks."""
    lists = [["t"] * (i % 5) for i in range(60)] + [["t"] * 50]
    batches = [pa.record_batch([pa.array(lists), pa.array([False] * 61)], names=["t", "f"])] * 2
    sizes = [[len(t) for b in held for t in b.column(0).to_pylist()] for held in FQ._chunks(iter(batches), 12)]
    assert sum(map(len, sizes)) == 122
    assert all(sum(s) <= 12 or len(s) == 1 for s in sizes)


def test_blobs_give_back_what_was_packed():
    texts = pa.array(["x", None, "", "ä", "long " * 99, "x"]).slice(1)
    numbers = np.array([0, 300, 70_000, 1 << 40, 5])
    part = np.array([2, 0, 2, 0, 0])
    got = {}
    for p, blob in P.by_part(part, [numbers], texts):
        (sizes, values), data = P.unpack(blob)
        assert P.rows_of(blob) == len(sizes)
        got[p] = list(zip(values.tolist(), P.strings(data, np.maximum(sizes.astype(int) - 1, 0), sizes > 0).to_pylist()))
    want = {p: [(int(v), t) for q, v, t in zip(part, numbers, texts.to_pylist()) if q == p] for p in (0, 2)}
    assert got == want


@pytest.mark.parametrize("turns", [False, True])
def test_counts_of_parts_in_one_or_many_turns(spark, monkeypatch, turns):
    if turns:
        monkeypatch.setattr(FQ, "PART_WINDOWS", 7)
        monkeypatch.setattr(FQ, "PIECE_WINDOWS", 3)
        monkeypatch.setattr(FQ, "BATCH_ROWS", 2)
    monkeypatch.setattr(FQ, "CHUNK_TOKENS", 40)
    df = spark.createDataFrame(list(enumerate(LISTS)), "id bigint, t array<string>")
    want, flagged = Counter(), Counter()
    for i, t in enumerate(LISTS):
        for n in FQ.ORDERS:
            for w in zip(*[(t or [])[k:] for k in range(n)]):
                gram = n, None if None in w else " ".join(w)
                want[gram] += 1
                flagged[gram] += i % 3 == 1
    out = FQ.corpus_gram_counts(df, ["t"], flag=F.col("id") % 3 == 1).collect()
    assert {(r["n"], r["gram"]): (r["cnt"], r["n_flagged"]) for r in out} == {g: (want[g], flagged[g]) for g in want}
    assert len(out) == len(want)


def test_a_block_sends_a_part_one_blob_of_distinct_windows(spark):
    """No row per gram is shuffled, and equal windows of a block travel once."""
    rows = [(i, ["the", "cat", "sat"], ["the", "cat"]) for i in range(200)]
    flags = spark.createDataFrame(rows, "id bigint, h1 array<string>, h2 array<string>")
    blocks, n_blocks = FQ._blocks(flags.withColumns({"asked": F.lit(True), "counted": F.lit(True)}), ["h1", "h2"])
    sent = FQ._packed_requests(blocks, ["h1", "h2"], 2).collect()
    assert len(sent) <= 2 * n_blocks
    found, uses = Counter(), Counter()
    for r in sent:
        (sizes, k, _, _, cnt), data = P.unpack(r["blob"])
        for gram, size, c in zip(P.strings(data, sizes.astype(int) - 1).to_pylist(), k.tolist(), cnt.tolist()):
            found[r["block"], size, gram] += 1
            uses[gram] += c
    assert set(found.values()) == {1}
    assert uses == {"the": 400, "cat": 400, "sat": 200, "the cat sat": 200, "cat sat": 200, "the cat": 200}


@pytest.mark.parametrize("nulls", [False, True])
def test_quartiles_of_parts_equal_those_of_the_counts(spark, nulls):
    lists = [t for t in LISTS if t and (nulls or None not in t)]
    df = spark.createDataFrame(list(enumerate(lists)), "id bigint, t array<string>")
    freq = FQ.corpus_gram_counts(df, ["t"]).withColumn("bucket", FQ._bucket())
    cuts = FQ.quartile_cuts(freq, FQ.bucket_sizes(freq))
    rows = FQ._placed(freq, cuts).collect()
    n, cnt = (np.array([r[c] for r in rows]) for c in ("n", "cnt"))
    at = {r["n"]: FQ._bounds(r.asDict()) for r in cuts.collect()}
    got = FQ._quartiles(n, pa.array([r["gram"] for r in rows], "large_string"), cnt, at)
    assert got.tolist() == [r["quartile"] for r in rows] and len(set(got.tolist())) == 4
