"""Work that is done on batches of rows, or inside a row: matches, tags, IDF."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from versus.functions import matching as M
from versus.operators import embed as EM
from versus.operators import lexical as L

ROWS = [(1, ["a", "b", "a"], ["b"], ["a"]), (2, [], None, ["c"]), (3, [], [], []), (4, ["d"], ["d"], ["d", "é"])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, h1 array<string>, h2 array<string>, ref array<string>")


def clipped(a, b, n):
    def grams(t):
        return Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))

    return sum((grams(a) & grams(b)).values())


@pytest.mark.parametrize("characters", [False, True])
@pytest.mark.parametrize("chunk", [1, 50, 64_000])
def test_matches_do_not_depend_on_how_rows_are_cut(monkeypatch, characters, chunk):
    monkeypatch.setattr(M, "CHUNK", chunk)
    rng = random.Random(7)
    alphabet = "ab日é" if characters else ["x", "y", "z", "long", "日本"]
    sides = [[rng.choices(alphabet, k=rng.choice([0, 1, 3, 40, 300])) for _ in range(30)] for _ in range(3)]
    if characters:
        arrays = [pa.array(["".join(r) for r in s]) for s in sides]
    else:
        arrays = [pa.array(s, pa.list_(pa.string())) for s in sides]
    out = M.matcher(4, 192, characters)(*arrays).to_pylist()
    for i, row in enumerate(out):
        for h in (0, 1):
            assert row[f"m{h}"] == [clipped(sides[h][i], sides[2][i], n) for n in range(1, 5)]


def test_many_different_characters_are_numbered_anew():
    text = ["".join(map(chr, range(0x4E00, 0x4E00 + 20_000)))] * 2
    out = M.matcher(4, 192, True)(pa.array(text), pa.array(text)).to_pylist()
    assert out[1]["m0"] == [20_000, 19_999, 19_998, 19_997]


def test_a_missing_side_has_no_matches():
    kind = pa.list_(pa.string())
    long = ["t"] * 5
    args = [pa.array([None, None, ["t"]], kind), pa.array([["t"], long, None], kind)]
    assert [r["m0"] for r in M.matcher(2, 4, False)(*args).to_pylist()] == [[None, 0], [0, 0], [None, 0]]


def test_tags_of_distinct_tokens_equal_the_expression(spark):
    tokens = ["the", ".", ",", ";", "12", "12\n", "x\r\n", "€", "running", "red", "s", "", None, " ", "€\n", "the"]
    df = spark.createDataFrame([(1, tokens), (2, None), (3, [])], "id int, t array<string>")
    tags = L.tags_of(F.col("t"))
    assert df.where(~tags.eqNullSafe(F.transform("t", L.tag_token))).count() == 0
    assert "ArrowEvalPython" in df.select(tags)._jdf.queryExecution().executedPlan().toString()


def test_character_idf_needs_no_bags(spark):
    df = frame(spark, [*ROWS, (4, ["", "dd"], [], ["ad"])])
    want = {(r["word"], r["df"]): r["idf"] for r in EM.corpus_idf(EM.word_bags(df), "char").collect()}
    found = EM.char_idf(df)
    got = {(r["word"], r["df"]): r["idf"] for r in found.collect()}
    assert got == pytest.approx(want)
    assert "hashpartitioning(id" not in found._jdf.queryExecution().executedPlan().toString()
