import binascii
import hashlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from versus.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """The contract, in plain Python: rows are (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))

    def up(nodes):
        """The root, and every node's way: the other members of its run and its place."""
        ways = [[] for _ in nodes]
        level, members = nodes, [[i] for i in range(len(nodes))]
        while len(level) > 1:
            runs = [level[i : i + 3] for i in range(0, len(level), 3)]
            for r, run in enumerate(runs):
                for j in range(len(run)):
                    for i in members[3 * r + j]:
                        ways[i].append((run[:j], run[j + 1 :]))
            members = [sum(members[i : i + 3], []) for i in range(0, len(level), 3)]
            level = [sha(*run) for run in runs]
        return level[0], ways

    key = lambda r: (r[1] is not None, (r[1] or "").encode())
    groups = [list(g) for _, g in groupby(sorted(rows, key=key), key=key)]
    trees = []
    for group in groups:
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(up([leaf(r) for r in group]))
    root, tops = up([t[0] for t in trees])
    out = []
    for group, (subroot, ways), top in zip(groups, trees, tops, strict=True):
        for row, way in zip(group, ways, strict=True):
            text = row[4]
            if text is not None and row[0] is not None and binascii.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf((*row[:4], text))
            for left, right in way + top:
                node = sha(*left, node, *right)
            proof = sha(*(x for left, right in way + top for x in (*left, *right)))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def result(df, depth=merkle.DEPTH):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.manifest(df, text, depth=depth).collect()), key=str)


def test_midstates_against_hashlib():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 7, 9, 10, 30):
        nodes = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        got, kept = merkle.parents(nodes)
        runs = [nodes[i : i + 3] for i in range(0, n, 3)]
        assert [x.tobytes().hex() for x in got] == [sha(*(y.tobytes().hex() for y in run)) for run in runs]
        assert kept.shape == (len(runs), 3, 32)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_against_brute_force(spark, depth):
    rows = [(i, s, "en", i, f"line {i}\nend") for s, n in (("a", 1), ("b", 10), ("ä", 27), (None, 28), ("", 2))
            for i in range(n * 100, n * 101)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(df, depth) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"s{i % 31}", None, None, "x\ny") for i in range(80)]
    assert result(spark.createDataFrame(rows, SCHEMA), 1) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, "a", None, None, None), (1, "a", None, None, None), (1, "a", "en", 3, "x\n"), (None, "a", "en", 3, "\n"),
            (None, None, None, None, None), (2, "-", "-", -5, ""), (10, "a", "en", 3, "\n\n" * 50_000), (9, "a", "", 0, "é\n")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == brute(rows)
    clash = df.selectExpr("*", "1 as g", "2 as leaf", "3 as block", "4 as path")
    assert result(clash) == brute(rows)
    assert result(df.limit(0)) == []
    assert result(df.limit(1).coalesce(1)) == brute([tuple(r) for r in df.limit(1).coalesce(1).collect()])


def test_query(spark, data_dir):
    cols = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select(*cols).collect()]
    got = sorted((tuple(r) for r in merkle.op12_manifest(spark, data_dir).collect()), key=str)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_folding_resumes_the_kept_state(spark):
    """A path with another state leads elsewhere: the states are what folding goes by."""
    leaves = np.random.default_rng(2).integers(0, 256, (20, 32), dtype=np.uint8)
    levels, states = merkle.tree(leaves, merkle.height(20))
    ways = merkle.steps(levels, states)
    assert (merkle.fold(leaves, ways) == levels[-1][0]).all()
    ways[:, 0, 2] ^= 1
    assert (merkle.fold(leaves, ways) != levels[-1][0]).any(1).all()
