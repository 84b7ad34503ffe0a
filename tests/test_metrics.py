"""Matching, METEOR and BLEU against small exact recomputations."""

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from versus.functions import bleu as B
from versus.functions import ngrams as N
from versus.operators import judge as J

WORDS = "a b c d e f".split()


def bag(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def clipped(h, r, n):
    return sum((bag(h, n) & bag(r, n)).values())


def random_rows(seed, count, longest, words=WORDS):
    rng = random.Random(seed)
    return [
        tuple(" ".join(rng.choices(words, k=rng.randint(0 if s < 2 else 1, longest))) for s in range(3))
        for _ in range(count)
    ]


def test_matches_equal_brute_force(triples):
    rows = random_rows(1, 60, 14)
    out = {r["id"]: r for r in J.bleu_counts(triples(rows), 5).collect()}
    for i, (h1, h2, ref) in enumerate(rows):
        for name, h in (("h1", h1), ("h2", h2)):
            want = [clipped(h.split(), ref.split(), n) for n in range(1, 6)]
            assert list(out[i][f"{name}_match"]) == want


def test_long_rows_use_strings_and_agree(triples):
    rng = random.Random(2)
    long = [" ".join(rng.choices("the of x y z w".split(), k=400)) for _ in range(3)]
    row = J.bleu_counts(triples([tuple(long)]), 4).first()
    h1, h2, ref = (s.split() for s in long)
    assert list(row["h1_match"]) == [clipped(h1, ref, n) for n in range(1, 5)]
    assert list(row["h2_match"]) == [clipped(h2, ref, n) for n in range(1, 5)]
    hits = J.overlap_counts(triples([tuple(long)])).first()
    assert hits["h1_hits"] == sum(t in set(ref) for t in h1)


def test_coded_and_string_paths_agree(triples):
    df = triples(random_rows(3, 40, 20))
    coded = N.match_counts(df, ["h1", "h2"], "ref", 4).collect()
    strings = N.match_counts(df, ["h1", "h2"], "ref", 4, coded_limit=1).collect()
    assert sorted(map(str, coded)) == sorted(map(str, strings))


@pytest.mark.parametrize("texts", [("abab", "xab", "ababab"), ("日本語日本", "ab", "日本語"), ("", "é", "éé")])
def test_character_matches(spark, texts):
    df = spark.createDataFrame([(1, *[list(t) for t in texts])], "id int, h1 array<string>, h2 array<string>, ref array<string>")
    row = N.match_counts(df, ["h1", "h2"], "ref", 4, characters=True).first()
    for name, text in (("h1", texts[0]), ("h2", texts[1])):
        assert list(row[f"{name}_match"]) == [clipped(text, texts[2], n) for n in range(1, 5)]


def test_overlap_counts_repeats_and_meteor_cases(triples):
    rows = [("a a a", "x y", "a b"), ("a b", "a b", "a b"), ("", "a", "a")]
    out = {r["id"]: r for r in J.judge_meteor(triples(rows)).collect()}
    assert out[0]["h1_hits"] == 3 and out[0]["h2_hits"] == 0
    assert out[0]["h1_score"] == pytest.approx((1 * 1.5) / (0.9 * 1.5 + 0.1 * 1))
    assert out[0]["h2_score"] == 0 and out[0]["pred"] == 1
    assert out[1]["pred"] == 0
    assert out[2]["h1_score"] == 0 and out[2]["pred"] == -1


def want_precisions(h, r, top):
    out = []
    for n in range(1, top + 1):
        total = max(len(h) - n + 1, 0)
        out.append(Fraction(clipped(h, r, n), total) if total else Fraction(0))
    return out


def want_smoothed(h, r, mode, eps=0.1, alpha=5.0, k=5.0):
    """Exact recomputation; None where the score is undefined."""
    p = want_precisions(h, r, 5)
    extra, p = p[4], p[:4]
    zero_rank = {}
    for i, v in enumerate(p):
        if v == 0:
            zero_rank[i] = len(zero_rank) + 1
    if mode in (4, 7) and zero_rank and len(h) < 2:
        return None
    by_length = [
        zero_rank[i] * k / math.log(len(h)) if i in zero_rank and mode in (4, 7) else v
        for i, v in enumerate(p)
    ]

    def averaged(v):
        res, prev = [], v[0] + 1
        for i in range(4):
            prev = (prev + v[i] + (v[i + 1] if i < 3 else extra)) / 3
            res.append(prev)
        return res

    if mode == 1:
        p = [Fraction(eps) if v == 0 else v for v in p]
    elif mode == 2:
        p = [Fraction(v.numerator + 1, v.denominator + 1) for v in p]
    elif mode == 3:
        p = [Fraction(1, 2 ** (zero_rank[i] + 1)) if i in zero_rank else v for i, v in enumerate(p)]
    elif mode == 4:
        p = by_length
    elif mode == 5:
        p = averaged(p)
    elif mode == 7:
        p = averaged(by_length)
    elif mode == 6:
        if p[2] == 0 or p[1] == 0:
            return None
        first = (p[0] + alpha * float(p[3] ** 2 / p[2])) / (len(h) + alpha)
        last = (p[3] + alpha * float(p[2] ** 2 / p[1])) / (max(len(h) - 3, 0) + alpha)
        p = [first, p[1], p[2], last]
    if not h:
        return 0.0 if mode == 0 else None
    bp = 1 if len(h) > len(r) else math.exp(1 - len(r) / len(h))
    return float(math.prod(p)) ** 0.25 * bp


@pytest.mark.parametrize("mode", range(8))
def test_smoothing_equals_recomputation(triples, mode):
    rows = random_rows(10 + mode, 40, 9) + [("a b c d", "x", "a b c d"), ("", "a", "a b")]
    counts = J.bleu_counts(triples(rows), 5)
    out = {r["id"]: r for r in J.score_bleu_smoothed(counts, mode, mode).collect()}
    for i, (h1, h2, ref) in enumerate(rows):
        for name, h in (("h1", h1), ("h2", h2)):
            want = want_smoothed(h.split(), ref.split(), mode)
            got = out[i][f"{name}_score"]
            assert (got is None) == (want is None), (rows[i], name)
            if want is not None:
                assert got == pytest.approx(want, rel=1e-12)


def test_bleu_edge_cases(triples):
    rows = [("a b c d", "a b", "a b c d"), ("a a a", "", "a b")]
    out = {r["id"]: r for r in J.score_bleu(J.bleu_counts(triples(rows), 4)).collect()}
    assert out[0]["h1_score"] == 1.0 and out[0]["h2_score"] == 0.0
    assert out[1]["h2_score"] == 0.0
    one = J.score_bleu(J.bleu_counts(triples(rows), 4), max_n=1)
    got = {r["id"]: r["h1_score"] for r in one.collect()}
    assert got[1] == pytest.approx(1 / 3)


def test_add_one_reduces_first(spark):
    df = spark.createDataFrame([(2, 4), (0, 7), (3, 3), (6, 9)], "num int, den int")
    pairs = [F.struct(*B.add_one(F.col("num"), F.col("den"))), F.struct(*B.add_one(F.col("num"), F.col("den"), False))]
    rows = df.select(pairs[0].alias("r"), pairs[1].alias("t")).collect()
    assert [tuple(r["r"]) for r in rows] == [(2, 3), (1, 2), (2, 2), (3, 4)]
    assert [tuple(r["t"]) for r in rows] == [(3, 5), (1, 8), (4, 4), (7, 10)]


def test_equal_rationals_tie_beyond_exact_doubles(spark):
    big = 1_000_003
    df = spark.createDataFrame(
        [([3 * big, 7 * big, 11, 13], [9 * big, 21 * big, 33, 39]), ([1, 1, 1, 1], [3, 3, 3, 3])],
        "n array<bigint>, d array<bigint>",
    )
    cols = lambda c: [F.get(c, F.lit(i)) for i in range(4)]
    out = df.select(B.ratio_of_products(cols("n"), cols("d")).alias("q")).collect()
    assert out[0]["q"] == out[1]["q"]


def test_swapping_hypotheses_negates(triples):
    rows = random_rows(30, 50, 10)
    swapped = [(b, a, r) for a, b, r in rows]
    for judge in (
        J.judge_meteor,
        J.judge_overlap,
        lambda t: J.score_bleu_smoothed(J.bleu_counts(t), 3, 3),
    ):
        first = {r["id"]: r["pred"] for r in judge(triples(rows)).collect()}
        second = {r["id"]: r["pred"] for r in judge(triples(swapped)).collect()}
        assert all(
            (second[i] is None) if p is None else (second[i] == -p) for i, p in first.items()
        )


def test_weights_scale_but_do_not_change_preference(triples):
    counts = J.bleu_counts(triples(random_rows(31, 40, 12)), 4)
    plain = {r["id"]: r["h1_score"] for r in J.score_bleu(counts).collect()}
    weighed = {r["id"]: r["h1_score"] for r in J.score_bleu_weighted(counts, [0.25] * 4).collect()}
    for i, score in plain.items():
        assert weighed[i] == pytest.approx(score * 0.25)
