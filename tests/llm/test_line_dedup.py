import random

import pytest

from versus.llm import line_dedup as ld


def brute(rows, min_lines, min_words):
    """Every run that counts of every document, with the first place of its lines."""
    runs, first = [], {}
    for d, text in sorted(rows):
        own = [(i, x.strip(" \t\n\x0b\f\r")) for i, x in enumerate((text or "").split("\n"))]
        own = [(i, x) for i, x in own if x]
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if b - a >= min_lines or sum(len(x.split()) for _, x in own[a:b]) >= min_words:
                    key = tuple(x for _, x in own[a:b])
                    first.setdefault(key, (d, own[a][0]))
                    runs.append((d, own[a][0], own[b - 1][0], key))
    gone = {d: set() for d, _ in rows}
    for d, a, b, key in runs:
        if first[key] < (d, a):
            gone[d].update(range(a, b + 1))
    return {d: sorted(g) for d, g in gone.items()}


def lines_of(text):
    return [i for part in text.split(",") if part for i in range(int(part.split("-")[0]), int(part.split("-")[1]) + 1)]


@pytest.mark.parametrize("seed", range(3))
def test_against_all_runs(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(12)] + [""]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: lines_of(r.removed) for r in ld.dedup_lines(df, 3, 12).collect()}
    assert got == brute(rows, 3, 12)


def test_query_against_all_runs(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text.count("\n") < 60]
    got = {r.doc_id: r for r in ld.dedup_lines(docs.where("size(split(text, '\n')) <= 60")).collect()}
    want = brute(rows, ld.MIN_LINES, ld.MIN_WORDS)
    assert {d: lines_of(r.removed) for d, r in got.items()} == want and any(want.values())
    assert len(ld.op3_line_dedup(spark, data_dir).collect()) == docs.count()


def test_odd_rows(spark):
    long = "\n".join(f"line {i} of a text" for i in range(3000))
    rows = [(1, long, "x"), (2, long + "\nown", "y"), (3, None, "z"), (4, "", "z"), (None, long, "n"), (5, "a\nb", "r"), (5, "a\nb", "r"), (6, long, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = {r.doc_id: r for r in ld.dedup_lines(df).collect()}
    assert got[1].n_removed == 0 and got[2].text == "own" and got[6].emptied
    assert got[3].text is None and got[4].text == "" and not got[4].emptied and got[None].n_removed == 0
    assert got[5].n_removed == 0 and ld.dedup_lines(df.limit(0)).collect() == []


def test_windows_come_from_their_fingerprints():
    rng = random.Random(8)
    text = "\n".join(f"line {rng.randrange(30)} of words" for _ in range(60))
    lines = ld.Lines.of(text)
    prints = lines.fingerprints(3, 12)
    every = lines.around({i for _, i in prints}, 3, 12)
    assert len(every) == len(lines.windows(3, 12)) and len(prints) < len(every)
    assert lines.around(set(), 3, 12) == []
    for _, i in prints:
        own = lines.around({i}, 3, 12)
        assert own and all(a <= i <= b for a, b, _, _ in own)
        assert set(own) <= set(every)
