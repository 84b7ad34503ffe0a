import hashlib
import math
import random
import re

import numpy as np
import pytest

from versus.llm import pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
                if not 12 <= len(digits) <= 19 or odd % 10:
                    continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


def test_spans_against_the_plain_patterns():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("aB1023.@+-() _%é,42") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain(text), text
    card = "4539 1488 0343 6467"
    assert pii.base_spans(f"x {card} y") == [(2, 2, 21)]
    assert pii.base_spans("a" * 300_000 + "1" * 300_000) == []


def test_query(spark, data_dir):
    got = {r.doc_id: r for r in pii.op8_pii(spark, data_dir).collect()}
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = plain(d.text), got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(pii.written(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(pii.written(want).split(",")) <= set(r.spans.split(","))


def test_disclosure_by_hand(spark, monkeypatch):
    rows = [(i, f"the boss Quux wrote from a.b@c.de today number {i}") for i in range(4)]
    rows += [(10 + i, f"the day today is {i} a") for i in range(12)] + [(30, "Quux was here"), (31, None), (32, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(df, 0.8, 3).collect()}
    n, e = len(rows), 4
    want = set()
    for term in ("the", "boss", "quux", "wrote", "from", "today", "number"):
        t = sum(term in (x or "").lower().split() for _, x in rows)
        if math.log2(n * 4 / (t * e)) / math.log2(n / e) >= 0.8:
            want.add(term)
    assert want == {"boss", "quux", "wrote", "from", "number"}
    for i in range(4):
        text = rows[i][1]
        assert {text[s.start : s.end].lower() for s in got[i] if s.kind == 4} == want
    assert all(not got[d] for d in got if d > 3)
    monkeypatch.setattr(pii, "BROADCAST_TERMS", -1)
    again = {r.doc_id: r.spans for r in pii.find_personal_data(df, 0.8, 3).collect()}
    assert again == got


def test_stage_and_odd_rows(spark):
    rows = [(1, "mail x@y.zz now", "a", "b", 3), (1, "mail x@y.zz now", "a", "b", 3), (None, "1.2.3.4", None, None, None), (2, None, None, None, None), (3, "clean " * 9000, "a", "b", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in pii.pii_stage(spark, df, "").collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "mail [EMAIL] now", "a", "b", 16)] * 2 + [(None, "[IP]", None, None, 4), rows[3], rows[4]], key=str
    )
    assert pii.pii_stage(spark, df.limit(0), "").collect() == []


def test_terms_of_pooled_values_anywhere_in_the_document(spark):
    rows = [(i, f"Quux {'so far ' * 20} {i} user{i}@corp.de") for i in range(4)]
    rows += [(10 + i, f"call so far +49 {i}70 123456{i}") for i in range(4)]
    rows += [(20 + i, f"so far nothing {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(df).collect()}
    for i, text in rows:
        want = {"Quux"} if i < 4 else {"call"} if i < 20 else set()
        assert {text[s.start : s.end] for s in got[i] if s.kind == 4} == want


def test_long_runs_of_digits_and_parts(spark):
    texts = ["x 1.1.1." + "7" * 5000, "1" * 1_000_000, "0" * 6000 + "1.2.3.004", ("9" * 40_000 + ".") * 5, "1.2.3.4.5.6.7.8 1.2.3"]
    assert pii.base_spans(texts[0]) == [] and pii.base_spans(texts[1]) == []
    assert pii.base_spans(texts[2]) == [(0, 1, 6009)]
    assert pii.base_spans(texts[4]) == [(0, 1, 7), (8, 1, 15)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: len(r.spans) for r in pii.find_personal_data(df).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 0, 4: 2}
