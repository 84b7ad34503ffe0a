import zlib

import numpy as np
import pytest

from versus.llm.packing import pack

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


def packed(df, **kw):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(df, path, public_tokenizers.PATTERN, **kw).collect()


def check(rows, pieces, length=1024):
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: [*t.encode(x or "", add_special_tokens=False).ids, 0] for d, x, *_ in rows}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want[d]) and p.length > 0
            ids = np.array(want[d][at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(ids)
            at += p.length
        assert at == len(want[d])
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or at < length and at & (at - 1) == 0, (s, at)
    return by_seq


def test_every_id_in_one_piece_without_padding(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    pieces = packed(docs)
    by_seq = check(rows, pieces)
    source = {d: s for d, _, s in rows}
    total = sum(p.length for p in pieces)
    share = {}
    for p in pieces:
        share[source[p.doc_id]] = share.get(source[p.doc_id], 0) + p.length / total
    for ps in list(by_seq.values())[:-12]:
        own = dict.fromkeys(share, 0)
        for p in ps:
            own[source[p.doc_id]] += p.length
        if sum(own.values()) == 1024:
            assert all(abs(own[s] - 1024 * share[s]) < len(share) + 2 for s in share)


def test_targets_nulls_and_few_queues(spark):
    rows = [(i, "alpha beta " * (i % 9) if i % 5 else None, ["a", "b", None, "c"][i % 4]) for i in range(90)]
    rows += [(100, "<|endoftext|> x", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, packed(df, targets={"a": 3.0, None: 1.0}, length=64, window=128), 64)
    check(rows, packed(df, named_queues=1, length=64), 64)
    assert packed(df.limit(0)) == []


def test_added_tokens_and_odd_characters(spark):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x \n<|endoftext|>  <|endoftext|>y", "<|endoftext", "\x00\x7f\xad\xa0 ÿ", "日本語  🙂🙂 é",
             "it's  we'll\t\n 12345", " " * 50, "\u200b\ufeff\x1c\x1f"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    check(rows, packed(spark.createDataFrame(rows, "doc_id long, text string, source string")))
