import hashlib
import random

import numpy as np
import pytest

from versus.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(public_tokenizers.path(NAME)))}
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    chars = ["a", "B", "é", "ÿ", "日", "🙂", " ", "  ", "\n", "\t", "'s", "'ll", "12", "...", "\x00", "\x1c", "\u00a0", "\u200b", "ß", "\u0301"]
    return ["", " ", "\n \n", "<|endoftext|>", "a" * 3000, "\u3000 x", *("".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(1500))]


def check(texts, rows, reference):
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = np.array(reference.encode_ordinary(text), "<u4").tobytes()
        assert r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest(), text
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest(), text


def test_odd_texts_against_tiktoken(spark, reference):
    texts = [*odd_texts(), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path(NAME)
    check(texts, bpe.encode_documents(df, path, public_tokenizers.PATTERN).collect(), reference)
    clash = df.selectExpr("*", "1 as ids", "2 as n_tokens")
    check(texts, bpe.encode_documents(clash, path, public_tokenizers.PATTERN).collect(), reference)
    assert bpe.encode_documents(df.limit(0), path, public_tokenizers.PATTERN).collect() == []


def test_ids_and_bytes(spark, reference):
    texts = odd_texts()[:300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.encode_documents(df, public_tokenizers.path(NAME), public_tokenizers.PATTERN, with_ids=True).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded).decode() == texts[r.doc_id]


def test_query_against_tiktoken(spark, data_dir, reference):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    check({d.doc_id: d.text for d in docs}, bpe.op2_bpe(spark, data_dir).collect(), reference)


def test_a_small_cache_changes_nothing(reference):
    coder = bpe.Codec(bpe.read_ranks(public_tokenizers.path(NAME)), public_tokenizers.PATTERN, cache=20)
    texts = odd_texts()[:200]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
