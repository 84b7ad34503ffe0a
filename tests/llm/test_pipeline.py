import re
import zlib
from collections import defaultdict

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer


def sentence(i):
    words = "the of and to in a is that for it was on are with as".split()
    return " ".join(words[(i * 7 + j * j) % 15] + ("" if j % 3 else f" {chr(97 + (i + j) % 26)}{i * 31 + j}") for j in range(30))


def test_decisions_take_effect(spark, tmp_path):
    shared = " ".join(f"common{j}" for j in range(60))
    rows = [(i, sentence(i), "en", "s1", 1) for i in range(12)]
    rows += [(20, "12 34 56 !!", None, "s1", 1), (21, None, None, None, None)]
    rows += [(30 + i, sentence(100 + i) + "\n" + shared, "en", "s2", 1) for i in range(3)]
    rows += [(40, sentence(3), "en", "s2", 1), (41, sentence(4) + " extra", "en", "s2", 1)]
    rows += [(50, sentence(50) + " mail bob@example.org soon", "en", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs, texts = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        texts[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(texts["language"]) == {r[0] for r in rows} - {20, 21}
    assert shared in texts["line_dedup"][30] and shared not in texts["line_dedup"][31] + texts["line_dedup"][32]
    assert set(texts["language"]) - set(texts["near_dedup"]) == {40, 41}
    assert "[EMAIL]" in texts["personal_data"][50] and "bob" not in texts["personal_data"][50]
    assert texts["personal_data"][5] == rows[5][1]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*t.encode(x, add_special_tokens=False).ids, 0] for d, x in texts["personal_data"].items()}
    parts = defaultdict(int)
    for p in cp.run(spark, str(tmp_path)).collect():
        raw = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()
        assert p.ids_crc32 == zlib.crc32(raw)
        parts[p.doc_id] += p.length
    assert parts == {d: len(i) for d, i in ids.items()}


def test_stages_with_clashing_columns_and_empty_tables(spark):
    names = ["n_lines", "score", "lang_pred", "spans", "digest", "component_id", "kept", "id", "queue", "chunk"]
    columns = [F.lit(f"own {c}").alias(c) for c in names]
    rows = [(i, sentence(i), "en", None, 5) for i in range(4)] + [(9, sentence(2), "en", "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = df.select("*", *columns)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, "")
        assert stage(spark, docs.limit(0), "").collect() == []
        if name != "packing":
            assert out.columns == docs.columns
            got = out.collect()
            assert len(got) == (4 if name == "near_dedup" else 5)
            assert all(r[c] == f"own {c}" for r in got for c in names)
        else:
            assert len({r.doc_id for r in out.collect()}) == 5


def test_every_query_is_registered():
    import __spark_entry__ as entry

    numbers = {int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
