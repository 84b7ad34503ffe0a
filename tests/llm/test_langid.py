import zlib

import numpy as np
import pytest

from versus.llm import langid


def test_features_match_single_texts():
    texts = ["", "ab", "Éa b", "x" * 50, "ß"]
    together = [[f[b[i] : b[i + 1]].tolist() for i in range(len(texts))] for f, b in langid.features(texts)]
    for i, t in enumerate(texts):
        alone = [f.tolist() for f, _ in langid.features([t])]
        assert alone == [rows[i] for rows in together]
        assert [len(a) for a in alone] == [max(len(t) + 3 - n, 0) for n in langid.ORDERS]


def test_posterior_against_a_loop(spark):
    rows = [(i, t, s) for i, (t, s) in enumerate([("the and of", "en"), ("der und die", "de"), ("of the", "en")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, prior, matrix = langid.fit(df)
    assert langs == ["de", "en"]
    want = prior + sum(matrix[:, f].astype(float).sum(1) for f, _ in langid.features(["the die"]))
    p = np.exp(want - want.max())
    got = langid.predict(spark.createDataFrame([(1, "the die")], "doc_id long, text string"), (langs, prior, matrix)).first()
    assert got.lang_pred == langs[int(np.argmax(p))] and abs(got.score - (p / p.sum()).max()) < 1e-9


def test_held_out_accuracy_and_bounded_sample(spark, data_dir):
    got = {r.doc_id: r for r in langid.op5_langid(spark, data_dir).collect()}
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert all(got[d.doc_id].held_out for d in held) and len(got) == len(docs)
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    data = [(1, None, "en"), (2, "", None), (3, "123 !?", "en"), (4, "hello there", "en"), (4, "hello there", "en"), (5, "bonjour " * 9000, "fr"), (None, "x", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(df, model).collect()]
    assert got[:3] == [(1, "und"), (2, "und"), (3, "und")] and got[3:6] == [(4, "en"), (4, "en"), (5, "fr")]
    assert langid.predict(df.limit(0), model).collect() == []
    nothing = langid.fit(df.limit(0))
    assert all(r.lang_pred == "und" and r.score == 0 for r in langid.predict(df, nothing).collect())


def test_more_languages_than_fit_share_columns(spark, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", langid.FEATURES * 4)
    rows = [(100 * k + i, f"{chr(0x4E00 + 7 * k)}{chr(0x4E01 + 7 * k)} " * 9, f"l{k:03d}") for k in range(40) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model[0]) == 40 and model[2].size <= langid.CELLS
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert got == {d: lang for d, _, lang in rows}
    monkeypatch.setattr(langid, "CELLS", langid.LEAST_FEATURES * 39)
    with pytest.raises(ValueError):
        langid.fit(df)
