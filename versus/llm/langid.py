"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of the lower-cased characters (``ORDERS``) are hashed to ``FEATURES`` columns. The matrix
of log probabilities (languages x features) has at most ``CELLS`` cells and is broadcast: with more
languages than fit, n-grams share fewer columns, so every language is learned. A batch of texts is
scored in numpy by adding up the matrix's columns at the n-grams that occur. The score is the
posterior of the predicted language. More than ``CELLS / LEAST_FEATURES`` languages are an error.

Counts are fitted on at most about ``PER_LANGUAGE`` labelled rows of each language, chosen by a
hash of the id (all rows where there are fewer); every row is scored. Only the text decides.

A text that is null, empty or without letters gets ``und`` with score 0; so does every text if
nothing was learned. Ties go to the language that sorts first. Rows with a null label are not
learned from. Repeated rows are learned from and scored each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.llm import arrays
from versus.llm.common import remainder, set_apart, ship, table

ORDERS = (1, 2, 3)
FEATURES = 1 << 16
PER_LANGUAGE = 20_000
LEAST_FEATURES = 1 << 8
CELLS = 1 << 26
ALPHA = 0.5
UNKNOWN = "und"


def width(languages: int) -> int:
    """The number of columns: ``FEATURES``, halved until the matrix has at most ``CELLS`` cells."""
    columns = FEATURES
    while columns > LEAST_FEATURES and languages * columns > CELLS:
        columns //= 2
    if languages * columns > CELLS:
        raise ValueError(f"more than {CELLS // LEAST_FEATURES} languages")
    return columns


def features(texts: list[str], columns: int = FEATURES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the features of all n-grams of all texts, and the bounds of the texts."""
    texts = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) for t in texts])
    for order in ORDERS:
        n = max(len(codes) - order + 1, 0)
        value = np.full(n, order, np.uint32)
        for i in range(order):
            value = value * np.uint32(0x01000193) ^ codes[i : n + i]
            value = value * np.uint32(0x9E3779B1)
        # n-grams that reach into the next text come last in their text: they are left out
        inside = np.ones(n, bool)
        for back in range(1, order):
            at = ends - back
            inside[at[(at >= 0) & (at < n)]] = False
        kept = np.concatenate([[0], np.cumsum(inside)])
        bounds = kept[np.minimum(np.concatenate([[0], ends]), n)]
        yield (value[inside] >> np.uint32(16)).astype(np.int64) % columns, bounds


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and the matrix of log probabilities."""
    known = labelled.where(F.col(lang_col).isNotNull())
    sizes = known.groupBy(lang_col).count().limit(CELLS // LEAST_FEATURES + 1).collect()
    languages = sorted(r[0] for r in sizes)
    columns = width(len(languages))
    if not languages:
        return [], np.zeros(0), np.zeros((0, FEATURES), np.float32)
    rows = {r[0]: r[1] for r in sizes}
    spark = labelled.sparkSession
    share = spark.createDataFrame(
        [(lang, min(1.0, per_language / rows[lang])) for lang in languages], "lang string, share double"
    )
    chosen = (
        known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                     (F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(1 << 30)).alias("at"))
        .join(F.broadcast(share), "lang")
        .where("at < share")
        .select("lang", "text")
    )

    def packed(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, seen in totals.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([arrays.blob(at.astype("<u4"))], pa.binary()),
                 pa.array([arrays.blob(seen[at].astype("<i8"))], pa.binary())],
                names=["lang", "at", "seen"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, stop in arrays.slices(batch.column(1), 1 << 20):
                part = batch.slice(start, stop - start)
                names = part.column(0).to_pylist()
                for feature, bounds in features([t or "" for t in part.column(1).to_pylist()], columns):
                    owner = np.array(names)[arrays.rows_of(bounds)]
                    for name in set(names):
                        seen = np.bincount(feature[owner == name], minlength=columns)
                        totals[name] = totals.get(name, 0) + seen
                if len(totals) * columns > 1 << 22:
                    yield from packed(totals)
                    totals = {}
        yield from packed(totals)

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(columns, np.int64)
        for at, seen in zip(parts["at"], parts["seen"], strict=True):
            total[np.frombuffer(at, "<u4")] += np.frombuffer(seen, "<i8")
        return pd.DataFrame({"lang": [key[0]], "seen": [arrays.blob(total)]})

    counted = (
        chosen.mapInArrow(count, "lang string, at binary, seen binary")
        .groupBy("lang")
        .applyInPandas(add, "lang string, seen binary")
        .collect()  # languages x features: bounded
    )
    seen = {r["lang"]: np.frombuffer(r["seen"], "<i8") for r in counted}
    matrix = np.stack([seen.get(lang, np.zeros(columns, np.int64)) for lang in languages]) + ALPHA
    matrix = np.log(matrix / matrix.sum(1, keepdims=True))
    prior = np.log(np.array([rows[lang] for lang in languages], float) / sum(rows.values()))
    return languages, prior, matrix.astype(np.float32)


def predict(docs: DataFrame, model: tuple, text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred and score."""
    import regex

    languages, prior, matrix = model
    shipped = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix.T))
    letter = r"\p{L}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has_letter = regex.compile(letter).search
        columns = shipped.value
        for batch in batches:
            for start, stop in arrays.slices(batch.column(0), 1 << 20):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column(0).to_pylist()]
                sums = np.tile(prior, (len(texts), 1))
                for feature, bounds in features(texts, columns.shape[0]) if languages else ():
                    for k in range(len(languages)):
                        sums[:, k] += arrays.segment_sums(
                            columns[:, k][feature].astype(np.float64), bounds
                        )
                pred, score = [], []
                best = sums.argmax(1) if languages else []
                for i, text in enumerate(texts):
                    if not languages or not has_letter(text):
                        pred.append(UNKNOWN)
                        score.append(0.0)
                    else:
                        pred.append(languages[best[i]])
                        score.append(float(1 / np.exp(sums[i] - sums[i, best[i]]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(text_col).alias("__text"), *keep).mapInArrow(
        run, f"{kept}, lang_pred string, score double"
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = fit(docs.where(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: ``und`` and posteriors below one half go."""
    ship(spark)
    apart, restore = set_apart(docs, ("text",))
    found = predict(apart, fit(docs), keep=tuple(apart.columns))
    return found.where("lang_pred <> 'und' and score >= 0.5").select(*restore)
