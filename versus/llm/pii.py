"""Personal data: patterns, and terms that disclose it by co-occurrence.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Their values are the
protected entities. As most values stand in one text only, they are also pooled: each belongs to the
entities of its kind and of its kind and e-mail domain, first two parts of the address, or leading
digits. From the corpus it is then estimated how strongly a term reveals an entity: with p(.) the
share of documents that contain something,

    disclosure(term, entity) = log2(p(term, entity) / (p(term) p(entity))) / -log2 p(entity)

the pointwise mutual information as a share of the entity's information; 1 means that the term
never occurs without the entity. Terms (words, A-Z lower-cased) whose disclosure of an entity
reaches ``THRESHOLD`` are spans of the kind ``term`` in documents with the entity, wherever they
stand there. ``SUPPORT`` different texts must hold both, or nothing is said of the pair: a word of
one text would always reach 1. Terms are told apart by 64-bit hashes; all counts are of all
documents.

Documents that hold no entity are untouched. The terms of each different text with an entity are
counted by partial sums. Terms of too few texts, and those so frequent in the corpus that no entity
could let them reach the threshold, are dropped before pairs are made. The words of the corpus are
counted for candidate terms: where there are at most ``BROADCAST_TERMS`` of them (counted first),
other words are dropped in the task, else after the join; the counts are equal.

Null text counts as empty. Rows of the same id and text are one document each time they occur and
get the same result; a row without id is treated like others. An empty table gives an empty
result. Long texts are looked at whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.llm import arrays
from versus.llm.common import ship, table
from versus.session import materialize

SUPPORT = 3
THRESHOLD = 0.9
BROADCAST_TERMS = 1_000_000
BROADCAST_ROWS = 100_000
PREFIX = {"card": 6, "phone": 4}
KINDS = ("email", "ip", "card", "phone", "term")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits: the run's start would match as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # From each @ to the left and right: time stays linear in long runs of letters.
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        free = match.end() if match else at + 1
        if match:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted by start, then kind."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
            if all(len(part) <= 3 and int(part) <= 255 for part in parts):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _hashes(words: list[str]) -> list[int]:
    return arrays.words(pa.array(words, pa.string()))[0].view(np.int64).tolist()


def _entities(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], list[int]]:
    """The entities of the text, single values and pools, and the hashes of its other words."""
    names = set()
    for start, kind, end in spans:
        own, of = text[start:end].lower(), KINDS[kind]
        if kind == 0:
            pool = own[own.index("@") :]
        elif kind == 1:
            pool = ".".join(own.split(".")[:2]) + ".*"
        else:
            own = re.sub("[^0-9]", "", own)
            pool = own[: PREFIX[of]] + "*"
        names |= {f"{of}:{own}", f"{of}:{pool}", f"{of}:*"}
    starts = np.array([a for a, _, _ in spans])
    reach = np.maximum.accumulate([b for _, _, b in spans])
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    before = np.searchsorted(starts, [b for _, b in places])
    terms = {text[a:b] for (a, b), i in zip(places, before, strict=True) if i == 0 or reach[i - 1] <= a}
    return sorted(names), sorted(set(_hashes(sorted(terms)))) if terms else []


def detect(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, digest (of the text), the base spans, and for rows with a span the text,
    its entities and its terms."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts, entities, terms = [], [], [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                found = base_spans(text)
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                texts.append(text if found else None)
                names, words = _entities(text, found) if found else ([], [])
                entities.append(names)
                terms.append(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, span),
                 pa.array(texts, pa.string()), pa.array(entities, pa.list_(pa.string())),
                 pa.array(terms, pa.list_(pa.int64()))],
                names=["doc_id", "digest", "spans", "text", "entities", "terms"],
            )

    return docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text"
    ).mapInArrow(
        run,
        "doc_id long, digest long, spans array<struct<start long, kind int, end long>>, "
        "text string, entities array<string>, terms array<long>",
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_term): the number of documents that contain each of ``terms``."""
    wanted = None
    if terms.count() <= BROADCAST_TERMS:  # at most 8 MB
        wanted = np.sort(np.array([r["term"] for r in terms.collect()], np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in arrays.slices(batch.column(0)):
                words, bounds = arrays.words(batch.column(0).slice(start, stop - start))
                rows = arrays.rows_of(bounds)
                if wanted is not None:
                    if not len(wanted):
                        continue
                    at = np.minimum(np.searchsorted(wanted, words), len(wanted) - 1)
                    words, rows = words[wanted[at] == words], rows[wanted[at] == words]
                order = np.lexsort((rows, words))
                words, rows = words[order], rows[order]
                new = np.ones(len(words), bool)
                new[1:] = (words[1:] != words[:-1]) | (rows[1:] != rows[:-1])
                keys, n = arrays.count(words[new])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["term", "n"]
                )

    partial = docs.select("text").mapInArrow(run, "term long, n long")
    return partial.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n_term"))


def _only(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` (with an array ``terms``) once for each of their terms that is one of ``terms``."""
    small = terms.count() <= BROADCAST_ROWS
    each = rows.withColumn("term", F.explode("terms")).drop("terms")
    return each.join(F.broadcast(terms) if small else terms, "term")


def disclosing(docs: DataFrame, found: DataFrame, threshold: float, support: int) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach the threshold."""
    n = float(found.count())
    texts = materialize(
        found.where("size(spans) > 0").groupBy("digest").agg(
            F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms")
        )
    )
    entities = materialize(
        texts.select("copies", F.explode("entities").alias("entity"))
        .groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("n_texts"))
        .where(F.col("n_texts") >= support).drop("n_texts")
    )
    held = materialize(
        texts.select(F.explode("terms").alias("term"))
        .groupBy("term").agg(F.count("*").alias("n_texts"))
        .where(F.col("n_texts") >= support).select("term")
    )
    # n_both is n_entity at most, so no term of more documents than this reaches the threshold
    most = entities.agg(
        F.max(F.pow(F.col("n_entity"), F.lit(threshold)) * F.pow(F.lit(n), F.lit(1 - threshold)))
    ).first()[0]
    counts = term_counts(docs, held).where(F.col("n_term") <= (most or 0) * (1 + 1e-9) + 1e-9)
    counts = materialize(counts)
    # entities of too few texts go before they are paired with the terms
    known = (
        texts.select("digest", F.explode("entities").alias("entity"))
        .join(entities.select("entity"), "entity", "left_semi")
        .groupBy("digest").agg(F.collect_list("entity").alias("entities"))
    )
    both = (
        _only(texts.drop("entities").join(known, "digest"), counts.select("term"))
        .select("copies", "term", F.explode("entities").alias("entity"))
        .groupBy("entity", "term").agg(F.sum("copies").alias("n_both"), F.count("*").alias("n_texts"))
        .where(F.col("n_texts") >= support).drop("n_texts")
    )
    information = F.log2(F.lit(n) / F.col("n_entity"))
    mutual = F.log2(F.lit(n) * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    return (
        both.join(entities, "entity").join(counts, "term")
        .where(information > 0)
        .select("entity", "term", (mutual / information).alias("disclosure"))
        .where(F.col("disclosure") >= threshold)
    )


def find_personal_data(
    docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT
) -> DataFrame:
    """doc_id, digest, spans (array of start, kind, end; sorted) of every row."""
    found = materialize(detect(docs))
    with_data = found.where("size(spans) > 0")
    pairs = materialize(disclosing(docs, found, threshold, support))
    terms = (
        _only(with_data.select("doc_id", "digest", "entities", "terms"), pairs.select("term").distinct())
        .withColumn("entity", F.explode("entities"))
        .join(pairs, ["entity", "term"])
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("term").alias("terms"))
        .select(F.col("doc_id").alias("id"), F.col("digest").alias("own"), F.col("terms").alias("disclosing"))
    )
    joined = with_data.join(
        terms, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own")), "left"
    ).select("doc_id", "digest", "spans", "text", F.col("disclosing").alias("terms"))
    schema = "doc_id long, digest long, spans array<struct<start long, kind int, end long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for spans, text, terms in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if terms:
                    wanted, base = set(terms), list(spans)
                    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
                    for (a, b), h in zip(places, _hashes([text]), strict=True):
                        if h in wanted and not any(a < s["end"] and s["start"] < b for s in base):
                            spans.append({"start": a, "kind": 4, "end": b})
                rows.append(sorted(spans, key=lambda s: (s["start"], s["kind"])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, batch.schema.field(2).type)],
                names=["doc_id", "digest", "spans"],
            )

    clean = found.where("size(spans) = 0").select("doc_id", "digest", "spans")
    return clean.unionByName(joined.mapInArrow(run, schema))


def masked(text: str, spans: list) -> str:
    """The text with every span replaced by its kind; overlapping spans become the first's."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.array(*(F.lit(k) for k in KINDS))

    def text(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
        )

    def number(kind):
        own = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *(number(k) for k in range(4)),
        F.sha2(text(F.filter("spans", lambda s: s["kind"] < 4)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        number(4),
    )


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are replaced by their kind; every document stays."""
    ship(spark)
    found = find_personal_data(docs).where("size(spans) > 0").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__own"), F.col("spans").alias("__spans")
    ).distinct()
    joined = docs.withColumn("__digest", F.xxhash64(F.coalesce("text", F.lit("")))).join(
        found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__own")), "left"
    )
    text = F.pandas_udf(_masked_series, "string")
    # a UDF sees every row, whatever the condition around it: only texts with spans travel
    hit = F.when(F.col("__spans").isNotNull(), F.col("text"))
    new = F.when(F.col("__spans").isNotNull(), text(hit, "__spans")).otherwise(F.col("text"))
    joined = joined.withColumn("text", new)
    length = F.when(F.col("__spans").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return joined.withColumn("n_chars", length).select(*docs.columns)


def _masked_series(texts, spans):
    import pandas as pd

    def one(text, own):
        if own is None or text is None:
            return text
        return masked(text, [(s["start"], s["kind"], s["end"]) for s in own])

    return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)])


_masked_series.__annotations__ = {}
