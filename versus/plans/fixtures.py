"""The engine's inputs, derived from the given tables: whole tables, whole texts.

Every document is cut into sentences (all of its text is used). Each sentence is a reference,
and two candidates are made from it row by row: the first loses every fifth token, the second
has every third to sixth token marred and up to two opening tokens repeated at its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.functions.tokens import trim_ws, word_tokens, ws_tokens

# A run of text up to and including its closing marks, or an unclosed rest of a line.
SENTENCE_PATTERN = r"[^.!?\n]*[.!?]+|[^.!?\n]+"
# Sentence ids are doc_id * SENTENCES_PER_DOC + position.
SENTENCES_PER_DOC = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that is one small file.

    A cluster-sized table already has far more splits than cores; then this does nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sentences_of(docs: DataFrame) -> DataFrame:
    """(id, doc_id, text) for each non-blank sentence of (doc_id, text)."""
    parts = F.regexp_extract_all("text", F.lit(SENTENCE_PATTERN), F.lit(0))
    return (
        docs.select("doc_id", F.posexplode(parts).alias("pos", "sentence"))
        .select(
            (F.col("doc_id") * SENTENCES_PER_DOC + F.col("pos")).alias("id"),
            "doc_id",
            trim_ws(F.col("sentence")).alias("text"),
        )
        .where(F.col("text") != "")
    )


def triples_of(docs: DataFrame) -> DataFrame:
    """(id, doc_id, h1, h2, ref) token arrays."""
    i_of = F.col("id")
    tokens = sentences_of(docs).select("id", "doc_id", ws_tokens(F.col("text")).alias("ref"))
    period = F.col("doc_id") % 4 + 3

    def kept(_t, i):
        return (i + i_of) % 5 != 0

    def marred(t, i):
        return F.when((i + i_of) % period == 0, F.concat(t, F.lit("~"))).otherwise(t)

    return tokens.select(
        "id",
        "doc_id",
        F.filter("ref", kept).alias("h1"),
        F.concat(
            F.transform("ref", marred),
            F.slice("ref", F.lit(1), (F.col("doc_id") % 3).cast("int")),
        ).alias("h2"),
        "ref",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples_of(documents(spark, sf_dir))


def text_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples as sentences instead of token arrays."""
    return triples(spark, sf_dir).select(
        "id", "doc_id", *[F.array_join(c, " ").alias(c) for c in ("h1", "h2", "ref")]
    )


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, gold): human labels exist for part of the documents only."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") - F.col("toxic")).cast("int").alias("gold")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features, label) from the embeddings table."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        "label",
    )


def word_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, doc_id, h1, h2, ref) as linguistic tokens, with the sentences as ``*_text``."""
    sides = ("h1", "h2", "ref")
    return text_triples(spark, sf_dir).select(
        "id",
        "doc_id",
        *[F.col(s).alias(f"{s}_text") for s in sides],
        *[word_tokens(F.col(s)).alias(s) for s in sides],
    )
