"""Stored results: vectors and judgements, keyed by id; tables in buckets of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from versus.sources.text import write_lines

VECTOR_SCHEMA = "id bigint, features array<double>"


def save_vectors(df: DataFrame, path: str) -> None:
    df.select("id", "features").write.parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VECTOR_SCHEMA).parquet(path)


def save_judgements(df: DataFrame, path: str, form: str = "parquet") -> None:
    """(id, pred) as a table, or one judgement per text line in the order of ids."""
    if form == "text":
        write_lines(df, path, value="pred")
    else:
        df.select("id", "pred").write.parquet(path)


def load_judgements(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id bigint, pred int").parquet(path)


def save_bucketed(df: DataFrame, path: str, name: str, by: list[str], buckets: int) -> DataFrame:
    """Store ``df`` under ``path`` as table ``name`` in ``buckets`` buckets, one sorted file each.

    Tables with the same number of buckets of the join's keys are joined without a shuffle. A bucket
    is one task's work: choose ``buckets`` so that a bucket has a few hundred MB.
    """
    dealt = df.repartition(buckets, *by)
    dealt.write.format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def load_bucketed(
    spark: SparkSession, path: str, name: str, schema: str, by: list[str], buckets: int
) -> DataFrame:
    """Name a table that ``save_bucketed`` stored, perhaps in another session, and read it."""
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"CREATE TABLE `{name}` ({schema}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
