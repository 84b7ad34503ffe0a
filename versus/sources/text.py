"""Text readers. A line's position is its identity; it is attached here, once, as ``id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versus.functions.tokens import trim_punct, trim_ws, ws_tokens
from versus.operators.lookup import MAX_BROADCAST_ROWS
from versus.session import materialize

SIDES = ("h1", "h2", "ref")


def with_line_ids(lines: DataFrame) -> DataFrame:
    """Add ``id``, the 0-based line number over all files in path order.

    ``lines`` must come straight from a text reader. Lines of one file split are consecutive in
    the partition-wise increasing id, so a line's number is its split's offset plus its distance
    from the split's first line. Only the table of splits is ordered globally. Up to
    ``MAX_BROADCAST_ROWS`` splits (counted) it is broadcast, and the lines are neither sorted nor
    shuffled; beyond that they are shuffled by split.
    """
    tagged = lines.select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
    )
    splits = tagged.groupBy("__file", "__block").agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        splits.select(
            "__file",
            "__block",
            "__first",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        )
    )
    if offsets.count() <= MAX_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    numbered = tagged.join(offsets, ["__file", "__block"])
    return numbered.select(
        (F.col("__offset") + F.col("__at") - F.col("__first")).alias("id"), "value"
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return with_line_ids(spark.read.text(path))


def _fields(lines: DataFrame) -> DataFrame:
    return lines.select("id", "value", F.split("value", r" \|\|\| ").alias("f"))


def read_triples(spark: SparkSession, path: str, form: str = "tokens") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) from ``h1 ||| h2 ||| ref`` lines.

    ``form``: ``tokens`` (whitespace tokens), ``text`` (trimmed sentences) or ``stripped``
    (sentences without punctuation at their ends). A line must have exactly three fields;
    others go to the rejects as (id, value).
    """
    make = {"tokens": ws_tokens, "text": trim_ws, "stripped": trim_punct}[form]
    split = _fields(read_lines(spark, path))
    good = F.size("f") == 3
    rows = split.where(good).select(
        "id", *[make(F.col("f")[i]).alias(side) for i, side in enumerate(SIDES)]
    )
    return rows, split.where(~good).select("id", "value")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(id, label): one trimmed label per line."""
    return read_lines(spark, path).select("id", trim_ws(F.col("value")).alias("label"))


def read_judgements(spark: SparkSession, path: str) -> DataFrame:
    """(id, gold) from integer labels; a label that is no integer gives NULL."""
    return read_labels(spark, path).select("id", F.col("label").try_cast("int").alias("gold"))


def read_word_vectors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((word, vec), rejects) from blank-separated text.

    The last line of a repeated word wins. Lines with a field that is no number are rejected.
    """
    tokens = read_lines(spark, path).withColumn("f", ws_tokens(F.col("value")))
    vec = F.transform(
        F.slice("f", F.lit(2), F.greatest(F.size("f") - 1, F.lit(0))),
        lambda x: x.try_cast("double"),
    )
    parsed = tokens.where(F.size("f") > 0).select("id", "value", F.col("f")[0].alias("word"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull()) | (F.size("vec") == 0)
    good = parsed.where(~bad).groupBy("word").agg(F.max_by("vec", "id").alias("vec"))
    return good, parsed.where(bad).select("id", "value")


def write_lines(df: DataFrame, path: str, value: str = "value", by: str = "id") -> None:
    """Text lines in the order of ``by``: range-partitioned, so file order is row order."""
    df.select(by, F.col(value).cast("string").alias("value")).orderBy(by).select("value").write.text(path)


def write_triples(df: DataFrame, path: str, by: str = "id") -> None:
    """``h1 ||| h2 ||| ref`` lines from sentence columns."""
    write_lines(df.select(by, F.concat_ws(" ||| ", *SIDES).alias("value")), path, by=by)


__all__ = [
    "read_judgements",
    "read_labels",
    "read_lines",
    "read_triples",
    "read_word_vectors",
    "with_line_ids",
    "write_lines",
    "write_triples",
]
