"""Sweep logs: text blocks holding a parameter line and an accuracy line, closed by dashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.sources.text import with_line_ids

# Fixed value: the line that closes a block.
BLOCK_END = "----------------------------"


def render_sweep_log(sweep: DataFrame) -> DataFrame:
    """(id, value) text blocks from (id, alpha, accuracy)."""
    return sweep.select(
        "id",
        F.format_string("Alpha: %s\nAccuracy = %.6f\n\n", F.col("alpha").cast("string"), "accuracy").alias(
            "value"
        ),
    )


def parse_sweep_log(blocks: DataFrame) -> DataFrame:
    """(id, alpha, accuracy) from (id, value); blocks without both lines are left out."""
    parsed = blocks.select(
        "id",
        F.regexp_extract("value", r"Alpha:\s*([^)\s]+)", 1).try_cast("double").alias("alpha"),
        F.regexp_extract("value", r"Accuracy\s*=\s*(\S+)", 1).try_cast("double").alias("accuracy"),
    )
    return parsed.where("alpha IS NOT NULL AND accuracy IS NOT NULL")


def read_sweep_log(spark: SparkSession, path: str) -> DataFrame:
    """(id, alpha, accuracy) in file order."""
    blocks = spark.read.option("lineSep", BLOCK_END).text(path)
    return parse_sweep_log(with_line_ids(blocks))
