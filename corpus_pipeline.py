"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a
DataFrame; it is written as Parquet and read again for the next. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from versus.llm.common import table
from versus.llm.langid import language_stage
from versus.llm.line_dedup import line_dedup_stage
from versus.llm.near_dedup import near_dedup_stage
from versus.llm.packing import packing_stage
from versus.llm.pii import pii_stage
from versus.session import materialize

STAGES = [
    ("language", language_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("personal_data", pii_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the stages (a fitted classifier, MinHash components, tokens).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
