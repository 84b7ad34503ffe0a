"""What the operators share: reading tables, sending the package to workers, train splits."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import versus


#: What a batch of rows may hold on its way to a Python worker, whatever the length of texts.
BATCH_BYTES = 4 << 20
BATCH_RECORDS = 1_000


def ship(spark: SparkSession) -> None:
    """Once a session: send this package to Python workers that may not have it installed, and
    bound the batches that travel to them, since texts may be long."""
    if spark.conf.get("versus.shipped", None):
        return
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_RECORDS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(versus.__file__)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="versus-code-"), "versus.zip")
    with open(path, "wb") as f:  # the driver serves this file to the executors
        f.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    spark.conf.set("versus.shipped", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty string."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % divisor


def buckets(df: DataFrame, least: int = 32, per_partition: int = 2) -> int:
    """A power of two that grows with the input: a bucket then holds a bounded share of it."""
    n = max(least, per_partition * df.rdd.getNumPartitions())
    return 1 << (n - 1).bit_length()


def set_apart(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but the ``used`` ones renamed, so that none clashes with a name
    an operator adds, and the selection that restores names and order."""
    names = [c if c in used else f"__kept_{i}" for i, c in enumerate(docs.columns)]
    restore = [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]
    return docs.toDF(*names), restore
