"""Exact global ranks without a single-task sort, and the folds built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versus.session import materialize


def with_rank(df: DataFrame, keys: list[str], name: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row in the order of ``keys``.

    Rows are range-partitioned and stored with their partition's number. A row's rank is then
    the size of the partitions before its own plus its position inside it. ``keys`` should
    identify a row; equal keys share a partition.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(
        df.repartitionByRange(n_parts, *keys).withColumn("__part", F.spark_partition_id())
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1
    return (
        ranged.join(F.broadcast(offsets), "__part")  # one row per shuffle partition
        .withColumn(name, F.col("__offset") + inside)
        .drop("__part", "__offset")
    )


def contiguous_fold(rank: Column, total: Column, k: int) -> Column:
    """Fold of a rank when ``total`` rows are cut into k runs, the first ones longer by one."""
    size = F.floor(total / k)
    longer = total % k
    edge = longer * (size + 1)
    late = F.floor(F.try_divide(rank - edge, size))
    return F.when(rank < edge, F.floor(rank / (size + 1))).otherwise(longer + late).cast("int")


def kfold(df: DataFrame, k: int = 10, by: str = "id") -> DataFrame:
    """Add ``fold``: contiguous runs in the order of ``by``."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = with_rank(df, [by], "__rank")
    return ranked.withColumn("fold", contiguous_fold(F.col("__rank"), total, k)).drop("__rank")


def stratified_kfold(df: DataFrame, k: int = 3, label: str = "label", by: str = "id") -> DataFrame:
    """Add ``fold``: contiguous runs inside each label."""
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("__total"))
        .withColumn("__start", F.coalesce(F.sum("__total").over(before), F.lit(0)))
    )
    ranked = with_rank(df, [label, by], "__rank")
    # One row per class; left to the planner, which knows its size.
    joined = ranked.join(sizes, label)
    fold = contiguous_fold(F.col("__rank") - F.col("__start"), F.col("__total"), k)
    return joined.withColumn("fold", fold).drop("__rank", "__start", "__total")


def holdout(df: DataFrame, seed: int = 42, parts: int = 10, by: str = "id") -> DataFrame:
    """Add ``is_test`` for one part in ``parts``, decided by a hash of the id and the seed."""
    digest = F.md5(F.concat(F.col(by).cast("string"), F.lit(f":{seed}")))
    value = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", value % parts == 0)
