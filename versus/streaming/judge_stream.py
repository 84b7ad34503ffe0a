"""The judging flow over a stream of documents, with a running confusion matrix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.session import scratch_dir


def read_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files in ``folder`` whose names match ``pattern``.

    Where ``pattern`` matches folders, as tables of many files are stored, their files are read.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = path.getFileSystem(conf).globStatus(path)
    if any(f.isDirectory() for f in found or ()):
        source, options = f"{folder}/{pattern}", {}
    else:
        source, options = folder, {"pathGlobFilter": pattern}
    schema = spark.read.options(**options).parquet(source).schema
    stream = spark.readStream.schema(schema).options(**options)
    return stream.option("maxFilesPerTrigger", files_per_batch).parquet(source)


def running_counts(judged: DataFrame, gold: DataFrame, on: str) -> DataFrame:
    """(gold, pred, cnt) over everything seen so far; the state is at most twelve rows."""
    return judged.join(gold, on).groupBy("gold", "pred").agg(F.count(F.lit(1)).alias("cnt"))


def run_to_end(counts: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Process all available input and return the last state of the counts as a stored table.

    Every batch writes a whole new table under its own number, so a repeated batch after a lost
    driver replaces its own output and no reader sees a half-written one. With a ``checkpoint``
    folder the tables are kept there, beside the stream's state: a later run goes on from both,
    and one that finds nothing new returns the state it found.
    """
    spark = counts.sparkSession
    base = checkpoint or scratch_dir(spark)
    out = f"{base}/counts"

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{out}/{number}")

    query = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{base}/checkpoint")
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(out)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], counts.schema)
    stored = spark.read.schema(counts.schema.add("batch", "long")).option("recursiveFileLookup", "true").parquet(out)
    return stored.where(F.col("batch") == stored.agg(F.max("batch")).scalar()).drop("batch")


def stream_judgements(
    spark: SparkSession,
    folder: str,
    pattern: str,
    judge: Callable[[DataFrame], DataFrame],
    gold: DataFrame,
    on: str,
) -> DataFrame:
    """Judge a stream of files row by row and count the outcomes against ``gold``."""
    stream = read_stream(spark, folder, pattern)
    return run_to_end(running_counts(judge(stream), gold, on))
