"""Session defaults and the shared scratch folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "versus", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Nothing here fixes the cluster's size: shuffle partitions and memory come from the
    submitter's configuration, AQE coalesces and splits partitions at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder, deleted when the session ends.

    The folder is read from ``spark.checkpoint.dir``. Where that is unset, a temporary folder is
    made, but only for a local master: elsewhere executors would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("versus.scratch.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="versus-")
        spark.conf.set("versus.scratch.dir", base)
    path = os.path.join(base, f"versus-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def materialize(df: DataFrame, partition_by: tuple[str, ...] = (), row_group: int | None = None) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives the planner true sizes, so that the
    automatic broadcast decision rests on a measured number of bytes. Zstandard takes less disk than
    the default. ``row_group``: bytes of a row group, for tables with large rows.
    """
    path = scratch_dir(df.sparkSession)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if row_group:
        writer = writer.option("parquet.block.size", str(row_group))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
