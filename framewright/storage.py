"""Tables on the cluster's shared folder, used to cut lineage.

Spark's own ``checkpoint()`` writes uncompressed rows; a parquet table in the
same folder is smaller, is read back column by column and survives the loss of
any executor. The folder is the one named by ``spark.checkpoint.dir``; a
temporary folder is used only where that setting is absent and the master is local (tests);
on a cluster without it nothing is written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share, as set for the session."""
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        setting = spark.conf.get("spark.checkpoint.dir", "")
        if not setting and not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(setting or tempfile.mkdtemp(prefix="framewright-"))
    return context.getCheckpointDir().get()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the dataset folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; deleted when the JVM ends. ``by``: columns that split it into folders."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in enough partitions to keep all cores busy with costly work per row.

    A file of few row groups is read by few tasks; its rows are then dealt out in turn (or by
    a hash of ``keys``, if given), whatever they hold, so that no value is a hot one. An input
    that is split finely enough is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(3 * cores, *keys)
