"""Tables written to the shared scratch folder, so that lineage ends and lost executors cost little."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskengine.session import scratch_path


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Send at most ``BATCH_ROWS`` rows at once to Python workers, whole texts being some kilobytes each: the
    usual ten thousand, held several times over, are most of a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS or int(spark.conf.get(key, "10000")) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back. The folder goes when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
