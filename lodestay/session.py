"""Session settings the jobs are written for.

Nothing in the library depends on these being set: they are the settings a
deployment should start from.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    # AQE picks the number of reducers, splits skewed join partitions and
    # switches to a broadcast join only after it has measured the side.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # no call site is looked up for each column expression while a plan is built; errors name fewer lines
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "lodestay", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the recommended settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable(df: DataFrame) -> DataFrame:
    """``df`` for repeated reading, cut off from its lineage where the cluster allows it.

    With ``spark.checkpoint.dir`` set by the cluster the rows are checkpointed
    there and survive lost executors. Without it they are only cached, and a
    lost block is computed again from the plan.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return df.checkpoint()
    return df.persist()


def written(df: DataFrame) -> DataFrame:
    """``durable`` as Parquet in the checkpoint folder: a fraction of the bytes, and readers take only their columns."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        return df.persist()
    path = f"{folder.rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
