"""Session settings and the shared folder for checkpoints and intermediate tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key split inside a join may cost one more shuffle; still the better plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name="merchlens", master=None, **settings) -> SparkSession:
    """A session with the engine's settings; extra settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` as the session sets it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing there is overwritten or removed."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: made once, whatever follows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
