"""A topic as a folder: keyed lines in partitions, visible batch by batch.

A batch is one folder, written by Spark's committer: its marker file appears when all tasks
are through, and readers (``sources.tail`` with the same marker) pass over folders without
it. So a failed task leaves nothing visible, and a batch that is repeated after its marker
was set is not written again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.constants import FIELD_SEPARATOR
from merchlens.sources.tail import tail_lines
from merchlens.streaming.log_events import _trigger

MARKER = "_SUCCESS"
PARTITIONS = 8


def keyed(lines: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """``lines`` with ``key``, the user id, and ``topic_partition``, which the key decides."""
    key = F.get(F.split("value", rf"\{FIELD_SEPARATOR}"), F.lit(0))
    keyed_ = lines.withColumn("key", key)
    return keyed_.withColumn("topic_partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))


def write_batch(batch: DataFrame, path: str, batch_id: int, partitions: int = PARTITIONS) -> bool:
    """Write a batch's lines unless it is there already; whether it was written.

    Lines of one key stand in one partition, in the order of ``partition`` and ``offset``
    where the batch has them. Rows are dealt by topic partition and ranges of their order,
    so a partition that a third of all lines go to is sorted by several tasks, whose files
    follow each other by name.
    """
    folder = f"{path}/batch_id={batch_id:012d}"
    spark = batch.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marker = hadoop.Path(f"{folder}/{MARKER}")
    if marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        return False
    order = [c for c in ("partition", "offset") if c in batch.columns]
    rows = keyed(batch, partitions)
    keys = ["topic_partition", *order]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.select("value", "topic_partition").write.mode("overwrite").partitionBy("topic_partition").text(folder)
    return True


def write_topic_folder(
    lines: DataFrame, path: str, checkpoint: str, available_now: bool = False, partitions: int = PARTITIONS
):
    """Stream payload lines into a topic folder."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, partitions)

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return _trigger(writer, available_now).start()


def read_topic_folder(spark: SparkSession, path: str, starting: str = "earliest") -> DataFrame:
    """The lines of a topic folder as a stream, whole batches only.

    ``starting`` is ``earliest``, ``latest`` or bytes by file, as for ``tail_lines``; a
    file's name tells batch and partition.
    """
    return tail_lines(spark, path, starting, MARKER)
