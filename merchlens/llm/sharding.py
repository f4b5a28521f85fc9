"""Shards in random order by a two-pass shuffle.

Pass one scatters the records into buckets that fit into a task's memory, by a seeded
hash of each record's place. Pass two shuffles each bucket by Fisher-Yates and gives the
records their places in the global order, which are dealt to the shards in turn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.tables import set_aside, small, stored, text_or_empty, without


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A random order of n things: each place is swapped with one at or before it."""
    order = np.arange(n)
    random = np.random.Generator(np.random.PCG64(seed))
    picks = random.integers(0, np.arange(1, n + 1)) if n else order
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def bucket_count(total_bytes: int, rows: int, bucket_bytes: int, bucket_rows: int) -> int:
    return max(1, -(-total_bytes // bucket_bytes), -(-rows // bucket_rows))


def shuffled(
    docs: DataFrame,
    seed: int = 17,
    bucket_bytes: int = 16 << 20,
    bucket_rows: int = 200_000,
) -> DataFrame:
    """``docs`` with ``bucket``, ``place`` (in its shuffled bucket) and ``position``.

    ``position`` numbers all records from 0 without a gap in one random order. Records
    are scattered by their place in the input, not by their content, so copies of a
    text, or whole rows that repeat, spread evenly and any bucket has close to its share
    of the bytes. Columns of ``docs`` with the new columns' names are replaced. One record
    larger than a bucket makes its bucket larger by itself. An empty table gives an empty
    table; null texts count as empty.
    """
    docs = without(docs, "bucket", "place", "position", "__at")
    size = F.octet_length(text_or_empty()).cast("long") + 16
    numbered = docs.select("*", F.monotonically_increasing_id().alias("__at"))
    total = docs.agg(F.sum(size).alias("b"), F.count("*").alias("n")).first()
    buckets = bucket_count(total["b"] or 0, total["n"], bucket_bytes, bucket_rows)
    scattered = numbered.withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("__at")), F.lit(buckets)).cast("int")
    )
    schema = scattered.drop("__at").schema.add("place", "long")

    def shuffle(group: pa.Table) -> pa.Table:
        group = group.sort_by("__at")
        bucket = group["bucket"][0].as_py()
        order = fisher_yates(group.num_rows, seed * 1_000_003 + bucket)
        out = group.drop_columns(["__at"]).take(pa.array(order))
        return out.append_column("place", pa.array(np.arange(group.num_rows), pa.int64()))

    dealt = scattered.groupBy("bucket").applyInArrow(shuffle, schema)
    dealt = stored(dealt, "shuffled")
    # One row per bucket: the first position of each, as a running sum.
    counts = dealt.groupBy("bucket").agg(F.count("*").alias("n"))
    firsts = _running(counts, buckets)
    firsts = firsts.withColumnRenamed("first", "__first")
    return dealt.join(small(firsts, buckets), "bucket").withColumn(
        "position", F.col("__first") + F.col("place")
    ).drop("__first")


def _running(counts: DataFrame, buckets: int, width: int = 4096) -> DataFrame:
    """``bucket, first``: sums of the counts of all earlier buckets, group by group."""
    group = F.floor(F.col("bucket") / width)
    counts = counts.select("bucket", "n", group.alias("g"))
    sums = counts.groupBy("g").agg(F.sum("n").alias("sum"))
    earlier = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("g", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(sums, "g").select(
        "bucket", (F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first")
    )


def shards(docs: DataFrame, n_shards: int = 40, seed: int = 17, **sizes) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: shard counts differ by at most one row.

    The records' random positions are dealt to the shards in turn, so slots are gapless
    from 0 in each shard, and a shard is in random order itself. Columns of ``docs`` with
    these two names are replaced; all others stay.
    """
    own, back = set_aside(without(docs, "shard", "slot"), "text")
    position = F.col("position")
    return shuffled(own, seed, **sizes).select(
        *back.values(),
        (position % n_shards).cast("int").alias("shard"),
        F.floor(position / n_shards).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; within a file the rows are in the order of their slots.

    A shard's files hold ranges of slots, so no task holds a shard.
    """
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)

