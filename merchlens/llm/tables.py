"""Reading the corpus tables, cutting lineage, and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.session import scratch_path


def corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again.

    What follows starts from these files, so a lost executor never repeats what came
    before, and a plan that uses the rows twice makes them once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` without the columns that an operator is about to add under these names."""
    return docs.drop(*names)


#: Bytes of a table that is sent to every executor; larger ones are joined by key.
SMALL_BYTES = 64 << 20
#: Numbers that a filter before a join sends to every executor (8 bytes each).
FILTER_KEYS = 4 << 20


def row_bytes(kind: T.DataType) -> int:
    """About what a value of a type takes in a row, given short texts and lists."""
    if isinstance(kind, T.StructType):
        return 8 + sum(row_bytes(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return 16 + 8 * row_bytes(kind.elementType)
    return 32 if isinstance(kind, (T.StringType, T.BinaryType)) else 8


def small(df: DataFrame, rows: int) -> DataFrame:
    """A hint to broadcast, given only where the counted rows are few bytes."""
    return F.broadcast(df) if rows * (16 + row_bytes(df.schema)) <= SMALL_BYTES else df


class KeyFilter:
    """Which rows can meet a table of whole-number keys, before they are shuffled to it.

    Tasks get the sorted keys, 8 bytes each; of more than ``most`` distinct keys none are
    sent and every row passes. A join that follows decides.
    """

    def __init__(self, df: DataFrame, column: str, most: int = FILTER_KEYS):
        keys = df.select(F.col(column).cast("bigint").alias("k")).distinct()
        count = keys.count()
        self.keys = self.null = None
        if count <= most:
            found = keys.toArrow()["k"].combine_chunks()
            self.null = found.null_count > 0
            self.keys = np.sort(found.drop_null().to_numpy())

    def passes(self, column: pa.Array) -> np.ndarray:
        if self.keys is None:
            return np.ones(len(column), bool)
        missing = column.is_null().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy()
        if not len(self.keys):
            return missing & self.null
        at = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        return np.where(missing, self.null, self.keys[at] == values)


def set_aside(df: DataFrame, *keep: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with all columns but those of ``keep`` under numbers, and every old column.

    An operator can then use any name of its own; the columns (by their old names, in the
    old order) select what it was given, whatever the names hold.
    """
    numbered, back = [], {}
    for i, name in enumerate(df.columns):
        own = name if name in keep else f"__own_{i}"
        numbered.append(F.col(quoted(name)).alias(own))
        back[name] = F.col(own).alias(name)
    return df.select(*numbered), back


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def min_label_components(edges: DataFrame) -> DataFrame:
    """``node, component``: the least node reachable over ``edges(a, b)``.

    Each round links every node's larger neighbours, and itself, to its least neighbour,
    alternating which neighbours are moved, until nothing changes; the edge list never
    outgrows its first length by more than the nodes, and the rounds grow with the
    logarithm of the longest path. Hubs cost nothing: the least neighbour is a combining
    minimum. Nodes without an edge do not appear.
    """
    pairs = edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    pairs = stored(pairs, "links")
    while True:
        large = _star(_both(pairs), larger=True)
        small = stored(_star(large, larger=False), "links")
        changed = small.join(pairs, ["a", "b"], "left_anti").limit(1).count()
        if not changed and small.count() == pairs.count():
            break
        pairs = small
    nodes = small.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(small.select(F.col("a"), F.col("a"))).groupBy("node").agg(
        F.min("component").alias("component")
    )


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select("b", "a"))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Pairs ``(least, node)``: neighbours of a node tied to the least one around it."""
    if larger:  # pairs hold both directions: move larger neighbours
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        moved = pairs.where("b > a").join(least, "a").select(
            F.col("m").alias("a"), F.col("b")
        )
    else:  # a < b in every pair: move smaller neighbours of b, and b itself
        least = pairs.groupBy("b").agg(F.min("a").alias("m"))
        moved = pairs.join(least, "b")
        moved = moved.select(F.col("m").alias("a"), F.col("a").alias("b")).union(
            moved.select(F.col("m").alias("a"), F.col("b").alias("b"))
        )
    return moved.where("a < b").distinct()
