"""Bounded rankings per key and the packed lists made from them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys, order, k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows of every key.

    The filter on the row number lets Spark cut each key to ``k`` rows in every map
    task before the shuffle, so no task receives more than ``k`` rows per map task of
    a hot key.
    """
    name = rank or "_position"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def left_join_spread(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key whose nulls may be many.

    Null keys match nothing but would all meet in one partition, so rows with a null key
    pass by the join. No row is sent anywhere by its place in the input: a task that is
    repeated gives the same rows to the same tasks.
    """
    added = [f for f in right.schema if f.name != key]
    named = left.where(F.col(key).isNotNull()).join(right, key, "left")
    columns = [*left.columns, *(f.name for f in added)]
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
    return named.select(*columns).union(left.where(F.col(key).isNull()).select(*left.columns, *nulls))


def pack_recs(
    df: DataFrame, key: str, product: str = "product_id", score: str = "score"
) -> DataFrame:
    """One row per key with its list, best score first, lower product id on a tie.

    For rows cut to a fixed length per key before (``top_per_key``).
    """
    entry = F.struct((-F.col(score)).alias("neg"), F.col(product).cast("int").alias("id"))
    best_first = F.array_sort(F.collect_list(entry))
    return df.groupBy(key).agg(
        F.transform(
            best_first,
            lambda e: F.struct(e["id"].alias("product_id"), (-e["neg"]).alias("score")),
        ).alias("recs")
    )


def unpack_recs(df: DataFrame, recs: Column | str = "recs", *, outer: bool = False) -> DataFrame:
    """Rows ``(…, rank, product_id, score)`` from packed lists, rank from 1."""
    recs = F.col(recs) if isinstance(recs, str) else recs
    explode = F.posexplode_outer if outer else F.posexplode
    keep = [c for c in df.columns if c not in ("recs", "product_id", "score")]
    return df.select(*keep, explode(recs).alias("_pos", "_rec")).select(
        *keep,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_rec.product_id").alias("product_id"),
        F.col("_rec.score").alias("score"),
    )
