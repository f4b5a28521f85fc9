"""Rating upsert and the newest ratings of every user."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.constants import RECENT_LIST_CAP, RECENT_RATINGS
from merchlens.functions.ranking import top_per_key

def newest_first():
    return F.desc("ts"), F.desc("product_id"), F.desc("score")


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """One row per user and product: the newest rating, the higher score on a tie."""
    newest = F.max(F.struct("ts", "score")).alias("_newest")
    return (
        ratings.groupBy("user_id", "product_id")
        .agg(newest)
        .select("user_id", "product_id", "_newest.score", "_newest.ts")
    )


def upsert_ratings(base: DataFrame, updates: DataFrame, keep_ts: bool = False) -> DataFrame:
    """Base ratings with the updates applied, one row per user and product.

    At the same time stamp an update beats the base row. ``keep_ts`` keeps the time
    stamp of the first rating and replaces the score only.
    """
    columns = ["user_id", "product_id", "score", "ts"]
    versions = base.select(*columns, F.lit(0).alias("_update")).unionByName(
        updates.select(*columns, F.lit(1).alias("_update"))
    )
    newest = F.max(F.struct("ts", "_update", "score"))
    merged = versions.groupBy("user_id", "product_id").agg(
        newest.alias("_newest"), F.min("ts").alias("_first_ts")
    )
    return merged.select(
        "user_id",
        "product_id",
        F.col("_newest.score").alias("score"),
        F.col("_first_ts" if keep_ts else "_newest.ts").alias("ts"),
    )


def previous_products(events: DataFrame, ranges: int = 64) -> DataFrame:
    """``events`` with ``previous``: the product of the user's event before it, by time and
    ``event_id``; null for a user's first.

    Time is cut into ranges at quantiles of all events. Within a range of a user the
    predecessor is a neighbour; the first of a range takes the last product of the user's
    range before, one row per user and range. So a user with a third of all events is worked
    on in as many tasks as there are ranges.
    """
    edges = events.agg(F.percentile_approx("ts", [k / ranges for k in range(1, ranges)], 4 * ranges)).first()[0]
    cuts = F.lit(sorted(set(edges or ()))).cast("array<bigint>")
    cut = F.size(F.filter(cuts, lambda e: e < F.col("ts")))
    rows = events.withColumn("_range", F.coalesce(cut, F.lit(-1)))
    order = ["ts", "event_id"]
    inside = Window.partitionBy("user_id", "_range").orderBy(*order)
    own = rows.withColumn("_before", F.lag("product_id").over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    last = rows.groupBy("user_id", "_range").agg(
        F.max_by("product_id", F.struct(F.coalesce("ts", F.lit(-(1 << 62))), "event_id")).alias("_last")
    )
    earlier = Window.partitionBy("user_id").orderBy("_range")
    handed = last.select("user_id", "_range", F.lag("_last").over(earlier).alias("_handed"))
    joined = own.join(handed.withColumnRenamed("user_id", "_user").withColumnRenamed("_range", "_own"),
                      F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("_range") == F.col("_own")))
    previous = F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_before"))
    return joined.select(*events.columns, previous.alias("previous"))


def recent_ratings(
    ratings: DataFrame,
    n: int = RECENT_RATINGS,
    inclusive: bool = False,
    distinct_products: bool = False,
) -> DataFrame:
    """The newest ``n`` ratings of every user as rows with ``position`` from 1.

    ``inclusive`` reads the slice 0..n, that is one row more. Repeated ratings of one
    product each take a place unless ``distinct_products`` is set.
    """
    rows = ratings.select("user_id", "product_id", "score", "ts")
    if distinct_products:
        rows = latest_ratings(rows)
    return top_per_key(rows, ("user_id",), newest_first(), n + int(inclusive), rank="position")


def capped_recent_lists(ratings: DataFrame, cap: int = RECENT_LIST_CAP) -> DataFrame:
    """Per user the capped list, newest at the head."""
    entry = F.struct("position", "product_id", "score")
    return (
        recent_ratings(ratings, cap)
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("_list"))
        .select(
            "user_id",
            F.transform(
                "_list", lambda e: F.struct(e["product_id"].alias("product_id"), e["score"].alias("score"))
            ).alias("recents"),
        )
    )
