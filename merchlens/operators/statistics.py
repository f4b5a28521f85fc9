"""Popularity and average-score statistics over the ratings table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.expr import year_month


def rate_more(ratings: DataFrame) -> DataFrame:
    """Ratings per product."""
    return ratings.groupBy("product_id").agg(F.count("product_id").alias("count"))


def rate_more_recently(ratings: DataFrame, scale: int = 1000, ordered: bool = True) -> DataFrame:
    """Ratings per product and month, newest and most rated first.

    A stored table keeps no row order, so writers pass ``ordered=False``.
    """
    counts = (
        ratings.select("product_id", year_month(F.col("ts"), scale).alias("yearmonth"))
        .groupBy("yearmonth", "product_id")
        .agg(F.count("product_id").alias("count"))
        .select("product_id", "count", "yearmonth")
    )
    if not ordered:
        return counts
    return counts.orderBy(F.desc("yearmonth"), F.desc("count"), "product_id")


def average_products(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("product_id").agg(F.avg("score").alias("avg"))


def monthly_totals(ratings: DataFrame, scale: int = 1000) -> DataFrame:
    """Counts and score sums per product and month.

    All three statistics follow from this table, so one pass over the ratings is
    enough to build and to refresh them.
    """
    return (
        ratings.select("product_id", "score", year_month(F.col("ts"), scale).alias("yearmonth"))
        .groupBy("product_id", "yearmonth")
        .agg(
            F.count("product_id").alias("count"),
            F.count("score").alias("n_scores"),
            F.sum("score").alias("sum_score"),
        )
    )


def monthly_changes(before: DataFrame, after: DataFrame, scale: int = 1000) -> DataFrame:
    """What replacing some ratings changes in the monthly totals: old rows count as -1."""
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    month = year_month(F.col("ts"), scale).alias("yearmonth")
    rows = signed.select("product_id", month, "score", "_sign")
    one = F.when(F.col("product_id").isNotNull(), F.col("_sign")).otherwise(0)
    scored = F.when(F.col("score").isNotNull(), F.col("_sign")).otherwise(0)
    return rows.groupBy("product_id", "yearmonth").agg(
        F.sum(one).alias("count"),
        F.sum(scored).alias("n_scores"),
        F.coalesce(F.sum(F.col("score") * F.col("_sign")), F.lit(0.0)).alias("sum_score"),
    )


def product_totals(monthly: DataFrame) -> DataFrame:
    """Per product: rating count and average score, from the monthly table."""
    return (
        monthly.groupBy("product_id")
        .agg(
            F.sum("count").alias("count"),
            F.try_divide(F.sum("sum_score"), F.sum("n_scores")).alias("avg"),
        )
    )


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    return ratings.select("product_id").distinct()


def _ranked(top: DataFrame, *order) -> DataFrame:
    # The input is already cut to the requested list length.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def hot_products(recently: DataFrame, n: int) -> DataFrame:
    """The first ``n`` entries by month, then count; a product keeps its best rank."""
    order = (F.desc("yearmonth"), F.desc("count"), F.col("product_id"))
    top = _ranked(recently.orderBy(*order).limit(n), *order)
    return top.groupBy("product_id").agg(F.min("rank").alias("rank"))


def most_rated_products(counts: DataFrame, n: int) -> DataFrame:
    order = (F.desc("count"), F.col("product_id"))
    return _ranked(counts.orderBy(*order).limit(n), *order).select("product_id", "rank", "count")
