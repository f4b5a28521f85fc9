"""Lookups of the read side, answered for a whole table of requests at once."""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.expr import event_line, halve_score
from merchlens.functions.ranking import left_join_spread, unpack_recs
from merchlens.operators import statistics
from merchlens.operators.ratings import upsert_ratings


def served_products(products: DataFrame, averages: DataFrame) -> DataFrame:
    """Products with their average score, 0.0 where nobody has rated them."""
    return products.join(averages, "product_id", "left").select(
        *products.columns, F.coalesce("avg", F.lit(0.0)).alias("score")
    )


def enrich(rows: DataFrame, served: DataFrame) -> DataFrame:
    """Product data for rows that name a product; rows of unknown products drop out."""
    return rows.join(served.withColumnRenamed("score", "avg_score"), "product_id")


def serve_hot(recently: DataFrame, served: DataFrame, n: int) -> DataFrame:
    return enrich(statistics.hot_products(recently, n), served)


def serve_most_rated(counts: DataFrame, served: DataFrame, n: int) -> DataFrame:
    return enrich(statistics.most_rated_products(counts, n), served)


def serve_recs(
    requests: DataFrame,
    recs: DataFrame,
    served: DataFrame,
    key: str,
    num: int | None = None,
    drop_missing: bool = False,
) -> DataFrame:
    """The first ``num`` recommendations of every request with their product data.

    ``requests`` carries a request id and ``key``; ``recs`` one packed list per key. A
    key without a list keeps one row without product, unless ``drop_missing``.
    """
    wanted = F.slice("recs", 1, num) if num else F.col("recs")
    lists = recs.select(key, wanted.alias("recs"))
    if drop_missing:
        rows = unpack_recs(requests.join(lists, key))
    else:
        rows = unpack_recs(left_join_spread(requests, lists, key), outer=True)
    products = served.withColumnRenamed("score", "avg_score").withColumn("_found", F.lit(True))
    found = left_join_spread(rows, products, "product_id")
    return found.where(F.col("product_id").isNull() | F.col("_found")).drop("_found")


def product_info(requests: DataFrame, served: DataFrame) -> DataFrame:
    """Product data by id; an unknown id keeps its row with nulls."""
    return requests.join(served.withColumnRenamed("score", "avg_score"), "product_id", "left")


def products_in(served: DataFrame, ids: DataFrame) -> DataFrame:
    return served.join(ids.select("product_id").distinct(), "product_id", "left_semi")


def search_products(served: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Products whose name contains a match of a pattern, for several patterns in one scan."""
    hits = F.array(
        *[F.when(F.col("name").rlike(p), F.lit(name)) for name, p in patterns.items()]
    )
    return served.select(F.explode(F.array_compact(hits)).alias("query"), "*")


def record_ratings(
    requests: DataFrame, users: DataFrame, stored: DataFrame, now: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rating requests by user name on a 10-point scale; a null ``ts`` means ``now``.

    ``now`` is one number for all outputs, by default the time of this call.

    Returns the accepted ratings, the ratings table with them applied, the event lines
    to log, and the requests of unknown users.
    """
    named = requests.join(users.select("username", "user_id"), "username", "left")
    accepted = named.where(F.col("user_id").isNotNull()).select(
        "user_id",
        "product_id",
        halve_score(F.col("score")).alias("score"),
        F.coalesce("ts", F.lit(int(time.time()) if now is None else now).cast("bigint")).alias("ts"),
    )
    lines = accepted.select(
        event_line(F.col("user_id"), F.col("product_id"), F.col("score"), F.col("ts")).alias("value")
    )
    unknown = named.where(F.col("user_id").isNull()).drop("user_id")
    return accepted, upsert_ratings(stored, accepted), lines, unknown
