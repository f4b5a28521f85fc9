"""The engine's input tables as derived from a folder of TPC-H-like parquet tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.constants import RATING_MARKER
from merchlens.functions.expr import computed_once, name_hash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column) -> F.Column:
    """Epoch seconds of a zone-less timestamp read as UTC, in any session time zone."""
    return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), column)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line is a rating of the part by the customer, scored 1 to 5."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        seconds(F.col("l_shipdate")).alias("ts"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.get_json_object("props", "$.k").cast("int")
    return computed_once(table(spark, sf_dir, "events"), product_id=product).select(
        "event_id",
        F.col("user_id").cast("int").alias("user_id"),
        "product_id",
        (1 + F.pmod(F.floor("value"), F.lit(5))).cast("double").alias("score"),
        seconds(F.col("ts")).alias("ts"),
        "event_type",
    )


def log_lines(spark: SparkSession, sf_dir: str, of=None) -> DataFrame:
    """Application log: error events give lines without a rating, signups a broken one.

    ``of`` is a condition on the events whose lines are wanted.
    """
    payload = F.concat_ws("|", "user_id", "product_id", "score", "ts")
    broken = F.concat_ws("|", "user_id", "product_id", "event_type", "ts")
    line = (
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit("WARN request failed for user "), F.col("user_id").cast("string")),
        )
        .when(
            F.col("event_type") == "signup",
            F.concat(F.lit(f"INFO app - {RATING_MARKER}"), broken),
        )
        .otherwise(F.concat(F.lit(f"INFO app - {RATING_MARKER}"), payload, F.lit(" ")))
    )
    wanted = events(spark, sf_dir) if of is None else events(spark, sf_dir).where(of)
    return computed_once(wanted, value=line).select("value")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("name"),
        F.lit("").alias("image_url"),
        F.col("p_type").alias("categories"),
        F.concat_ws("|", F.split("p_name", " ")).alias("tags"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("product_id"), F.col("embedding").alias("features")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a user; the id is the hash of the name."""
    return table(spark, sf_dir, "customer").select(
        name_hash(F.col("c_name")).alias("user_id"),
        F.col("c_name").alias("username"),
        F.lit(True).alias("first"),
        F.array("c_mktsegment").alias("pref_genres"),
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
    )
