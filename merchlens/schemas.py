"""Table schemas and casts to the canonical column names and types."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRODUCT_FILE = (
    "product_id STRING, name STRING, category_ids STRING, external_code STRING, "
    "image_url STRING, categories STRING, tags STRING"
)
PRODUCT = "product_id INT, name STRING, image_url STRING, categories STRING, tags STRING"
RATING_FILE = "user_id STRING, product_id STRING, score STRING, ts STRING"
RATING = "user_id INT, product_id INT, score DOUBLE, ts BIGINT"
USER = (
    "user_id INT, username STRING, first BOOLEAN, created_at TIMESTAMP, "
    "pref_genres ARRAY<STRING>"
)
REC_ENTRY = "STRUCT<product_id: INT, score: DOUBLE>"
USER_RECS = f"user_id INT, recs ARRAY<{REC_ENTRY}>"
PRODUCT_RECS = f"product_id INT, recs ARRAY<{REC_ENTRY}>"
SIMILARITY = "product_id INT, sim_product_id INT, sim DOUBLE"
TUNING_GRID = "rank INT, reg_param DOUBLE, rmse DOUBLE"

#: Units a text or table may hold its epoch values in, as parts of a second.
UNITS = {"s": 1, "ms": 1000}
#: Epoch seconds of the years 1 to 9999; values outside are not times.
EARLIEST, LATEST = -62_135_596_800, 253_402_300_799


def epoch_seconds(ts, unit="s"):
    """Whole seconds from epoch values in ``unit``; null outside the years 1 to 9999."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}, not {unit!r}")
    parts = UNITS[unit]
    value = ts.try_cast("bigint")
    seconds = F.when(
        value.between(EARLIEST * parts, LATEST * parts + parts - 1),
        F.floor(value / parts).cast("bigint") if parts > 1 else value,
    )
    return F.when(seconds.between(EARLIEST, LATEST), seconds)


def as_ratings(df: DataFrame, unit: str = "s") -> DataFrame:
    """Cast any table carrying the four rating columns to the canonical types."""
    return df.select(
        F.col("user_id").cast("int"),
        F.col("product_id").cast("int"),
        F.col("score").cast("double"),
        epoch_seconds(F.col("ts"), unit).alias("ts"),
    )


def as_products(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("product_id").cast("int"),
        *[F.col(c).cast("string") for c in ("name", "image_url", "categories", "tags")],
    )


def with_product_lists(products: DataFrame) -> DataFrame:
    """Add the category and tag lists packed in one string each."""
    return products.withColumns(
        {
            "category_list": F.split("categories", r"\|"),
            "tag_list": F.split("tags", r"\|"),
        }
    )
