"""Product and rating text files: scans with a quarantine side, and the writers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.constants import PRODUCT_FILE_SEPARATOR, RATING_FILE_SEPARATOR
from merchlens.functions.expr import computed_once, trim_payload

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
PRODUCT_FIELDS = 7


def _read_delimited(spark, path, schema, separator, trim=True):
    return spark.read.csv(
        path,
        schema=schema,
        sep=separator,
        quote="",
        escape="",
        header=False,
        ignoreLeadingWhiteSpace=trim,
        ignoreTrailingWhiteSpace=trim,
        mode="PERMISSIVE",
    )


def scan_product_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Products and bad rows of a headerless ``^`` file with seven fields.

    The category-id list and the external code are dropped, as is anything after the
    seventh field; quotes are plain text. Fields may be empty, but for the id. Blank
    lines are no rows.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    names = [field.split()[0] for field in schemas.PRODUCT_FILE.split(", ")]
    parts = F.split("value", rf"\{PRODUCT_FILE_SEPARATOR}", -1)
    fields = {name: trim_payload(F.get("_parts", F.lit(i))) for i, name in enumerate(names)}
    typed = computed_once(computed_once(lines, _parts=parts), **fields)
    typed = computed_once(
        typed,
        _id=F.col("product_id").try_cast("int"),
        _complete=F.size("_parts") >= PRODUCT_FIELDS,
    )
    complete = F.col("_id").isNotNull() & F.col("_complete")
    good = typed.where(complete).select(
        F.col("_id").alias("product_id"), "name", "image_url", "categories", "tags"
    )
    return good, typed.where(~complete).select(*names)


def scan_rating_file(
    spark: SparkSession, path: str, unit: str = "s"
) -> tuple[DataFrame, DataFrame]:
    """Ratings and bad rows of a headerless ``user,product,score,epoch`` file.

    ``unit`` says what the epoch counts: seconds (``s``) or milliseconds (``ms``).
    """
    raw = _read_delimited(spark, path, schemas.RATING_FILE, RATING_FILE_SEPARATOR)
    return split_ratings_text(raw, unit)


def _number(text):
    """A finite decimal number, else null; a failed cast costs far more than the test."""
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def split_ratings_text(raw: DataFrame, unit: str = "s") -> tuple[DataFrame, DataFrame]:
    """Typed ratings, and the rows whose four text fields do not parse.

    An epoch value outside the years 1 to 9999 does not parse.
    """
    typed = computed_once(
        raw,
        _user=F.col("user_id").try_cast("int"),
        _product=F.col("product_id").try_cast("int"),
        _score=_number(F.col("score")),
        _ts=schemas.epoch_seconds(F.col("ts"), unit),
    )
    parsed = (
        F.col("_user").isNotNull()
        & F.col("_product").isNotNull()
        & F.col("_score").isNotNull()
        & F.col("_ts").isNotNull()
    )
    good = typed.where(parsed).select(
        F.col("_user").alias("user_id"),
        F.col("_product").alias("product_id"),
        F.col("_score").alias("score"),
        F.col("_ts").alias("ts"),
    )
    return good, typed.where(~parsed).drop("_user", "_product", "_score", "_ts")


def write_product_file(products: DataFrame, path: str) -> None:
    """The file form of a product table, with the two unused fields left empty."""
    products.select(
        F.concat_ws(
            PRODUCT_FILE_SEPARATOR,
            F.col("product_id").cast("string"),
            "name",
            F.lit(""),
            F.lit(""),
            F.coalesce("image_url", F.lit("")),
            "categories",
            "tags",
        ).alias("value")
    ).write.mode("overwrite").text(path)


def write_rating_file(ratings: DataFrame, path: str) -> None:
    ratings.select(
        F.concat_ws(RATING_FILE_SEPARATOR, "user_id", "product_id", "score", "ts").alias("value")
    ).write.mode("overwrite").text(path)


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Write one text column as a line file."""
    (column,) = lines.columns
    lines.select(F.col(column).alias("value")).write.mode(mode).text(path)


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A growing folder of log files as a stream of ``value`` lines.

    A file is read once, when it is first seen: move only closed files in. Lines that are
    appended later are not read, and a file older than the newest one by more than the
    reader's ``maxFileAge`` (seven days) may be passed over.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)
