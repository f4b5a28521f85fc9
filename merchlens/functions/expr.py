"""Scalar expressions, all built from native functions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.constants import FIELD_SEPARATOR, RATING_MARKER

# Every character up to the blank counts as white space when payloads are trimmed.
CONTROL_AND_BLANK = "".join(chr(code) for code in range(33))


def year_month(ts: Column, scale: int = 1000) -> Column:
    """``yyyyMM`` as an integer, in UTC whatever the session time zone.

    ``ts * scale`` is read as epoch milliseconds: 1000 for epoch seconds, 100 for
    tables written by the older statistics job. Null where that is no date of the years
    1 to 9999.
    """
    days = F.floor(ts.cast("bigint").cast("double") * scale / 86_400_000)
    day = F.date_from_unix_date(F.when(days.between(-719_162, 2_932_896), days).cast("int"))
    return F.year(day) * 100 + F.month(day)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``changeDate(ts)`` and ``changeDateScaled(ts, scale)`` available to SQL text.

    Like ``year_month``: ``ts * scale`` is read as epoch milliseconds, and what is no date
    of the years 1 to 9999 is null.
    """
    days = "CAST(floor(CAST(ts AS DOUBLE) * scale / 86400000) AS BIGINT)"
    month = f"""CASE WHEN {days} BETWEEN -719162 AND 2932896 THEN
        year(date_from_unix_date(CAST({days} AS INT))) * 100 + month(date_from_unix_date(CAST({days} AS INT))) END"""
    for name, parameters, body in (
        ("changeDate", "ts BIGINT", month.replace("scale", "1000")),
        ("changeDateScaled", "ts BIGINT, scale INT", month),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS INT RETURN {body}")


def name_hash(name: Column) -> Column:
    """The JVM's 32-bit string hash (base 31 over UTF-16 units), used as user id."""
    units = F.regexp_extract_all(F.hex(F.encode(name, "UTF-16BE")), F.lit("(....)"), F.lit(1))
    unsigned = F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda acc, unit: (acc * 31 + F.conv(unit, 16, 10).cast("bigint")).bitwiseAND(
            F.lit(0xFFFFFFFF).cast("bigint")
        ),
    )
    half, full = 1 << 31, 1 << 32
    return F.when(unsigned >= half, unsigned - full).otherwise(unsigned).cast("int")


def halve_score(score: Column) -> Column:
    """Half the given score with two decimals, half up."""
    return F.round(score.cast("double") / 2, 2)


def log10_count(n: Column) -> Column:
    return F.log10(F.greatest(n, F.lit(1)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def largest_entry(a: Column) -> Column:
    """Greatest absolute entry; null or NaN where there is no finite one."""
    return F.array_max(F.transform(a, lambda x: F.abs(x.cast("double"))))


def in_range(a: Column) -> Column:
    """A vector in the same direction whose squares neither overflow nor vanish.

    Vectors with entries of usual size stay as they are.
    """
    top = largest_entry(a)
    extreme = ((top > 1e100) | ((top > 0) & (top < 1e-100))) & (top < float("inf"))
    return F.when(extreme, F.transform(a, lambda x: x.cast("double") / top)).otherwise(
        F.transform(a, lambda x: x.cast("double"))
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where either has no length or their lengths differ."""
    a, b = in_range(a), in_range(b)
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), norm(a) * norm(b)))


def trim_payload(value: Column) -> Column:
    return F.btrim(value, F.lit(CONTROL_AND_BLANK))


def rating_payload(line: Column) -> Column:
    """The text between the first marker and the next one (or the end), trimmed."""
    return trim_payload(F.split_part(line, F.lit(RATING_MARKER), F.lit(2)))


def event_line(user_id: Column, product_id: Column, score: Column, ts: Column) -> Column:
    fields = F.concat_ws(FIELD_SEPARATOR, user_id, product_id, score.cast("double"), ts)
    return F.concat(F.lit(RATING_MARKER), fields)


def recode_query(text: Column) -> Column:
    """Undo a latin-1 decoding of UTF-8 query text.

    Text with characters outside latin-1, or whose bytes are no UTF-8, is right already
    and stays as it is.
    """
    latin = text.rlike(r"\A[\x{0}-\x{FF}]*\z")
    raw = F.when(latin, F.encode(F.when(latin, text), "ISO-8859-1"))
    decoded = F.try_validate_utf8(raw.cast("string"))
    return F.coalesce(decoded, text)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    A filter on a plain projection is pushed below it and repeats the expression in
    every condition. A generator stops that, which pays off for parsed text.
    """
    fields = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(fields)))
