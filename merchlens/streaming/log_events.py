"""From application log lines to typed ratings. Works on batch and streaming lines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.constants import RATING_LINE_PATTERN, RATING_MARKER, TRIGGER_INTERVAL
from merchlens.functions.expr import computed_once, rating_payload
from merchlens.sources.files import split_ratings_text
from merchlens.sources.tables import STREAM_BUCKETS, with_user_bucket


def collector_lines(lines: DataFrame) -> DataFrame:
    """Lines the log collector forwards; most lines fail the cheap test before the pattern."""
    word = RATING_MARKER.rstrip(":")
    return lines.where(F.col("value").contains(word) & F.col("value").rlike(RATING_LINE_PATTERN))


def rating_payloads(lines: DataFrame) -> DataFrame:
    """Payload text of the lines with the marker."""
    marked = lines.where(F.col("value").contains(RATING_MARKER))
    return computed_once(marked, _payload=rating_payload(F.col("value"))).select(
        F.col("_payload").alias("value")
    )


def keyed_payloads(lines: DataFrame) -> DataFrame:
    """Payloads of the collected lines with ``partition, offset``, the lines' places."""
    found = collector_lines(lines).where(F.col("value").contains(RATING_MARKER))
    return computed_once(found, _payload=rating_payload(F.col("value"))).select(
        "partition", "offset", F.col("_payload").alias("value")
    )


def parse_payloads(payloads: DataFrame, unit: str = "s") -> tuple[DataFrame, DataFrame]:
    """Typed ratings, and the payloads that are not ``user|product|score|epoch``."""
    fields = ("user_id", "product_id", "score", "ts")
    raw = computed_once(payloads, _parts=F.split("value", r"\|")).select(
        "value", *[F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(fields)]
    )
    good, bad = split_ratings_text(raw, unit)
    return good, bad.select("value")


def _payloads(lines: DataFrame, bare: bool) -> DataFrame:
    """Payloads of log lines; ``bare`` lines are payloads already, as on the rating topic."""
    return lines.select("value") if bare else rating_payloads(collector_lines(lines))


def _trigger(writer, available_now):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=TRIGGER_INTERVAL)


def write_ratings_log(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    buckets: int = STREAM_BUCKETS,
    bare: bool = False,
):
    """Stream the good ratings of a line stream into the ratings table.

    Like every sink here it takes the lines that the collector forwards, or ``bare``
    payloads.
    """
    good, _ = parse_payloads(_payloads(lines, bare))
    writer = (
        with_user_bucket(good, buckets)
        .writeStream.format("parquet")
        .partitionBy("user_bucket")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _trigger(writer, available_now).start()


def write_quarantine(
    lines: DataFrame, path: str, checkpoint: str, available_now: bool = False, bare: bool = False
):
    """Stream the payloads that do not parse into a text folder."""
    _, bad = parse_payloads(_payloads(lines, bare))
    return _write_text(bad, path, checkpoint, available_now)


def write_collected(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Stream the lines the collector forwards, unchanged, into a text folder."""
    return _write_text(collector_lines(lines), path, checkpoint, available_now)


def write_payloads(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Stream the cleaned payload lines into a text folder (the file form of a topic)."""
    return _write_text(rating_payloads(collector_lines(lines)), path, checkpoint, available_now)


def _write_text(lines, path, checkpoint, available_now):
    writer = (
        lines.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _trigger(writer, available_now).start()
