"""Online scorer: a stream of ratings refreshes the lists of the users who rated."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.constants import (
    RECENT_LIST_CAP,
    RECENT_RATINGS,
    SCORING_SIMILARITY_FLOOR,
    SIMILAR_CANDIDATES,
)
from merchlens.operators.rerank import rerank, rerank_lists
from merchlens.sources.tables import STREAM_BUCKETS, USER_BUCKETS, drop_partitions_up_to, ratings_of
from merchlens.streaming.log_events import _trigger
from merchlens.streaming.recents import recent_lists

#: Users of a batch whose products and candidates may be sent to all executors.
FEW_TRIGGERS = 50_000
STREAM_RECS = f"{schemas.USER_RECS}, batch_id BIGINT"
RATINGS_LOG = f"{schemas.RATING}, user_bucket INT"


def score_batch(
    batch: DataFrame,
    rated: DataFrame,
    sims: DataFrame,
    n_recent: int = RECENT_RATINGS,
    k: int = SIMILAR_CANDIDATES,
    min_sim: float = SCORING_SIMILARITY_FLOOR,
    levels: DataFrame | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Lists ``(user_id, recs)`` for one batch of ``recent_lists`` rows.

    A batch of up to ``FEW_TRIGGERS`` users moves only its own part of the table. With
    ``vectors`` the table needs no similars of candidates (``rerank``).
    """
    few = batch.count() <= FEW_TRIGGERS
    triggers = batch.select(F.col("user_id").alias("trigger_id"), "user_id", "product_id")
    recents = batch.select(
        F.col("user_id").alias("trigger_id"),
        F.explode(F.slice("recents", 1, n_recent)).alias("_r"),
    ).select("trigger_id", "_r.product_id", "_r.score")
    scored = rerank(triggers, recents, rated, sims, k, min_sim, levels, few, vectors)
    return rerank_lists(triggers, scored).select("user_id", "recs")


def start_scorer(
    spark: SparkSession,
    ratings_path: str,
    sims: Callable[[], DataFrame],
    recs_path: str,
    checkpoint: str,
    available_now: bool = False,
    buckets: int = STREAM_BUCKETS,
    history_buckets: int = USER_BUCKETS,
    max_files: int | None = None,
    cap: int = RECENT_LIST_CAP,
    history: Callable[[], DataFrame] | None = None,
    levels: Callable[[], DataFrame] | None = None,
    vectors: Callable[[], DataFrame] | None = None,
    **scoring,
):
    """Follow the ratings table and write the refreshed lists of every batch.

    The stream reads the table the ratings were stored in, so a rating is in the table
    before it is scored. ``sims`` and ``levels`` are called per batch and see refreshed
    similarity tables. ``history`` gives ratings stored before the stream began, with their
    ``user_bucket``. A batch writes its own folder and may be repeated without harm.
    """
    reader = spark.readStream.schema(RATINGS_LOG)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lists = recent_lists(reader.parquet(ratings_path), cap)

    def score_and_store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stored = spark.read.schema(RATINGS_LOG).parquet(ratings_path)
            rated = ratings_of(stored, batch, buckets).select("user_id", "product_id")
            if history:
                before = ratings_of(history(), batch, history_buckets).select("user_id", "product_id")
                rated = rated.unionByName(before)
            similars = sims()  # may turn to a newer version; levels() then follows
            bounds = levels() if levels else None
            products = vectors() if vectors else None
            recs = score_batch(batch, rated, similars, levels=bounds, vectors=products, **scoring)
            recs.write.mode("overwrite").parquet(f"{recs_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = (
        lists.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(score_and_store)
    )
    return _trigger(writer, available_now).start()


def current_recs(spark: SparkSession, *recs_paths: str) -> DataFrame:
    """The newest list of every user over one or more list tables."""
    tables = [spark.read.schema(STREAM_RECS).parquet(path) for path in recs_paths]
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows.groupBy("user_id").agg(F.max_by("recs", "batch_id").alias("recs"))


def compact_recs(spark: SparkSession, recs_path: str, target: str, up_to_batch: int) -> None:
    """Write the newest lists of the batches up to one as a single folder of ``target``.

    Readers then use ``target`` together with the later batches (``current_recs``).
    """
    older = spark.read.schema(STREAM_RECS).parquet(recs_path).where(F.col("batch_id") <= up_to_batch)
    newest = older.groupBy("user_id").agg(F.max_by("recs", "batch_id").alias("recs"))
    newest.write.mode("overwrite").parquet(f"{target}/batch_id={up_to_batch}")


def compact_stored(spark: SparkSession, recs_path: str, target: str) -> list[int]:
    """Fold all batches but the newest into ``target`` and remove them; the batches removed.

    The folded lists are in ``target`` before any folder goes, and a batch that is in
    both counts once, so readers see every list at any time.
    """
    rows = spark.read.schema(STREAM_RECS).parquet(recs_path)
    newest = rows.agg(F.max("batch_id")).first()[0]
    up_to = rows.where(F.col("batch_id") < newest).agg(F.max("batch_id")).first()[0] if newest else None
    if up_to is None:
        return []
    older = rows.where(F.col("batch_id") <= up_to)
    try:
        before = spark.read.schema(STREAM_RECS).parquet(target)
        last = before.agg(F.max("batch_id")).first()[0]
        older = older.unionByName(before)
    except AnalysisException:  # nothing folded yet
        last = None
    folded = older.groupBy("user_id").agg(F.max_by("recs", "batch_id").alias("recs"))
    folded.write.mode("overwrite").parquet(f"{target}/batch_id={up_to}")
    if last is not None and last < up_to:
        drop_partitions_up_to(spark, target, "batch_id", last)
    return drop_partitions_up_to(spark, recs_path, "batch_id", up_to)
