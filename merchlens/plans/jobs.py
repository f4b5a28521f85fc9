"""The engine's jobs over a folder of stored tables.

Run as ``python -m merchlens.plans.jobs JOB --store DIR …`` or call the functions.
"""

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens import constants, schemas
from merchlens.operators import factorization, gram, serving, similarity, statistics, users
from merchlens.session import build_session, read_stored, scratch_path
from merchlens.sources import files, tables, topics
from merchlens.sources.table_log import RatingsLog, TotalsLog
from merchlens.sources.tail import tail_lines
from merchlens.streaming import log_events, scorer
from merchlens.streaming.topic_folder import write_topic_folder

PRODUCTS = "products"
RATINGS = "ratings"
RATE_MORE = "rate_more_products"
RATE_MORE_RECENTLY = "rate_more_recently_products"
AVERAGE = "average_products"
MONTHLY = "monthly_totals"
USER_RECS = "user_recs"
SIMILARS = "product_similars"
LEVELS = "product_similar_levels"
GRID = "als_grid"
STREAM_RATINGS = "stream_ratings"
STREAM_RECS = "stream_recs"
USERS = "users"
LOG = "log"
COMPACTED_RECS = "stream_recs_compacted"
MODEL = "model"


def ratings_log(spark: SparkSession, store: str) -> RatingsLog:
    return RatingsLog(spark, f"{store}/{RATINGS}")


def totals_log(spark: SparkSession, store: str) -> TotalsLog:
    return TotalsLog(spark, f"{store}/{MONTHLY}")


def table(spark: SparkSession, store: str, name: str, columns: str | None = None) -> DataFrame:
    """A stored table; of the ratings the state at the time of the call."""
    if name == RATINGS:
        rows = ratings_log(spark, store).read()
        return rows.select(*_fields(spark, columns)) if columns else rows
    return tables.read_table(spark, f"{store}/{name}", columns)


def _fields(spark: SparkSession, columns: str) -> list[Column]:
    return [F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], columns).schema.fields]


def load(spark: SparkSession, product_file: str, rating_file: str, store: str) -> None:
    """Product and rating files into tables; rows that do not parse into ``bad_*``.

    Every rating is kept, also several of one user for one product.
    """
    products, bad_products = files.scan_product_file(spark, product_file)
    tables.save_sorted(products, f"{store}/{PRODUCTS}", "product_id", files=8)
    tables.overwrite(bad_products, f"{store}/bad_{PRODUCTS}")
    rows, bad_ratings = files.scan_rating_file(spark, rating_file)
    ratings_log(spark, store).overwrite(rows)
    tables.overwrite(bad_ratings, f"{store}/bad_{RATINGS}")


def product_data(spark: SparkSession, store: str, requests: DataFrame) -> DataFrame:
    """Stored data of the products that requests name by ``product_id``; each once."""
    return tables.lookup(table(spark, store, PRODUCTS, schemas.PRODUCT), requests, "product_id")


def compute_statistics(spark: SparkSession, store: str, scale: int = 1000) -> None:
    """The three statistics tables from one pass over the ratings; merges go on from there."""
    log = totals_log(spark, store)
    before = {r["key"]: None for r in log.state().collect()}
    rows = table(spark, store, RATINGS, schemas.RATING)
    log.add(statistics.monthly_totals(rows, scale), f"ratings-{log.last() + 1}")
    if before:
        log.commit(log.last() + 1, before, "replaced")
    refresh_statistics(spark, store)


def refresh_statistics(spark: SparkSession, store: str) -> None:
    """The three statistics tables from the monthly totals as they are now."""
    monthly = read_stored(totals_log(spark, store).totals(), "monthly")
    recently = monthly.select("product_id", "count", "yearmonth")
    tables.overwrite(recently, f"{store}/{RATE_MORE_RECENTLY}")
    totals = statistics.product_totals(monthly)
    tables.overwrite(totals.select("product_id", "count"), f"{store}/{RATE_MORE}")
    tables.overwrite(totals.select("product_id", "avg"), f"{store}/{AVERAGE}")


def train(
    spark: SparkSession,
    store: str,
    min_sim: float = constants.TABLE_SIMILARITY_FLOOR,
    top_n: int | None = None,
    summed: bool = False,
):
    """User lists and the product similarity table from a fitted model.

    All tables of a run are one version below ``model``, which scorers and readers switch
    to as a whole. ``top_n`` keeps so many similars of a product instead of all above the
    floor; ``summed`` fits by added-up normal equations, for products that very many rate.
    """
    rows = table(spark, store, RATINGS, "user_id INT, product_id INT, score DOUBLE")
    if summed:
        model = gram.fit_factors(rows)
        user_vectors, item_vectors = model
    else:
        model = factorization.fit_als(rows)
        user_vectors, item_vectors = factorization.user_vectors(model), factorization.item_vectors(model)
    sims = similarity.similar_products(item_vectors, min_sim, top_n)
    path = scratch_path(spark, SIMILARS)
    similarity.sorted_similars(sims).write.parquet(path)
    stored = tables.read_table(spark, path, schemas.SIMILARITY)
    named = {
        USER_RECS: factorization.lists_of(user_vectors, item_vectors),
        SIMILARS: similarity.sorted_similars(stored),
        LEVELS: similarity.similar_levels(stored),
    }
    tables.write_version(spark, f"{store}/{MODEL}", **named)
    return model


def model_table(spark: SparkSession, store: str, name: str, columns: str | None = None) -> DataFrame:
    """A table of the last training run that was written whole."""
    version = tables.current_version(spark, f"{store}/{MODEL}")
    return table(spark, store, f"{MODEL}/{version}/{name}", columns)


def tune(spark: SparkSession, store: str, **grid) -> DataFrame:
    """Test error over the parameter grid; returns the best row."""
    rows = table(spark, store, RATINGS, schemas.RATING)
    train_rows, test_rows = factorization.holdout_split(rows)
    results = factorization.tune_als(train_rows, test_rows, **grid)
    tables.overwrite(results, f"{store}/{GRID}")
    return factorization.best_parameters(table(spark, store, GRID, schemas.TUNING_GRID))


def stream(
    spark: SparkSession,
    store: str,
    log_folder: str | None = None,
    servers: str | None = None,
    available_now: bool = False,
    bare: bool = False,
    tail: bool = False,
):
    """Ingest and scoring streams over a folder of files or a topic.

    Lines are log lines, or with ``bare`` the payloads ``user|product|score|epoch`` of
    the rating topic. Files must be closed when they are moved in, but with ``tail`` they
    may grow, in a folder that all executors mount.
    """
    if log_folder and tail:
        lines = tail_lines(spark, log_folder).select("value")
    elif log_folder:
        lines = files.stream_lines(spark, log_folder)
    else:
        topic = constants.RATING_TOPIC if bare else constants.LOG_TOPIC
        lines = topics.read_topic(spark, servers, topic)
    ingest = log_events.write_ratings_log(
        lines, f"{store}/{STREAM_RATINGS}", f"{store}/_checkpoints/ratings", available_now, bare=bare
    )
    quarantine = log_events.write_quarantine(
        lines, f"{store}/bad_{STREAM_RATINGS}", f"{store}/_checkpoints/bad", available_now, bare=bare
    )
    if available_now:
        ingest.awaitTermination()
        quarantine.awaitTermination()
    model = tables.CachedVersion(
        spark, f"{store}/{MODEL}", "product_id", **{SIMILARS: schemas.SIMILARITY, LEVELS: ""}
    )

    def similars() -> DataFrame:
        model.fresh()
        return model.table(SIMILARS)

    scoring = scorer.start_scorer(
        spark,
        f"{store}/{STREAM_RATINGS}",
        similars,
        f"{store}/{STREAM_RECS}",
        f"{store}/_checkpoints/recs",
        available_now=available_now,
        history=lambda: table(spark, store, RATINGS),
        levels=lambda: model.table(LEVELS),
    )
    return ingest, quarantine, scoring


def merge_stream_ratings(spark: SparkSession, store: str) -> int:
    """Bring the streamed ratings into the ratings table and the totals; how many batches.

    The streamed files are followed by a stream of their own, so each is taken once and a
    second merge reads nothing. Readers of the ratings, a running scorer among them, see
    the state before or after a batch. Totals exist once ``statistics`` has run.
    """
    log, totals = ratings_log(spark, store), totals_log(spark, store)
    counted = totals.last() > 0
    merged = []

    def fold(batch: DataFrame, batch_id: int) -> None:
        source = f"stream-{batch_id}"
        changed = log.merge(batch, source)
        if changed is not None:
            merged.append(batch_id)
            if counted:
                totals.add(statistics.monthly_changes(*changed), source)

    streamed = spark.readStream.schema(scorer.RATINGS_LOG).parquet(f"{store}/{STREAM_RATINGS}")
    writer = streamed.writeStream.option("checkpointLocation", f"{store}/_checkpoints/merge")
    writer.foreachBatch(fold).trigger(availableNow=True).start().awaitTermination()
    if merged and counted:
        refresh_statistics(spark, store)
    log.drop_retired()
    return len(merged)


def compact(spark: SparkSession, store: str) -> list[int]:
    """Fold the scored batches written so far into one folder; returns those removed.

    The newest batch may be under way, so it stays. Readers take
    ``scorer.current_recs(spark, f"{store}/stream_recs", f"{store}/stream_recs_compacted")``.
    """
    path, target = f"{store}/{STREAM_RECS}", f"{store}/{COMPACTED_RECS}"
    return scorer.compact_stored(spark, path, target)


def forward(
    spark: SparkSession,
    store: str,
    log_folder: str,
    servers: str | None = None,
    topic_folder: str | None = None,
    available_now: bool = False,
):
    """Payloads of growing log files into a topic folder, or onto the rating topic of a
    message broker (whose connector is not tested here)."""
    if topic_folder:
        payloads = log_events.keyed_payloads(tail_lines(spark, log_folder))
        checkpoint = f"{store}/_checkpoints/forward-folder"
        return write_topic_folder(payloads, topic_folder, checkpoint, available_now)
    lines = log_events.rating_payloads(
        log_events.collector_lines(files.stream_lines(spark, log_folder))
    )
    return topics.write_topic(
        lines, servers, constants.RATING_TOPIC, f"{store}/_checkpoints/forward"
    )


def _stored_users(spark: SparkSession, store: str) -> DataFrame:
    try:
        return table(spark, store, USERS, schemas.USER)
    except AnalysisException:  # nobody has signed up yet
        return spark.createDataFrame([], schemas.USER)


def signup(spark: SparkSession, store: str, requests: DataFrame) -> DataFrame:
    """Register the free names of ``username, requested_at``; returns the refused ones."""
    known = _stored_users(spark, store)
    refused = tables.read_stored(users.taken_names(known, requests), "refused")
    new = tables.read_stored(users.register_users(known, requests), "signups")
    new.write.mode("append").parquet(f"{store}/{USERS}")
    return refused


def rate(spark: SparkSession, store: str, requests: DataFrame, now: int | None = None) -> DataFrame:
    """Ratings by name: event lines into the log folder; returns those of unknown users.

    The stream over ``log`` brings them into the tables.
    """
    none = spark.createDataFrame([], schemas.RATING)
    _, _, lines, unknown = serving.record_ratings(requests, _stored_users(spark, store), none, now)
    marked = lines.select(F.concat(F.lit("rating "), "value").alias("value"))
    files.write_lines(marked, f"{store}/{LOG}")
    return unknown


def serve(spark: SparkSession, store: str, requests: DataFrame, num: int = 10) -> DataFrame:
    """Recommended products with their data for requests by ``username``.

    Streamed lists come first; users without one get the list of the last training.
    """
    served = serving.served_products(
        table(spark, store, PRODUCTS, schemas.PRODUCT), table(spark, store, AVERAGE)
    )
    trained = model_table(spark, store, USER_RECS, schemas.USER_RECS)
    fresh = trained.limit(0)
    for paths in ((COMPACTED_RECS, STREAM_RECS), (STREAM_RECS,)):
        try:
            fresh = scorer.current_recs(spark, *[f"{store}/{path}" for path in paths])
            break
        except AnalysisException:  # nothing folded, or no batch scored yet
            continue
    fresh = fresh.where(F.size("recs") > 0)
    recs = fresh.unionByName(trained.join(fresh.select("user_id"), "user_id", "left_anti"))
    named = users.with_user_id(requests, _stored_users(spark, store), outer=True)
    return serving.serve_recs(named, recs, served, "user_id", num)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["load", "statistics", "train", "tune", "stream", "merge", "compact", "signup", "rate", "serve", "forward"])
    parser.add_argument("--store", required=True)
    parser.add_argument("--products")
    parser.add_argument("--ratings")
    parser.add_argument("--log-folder")
    parser.add_argument("--servers")
    parser.add_argument("--bare", action="store_true", help="the stream's lines are payloads")
    parser.add_argument("--tail", action="store_true", help="files of the log folder grow")
    parser.add_argument("--topic-folder", help="folder that stands in for the rating topic")
    parser.add_argument("--requests", help="parquet table of requests")
    parser.add_argument("--out", help="folder for the answers")
    parser.add_argument("--master")
    args = parser.parse_args()
    spark = build_session(f"merchlens-{args.job}", args.master)
    if args.job == "load":
        load(spark, args.products, args.ratings, args.store)
    elif args.job == "statistics":
        compute_statistics(spark, args.store)
    elif args.job == "train":
        train(spark, args.store)
    elif args.job == "tune":
        tune(spark, args.store).show()
    elif args.job == "merge":
        merge_stream_ratings(spark, args.store)
    elif args.job == "compact":
        compact(spark, args.store)
    elif args.job in ("signup", "rate", "serve"):
        answer = {"signup": signup, "rate": rate, "serve": serve}[args.job]
        answer(spark, args.store, spark.read.parquet(args.requests)).write.parquet(args.out)
    elif args.job == "forward":
        forward(spark, args.store, args.log_folder, args.servers, args.topic_folder).awaitTermination()
    else:
        started = stream(spark, args.store, args.log_folder, args.servers, bare=args.bare, tail=args.tail)
        for query in started:
            query.awaitTermination()


if __name__ == "__main__":
    main()
