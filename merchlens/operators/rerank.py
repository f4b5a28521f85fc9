"""Re-ranking of the products similar to a rated product by a user's newest ratings.

Tables:
  triggers  (trigger_id, user_id, product_id)      a rating to react to
  recents   (trigger_id, product_id, score)        the user's newest ratings, bounded
  rated     (user_id, product_id)                  everything the user has rated
  sims      (product_id, sim_product_id, sim)
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.constants import LIKE_THRESHOLD, SCORING_SIMILARITY_FLOOR, SIMILAR_CANDIDATES
from merchlens.functions.expr import log10_count
from merchlens.functions.ranking import pack_recs, top_per_key
from merchlens.operators.similarity import similarity_level, similars_of_pairs
from merchlens.session import read_stored


def unrated_similars(
    triggers: DataFrame,
    rated: DataFrame,
    sims: DataFrame,
    k: int = SIMILAR_CANDIDATES,
    levels: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` most similar products the user has not rated, per trigger.

    With ``levels`` (``similarity.similar_levels`` of the same table) a trigger meets
    only similars that can still be among its ``k``, which keeps the join small for
    products with very many similars.
    """
    # Repeated ratings collapse in the map tasks; the anti join cannot split a hot pair.
    rated = rated.select("user_id", "product_id").distinct()
    if levels is None:
        similar = triggers.join(sims, "product_id")
    else:
        wanted = _wanted_levels(triggers, rated, levels, k)
        similar = wanted.join(
            sims.withColumn("_level", similarity_level(F.col("sim"))), ["product_id", "_level"]
        )
    similar = similar.select(
        "trigger_id", "user_id", F.col("sim_product_id").alias("candidate"), "sim"
    )
    known = rated.select("user_id", F.col("product_id").alias("candidate"))
    fresh = similar.join(known, ["user_id", "candidate"], "left_anti")
    return top_per_key(fresh, ("trigger_id",), (F.desc("sim"), "candidate"), k).select(
        "trigger_id", "user_id", "candidate", "sim"
    )


def wanted_depths(triggers: DataFrame, rated: DataFrame, k: int = SIMILAR_CANDIDATES) -> DataFrame:
    """``product_id, depth``: how many similars of a trigger's product any of its users may need.

    As many as ``k`` and the products that the user has rated; ``similarity.similars_of``
    finds them without the table of all pairs.
    """
    rated_counts = (
        rated.select("user_id", "product_id").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("_r"))
    )
    needed = F.coalesce("_r", F.lit(0)) + k
    asked = triggers.select("user_id", "product_id").join(rated_counts, "user_id", "left")
    return asked.where("product_id IS NOT NULL").groupBy("product_id").agg(F.max(needed).alias("depth"))


def _wanted_levels(triggers, rated, levels, k):
    """Triggers once per similarity level that may hold one of their ``k`` products.

    A user with ``r`` rated products has at most ``r`` rated similars, so the first ``k + r``
    similars hold the wanted ones. Levels below the one that completes them stay out.
    """
    users = triggers.select("user_id").distinct()
    rated_counts = (
        rated.join(users, "user_id", "left_semi")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_r"))
    )
    needed = F.coalesce("_r", F.lit(0)) + k
    wanted = F.filter("levels", lambda x: x["at_least"] - x["n"] < needed)
    return (
        triggers.join(rated_counts, "user_id", "left")
        .join(levels, "product_id")
        .select(
            "trigger_id",
            "user_id",
            "product_id",
            F.explode(F.transform(wanted, lambda x: x["level"])).alias("_level"),
        )
    )


def score_candidates(
    candidates: DataFrame,
    recents: DataFrame,
    sims: DataFrame,
    min_sim: float = SCORING_SIMILARITY_FLOOR,
    like_above: float = LIKE_THRESHOLD,
) -> DataFrame:
    """Score of every candidate with at least one recent rating similar enough.

    Mean of similarity times rating, plus log10 of the number of liked and minus log10
    of the number of disliked recent products among them.
    """
    recent = recents.select(
        "trigger_id", F.col("product_id").alias("recent"), F.col("score").alias("_rating")
    )
    close = sims.where(F.col("sim") > min_sim).select(
        F.col("product_id").alias("candidate"),
        F.col("sim_product_id").alias("recent"),
        F.col("sim").alias("_sim"),
    )
    liked = F.count_if(F.col("_rating") > like_above)
    disliked = F.count_if(F.col("_rating") <= like_above)
    return (
        candidates.select("trigger_id", "user_id", "candidate")
        .join(recent, "trigger_id")
        .join(close, ["candidate", "recent"])
        .groupBy("trigger_id", "user_id", "candidate")
        .agg(
            (
                F.avg(F.col("_sim") * F.col("_rating"))
                + log10_count(liked)
                - log10_count(disliked)
            ).alias("score")
        )
        .withColumnRenamed("candidate", "product_id")
    )


def of_products(sims: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """The similars of a few products; the few are sent to the table, which stays put."""
    few = products.select(F.col(key).alias("product_id")).distinct()
    return sims.join(F.broadcast(few), "product_id", "left_semi")


def rerank(
    triggers: DataFrame,
    recents: DataFrame,
    rated: DataFrame,
    sims: DataFrame,
    k: int = SIMILAR_CANDIDATES,
    min_sim: float = SCORING_SIMILARITY_FLOOR,
    levels: DataFrame | None = None,
    few: bool = False,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Scored candidates ``(trigger_id, user_id, product_id, score)``.

    With ``few`` triggers (the caller has counted them) the similarity table is first cut
    to the triggers' products, and for the scores to the candidates, without a shuffle of
    the table. With ``vectors`` (``product_id, features``) the similarity of a candidate and a
    recent product is taken from their vectors, and ``sims`` may be no more than what
    ``similarity.similars_of`` gives for ``wanted_depths``.
    """
    near = of_products(sims, triggers) if few else sims
    candidates = unrated_similars(triggers, rated, near, k, levels)
    if vectors is not None:
        candidates = read_stored(candidates, "candidates")
        recent = recents.select("trigger_id", F.col("product_id").alias("sim_product_id"))
        pairs = candidates.select("trigger_id", F.col("candidate").alias("product_id")).join(recent, "trigger_id")
        pairs = pairs.select("product_id", "sim_product_id").distinct()
        return score_candidates(candidates, recents, similars_of_pairs(pairs, vectors, min_sim), min_sim)
    close = of_products(sims, candidates, "candidate") if few else sims
    return score_candidates(candidates, recents, close, min_sim)


def rerank_lists(triggers: DataFrame, scored: DataFrame) -> DataFrame:
    """One list per trigger, empty where no candidate was scored."""
    packed = pack_recs(scored, "trigger_id")
    empty = F.array().cast("array<struct<product_id: int, score: double>>")
    return triggers.join(packed, "trigger_id", "left").select(
        "trigger_id", "user_id", F.coalesce("recs", empty).alias("recs")
    )


def latest_triggers(events: DataFrame) -> DataFrame:
    """The newest event of every user, as its trigger."""
    newest = (F.desc("ts"), F.desc("product_id"))
    return top_per_key(events.select("user_id", "product_id", "ts"), ("user_id",), newest, 1).select(
        F.col("user_id").alias("trigger_id"), "user_id", "product_id"
    )
