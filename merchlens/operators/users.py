"""User dimension: sign-up batches, preference updates, lookup by name."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.expr import name_hash


def register_users(users: DataFrame, requests: DataFrame) -> DataFrame:
    """New user rows for the requested names that are not taken.

    ``requests`` has ``username`` and ``requested_at`` (epoch seconds, may be null). A
    name asked for several times is registered once, with its earliest request.
    """
    first_asked = requests.groupBy("username").agg(F.min("requested_at").alias("requested_at"))
    free = first_asked.join(users.select("username"), "username", "left_anti")
    return free.select(
        name_hash(F.col("username")).alias("user_id"),
        "username",
        F.lit(True).alias("first"),
        F.coalesce(F.timestamp_seconds("requested_at"), F.current_timestamp()).alias("created_at"),
        F.array().cast("array<string>").alias("pref_genres"),
    )


def taken_names(users: DataFrame, requests: DataFrame) -> DataFrame:
    """Requested names refused because a user has them already."""
    return requests.select("username").distinct().join(
        users.select("username"), "username", "left_semi"
    )


def id_collisions(users: DataFrame) -> DataFrame:
    """Rows of different names that share one id."""
    shared = (
        users.groupBy("user_id")
        .agg(F.min("username").alias("_low"), F.max("username").alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select("user_id")
    )
    return users.select("user_id", "username").join(shared, "user_id", "left_semi").distinct()


def update_preferences(users: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply ``first`` and ``pref_genres`` from the newest update of each user.

    ``updates`` has ``user_id, first, pref_genres, updated_at``; a null field leaves the
    stored value.
    """
    newest = updates.groupBy("user_id").agg(
        F.max(F.struct("updated_at", "first", "pref_genres")).alias("_new")
    )
    others = [c for c in users.columns if c not in ("user_id", "first", "pref_genres")]
    return users.join(newest, "user_id", "left").select(
        "user_id",
        *others,
        F.coalesce("_new.first", "first").alias("first"),
        F.coalesce("_new.pref_genres", "pref_genres").alias("pref_genres"),
    )


def with_user_id(requests: DataFrame, users: DataFrame, outer: bool = False) -> DataFrame:
    """Requests by name with the user's id; unknown names only where ``outer``."""
    ids = users.select("username", "user_id")
    return requests.join(ids, "username", "left" if outer else "inner")
