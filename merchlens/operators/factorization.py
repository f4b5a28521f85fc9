"""Explicit-feedback ALS: fit, predictions, recommendation lists, error and tuning."""

import math
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens import constants, schemas
from merchlens.functions.best_hits import BestHits, cells
from merchlens.functions.expr import computed_once, dot, norm
from merchlens.functions.ranking import pack_recs, top_per_key
from merchlens.operators import gram
from merchlens.operators.similarity import of_one_size
from merchlens.session import read_stored, shared_dir

USER_BLOCK = 65_536
ITEM_BLOCK = 65_536
#: Users and products in a slice of predictions.
USER_SLICE, ITEM_SLICE = 1024, 4096
#: Ratings that a block of the fit should hold.
FIT_BLOCK = 32_000_000
#: Rank from which on a fit is cut into as many blocks as there are cores.
BUSY_RANK = 50


class Model(NamedTuple):
    """What a fit gives: ``id, features`` of users and of products."""

    userFactors: DataFrame
    itemFactors: DataFrame


class Fitted(Model):
    """A model with the factors that it is made of."""

    factors: gram.Factors


def fit_als(
    ratings: DataFrame,
    rank: int = constants.ALS_RANK,
    iterations: int = constants.ALS_ITERATIONS,
    reg_param: float = constants.ALS_REGULARISATION,
    seed: int = 0,
    blocks: int | None = None,
) -> Model:
    """Fit on ``(user_id, product_id, score)``.

    The fit starts where Spark ML's ``ALS`` with so many blocks does and takes the same steps,
    by ``gram.fit_factors``: there a vector is written once per round, not sent to every block.
    Blocks follow the number of ratings and are at least the cluster's cores; fewer for a
    rank below ``BUSY_RANK``. As with ``ALS``, ids are integers, and neither they nor scores may
    be null, scores neither NaN nor infinite.
    """
    rows = _checked(ratings)
    blocks = blocks or _fit_blocks(rows, rank)
    if iterations == 0:
        model = _spark_fit(rows, rank, reg_param, seed, blocks)
        return Model(model.userFactors, model.itemFactors)
    start = user_vectors(_spark_fit(_one_each(rows), rank, reg_param, seed, blocks))
    found = _alternated(_turned(rows), rank, iterations, reg_param, start)
    model = Fitted(*(side.withColumnRenamed(side.columns[0], "id") for side in found))
    model.factors = found
    return model


def _checked(ratings: DataFrame) -> DataFrame:
    """The stored rows of a fit; it ends with an error if there are any that it may not have."""
    shared_dir(ratings.sparkSession)  # the fit cuts its lineage there
    return read_stored(ratings.select(_id("user_id"), _id("product_id"), _score()), "fit")


def _fit_blocks(rows: DataFrame, rank: int) -> int:
    busy = math.ceil(rows.sparkSession.sparkContext.defaultParallelism * min(1, rank / BUSY_RANK))
    return max(2, busy, -(-rows.count() // FIT_BLOCK))


def _spark_fit(rows: DataFrame, rank: int, reg_param: float, seed: int, blocks: int):
    """Spark ML's model without a step."""
    als = ALS(
        rank=rank,
        maxIter=0,
        regParam=reg_param,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user_id",
        itemCol="product_id",
        ratingCol="score",
        seed=seed,
    )
    return als.fit(rows)


def _one_each(rows: DataFrame) -> DataFrame:
    """One rating of each user: a user's start depends on nothing but the users."""
    users = rows.select("user_id").distinct()
    return users.select("user_id", F.col("user_id").alias("product_id"), F.lit(0.0).cast("float").alias("score"))


def _id(name: str) -> Column:
    whole = F.col(name).cast("int")
    text = f"{name}: ids must be integers and not null, but one is "
    bad = F.raise_error(F.concat(F.lit(text), F.coalesce(F.col(name).cast("string"), F.lit("null"))))
    return F.when(whole == F.col(name), whole).otherwise(bad).alias(name)


def _score() -> Column:
    good = F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < float("inf"))
    bad = F.raise_error(F.lit("scores must not be null, NaN or infinite"))
    return F.when(good, F.col("score").cast("float")).otherwise(bad).alias("score")


def _turned(rows: DataFrame) -> DataFrame:
    """Users for products and back, as Spark's fit solves the products first."""
    return rows.select(
        F.col("product_id").alias("user_id"), F.col("user_id").alias("product_id"), F.col("score").cast("float")
    )


def _alternated(turned, rank: int, iterations: int, reg_params, begin: DataFrame) -> gram.Fitted:
    """``gram.fit_factors`` of ``_turned`` ratings from the users' vectors."""
    start = begin.withColumnRenamed("user_id", "product_id")
    found = gram.fit_factors(turned, rank, iterations, reg_params, start=start)
    return gram.with_chunks(
        found.items.withColumnRenamed("product_id", "user_id"), found.users.withColumnRenamed("user_id", "product_id"),
        found.stored_chunks()[::-1],
    )


def predict(model: Model, pairs: DataFrame) -> DataFrame:
    """Pairs with ``prediction``; pairs of unknown users or products drop out."""
    size = model.userFactors.select(F.size("features").alias("n")).first()
    checked = pairs.withColumns({c: _id(c) for c in ("user_id", "product_id")})
    factors = model.factors if isinstance(model, Fitted) else gram.Factors(*model)
    return gram.predicted(checked, factors, size["n"] if size else 1)


def user_recs(model: Model, k: int = constants.USER_RECS_LENGTH) -> DataFrame:
    """Per user the best ``k`` products with a positive prediction; rated ones included."""
    return lists_of(user_vectors(model), item_vectors(model), k)


def lists_of(users: DataFrame, items: DataFrame, k: int = constants.USER_RECS_LENGTH) -> DataFrame:
    """Recommendation lists from ``user_id, features`` and ``product_id, features``."""
    return recs_from_predictions(best_products(users.withColumn("depth", F.lit(k)), items), k)


def unrated_user_recs(
    model: Model, ratings: DataFrame, k: int = constants.USER_RECS_LENGTH
) -> DataFrame:
    """Like ``user_recs`` without the products the user has rated.

    A user who rated ``r`` products of a block finds its ``k`` best unrated ones among
    the best ``k + r`` of the block, so what leaves the blocks is at most ``k`` rows per
    user and block, and the ratings.
    """
    return unrated_recs(user_vectors(model), item_vectors(model), ratings, k)


def unrated_recs(
    users: DataFrame, items: DataFrame, ratings: DataFrame, k: int = constants.USER_RECS_LENGTH
) -> DataFrame:
    """Lists of unrated products from ``user_id, features`` and ``product_id, features``."""
    rated = ratings.select("user_id", "product_id").distinct()
    best = best_products(users.withColumn("depth", F.lit(k)), items, rated)
    return recs_from_predictions(best.join(rated, ["user_id", "product_id"], "left_anti"), k)


def predicted_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``user_id, product_id, prediction``: the dot products of the pairs' vectors."""
    left = users.select("user_id", F.col("features").alias("_u"))
    right = items.select("product_id", F.col("features").alias("_p"))
    both = pairs.join(left, "user_id").join(right, "product_id")
    return both.select("user_id", "product_id", dot(F.col("_u"), F.col("_p")).alias("prediction"))


def best_products(
    users: DataFrame, items: DataFrame, rated: DataFrame | None = None, item_block: int = ITEM_BLOCK
) -> DataFrame:
    """Positive predictions ``(user_id, product_id, score)`` that can be a user's best.

    ``users`` has ``user_id, features, depth``. Products are cut into blocks of falling
    vector length. Every user meets the first block, one matrix product per block of
    users, and keeps the ``depth`` best. A prediction is at most the product of the two
    lengths, so a user then meets only those further blocks whose longest vector can still
    reach the least of the kept ones; users that reach equally far share blocks.
    With ``rated`` (distinct ``user_id, product_id``) a user's depth grows in each block
    by the rated products of that block. Vectors of another size than most products' have
    no predictions.
    """
    spark = users.sparkSession
    items = of_one_size(items)
    n_items, n_users = items.count(), users.count()
    size = items.select(F.size("features").alias("n")).first()
    users = users.where(F.size("features") == (size["n"] if size else 0))
    cores = spark.sparkContext.defaultParallelism
    user_blocks = max(1, math.ceil(n_users / USER_BLOCK), min(2 * cores, n_users // 512))
    if n_items <= item_block:
        items = items.withColumn("item_block", F.lit(0))
        return _first_block(users, items, rated, user_blocks, cores)
    items, longest = norm_blocks(items, n_items, item_block)
    if rated is not None:
        rated = rated.join(items.select("product_id", "item_block"), "product_id")
        rated = rated.groupBy("user_id", "item_block").agg(F.count("*").alias("_r"))
        rated = read_stored(rated, "rated-blocks")
    first = _first_block(users, items, rated, user_blocks, cores)
    first = read_stored(first, "first-block")
    # Lost vectors (null, NaN) reach nothing and are kept out of the first block's answer too.
    reached = reach(users, first, rated, longest)
    # Blocks travel in wide ones: users are sent once per wide block that they reach into.
    per_wide = max(1, ITEM_BLOCK // item_block)
    wides = math.ceil((len(longest) - 1) / per_wide)

    def wide(block):
        return F.ceil(block / F.lit(per_wide)).cast("int")

    items = items.withColumn("item_block", wide(F.col("item_block")))
    if rated is not None and per_wide > 1:
        rated = rated.groupBy("user_id", wide(F.col("item_block")).alias("item_block")).agg(F.sum("_r").alias("_r"))
    far = read_stored(reached.where("reach > 0").withColumn("reach", wide(F.col("reach"))), "reach")
    classes = {r["reach"]: r["n"] for r in far.groupBy("reach").agg(F.count("*").alias("n")).collect()}
    if not classes:
        return first
    per_class = [max(1, math.ceil(classes.get(r, 0) / USER_BLOCK)) for r in range(wides + 1)]
    if wides * sum(per_class) < 2 * cores:  # too few tasks for all cores
        more = math.ceil(2 * cores / wides)
        per_class = [max(n, min(more, classes.get(r, 0) // 512)) for r, n in enumerate(per_class)]
    salt = F.pmod(F.xxhash64("user_id"), F.get(F.lit(per_class), F.col("reach"))).cast("int")
    left = far.select(
        "reach", salt.alias("salt"), F.explode(F.sequence(F.lit(1), "reach")).alias("item_block"),
        "user_id", "features", "depth", "floor",
    )
    left = _deeper(left, rated)
    used = spark.createDataFrame(
        [(r, per_class[r]) for r in sorted(classes)], "reach int, salts int"
    ).select("reach", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    used = used.select("reach", "salt", F.explode(F.sequence(F.lit(1), "reach")).alias("item_block"))
    right = items.join(used, "item_block").select("reach", "salt", "item_block", "product_id", "features")
    pairs = sum(r * per_class[r] for r in classes)
    keys = ("reach", "salt", "item_block")
    return first.union(_best_pairs(left, right, keys, min(pairs, 8 * cores)))


def norm_blocks(items: DataFrame, n: int, item_block: int) -> tuple[DataFrame, list[float]]:
    """Stored ``product_id, features, item_block`` in blocks of falling vector length, and
    the greatest length in each block. Null, NaN and infinite vectors are left out."""
    measured = items.select("product_id", "features", norm(F.col("features")).alias("_norm"))
    measured = measured.where(F.col("_norm") < float("inf"))
    ranged = measured.repartitionByRange(math.ceil(n / item_block), F.desc("_norm"), "product_id")
    blocks = read_stored(ranged.withColumn("item_block", F.spark_partition_id()), "norm-blocks")
    tops = blocks.groupBy("item_block").agg(F.max("_norm").alias("top")).collect()
    longest = [0.0] * math.ceil(n / item_block)
    for r in tops:
        longest[r["item_block"]] = r["top"]
    for j in range(len(longest) - 2, -1, -1):  # an empty block bounds nothing
        longest[j] = max(longest[j], longest[j + 1])
    return blocks.drop("_norm"), longest


def reach(users: DataFrame, first: DataFrame, rated: DataFrame | None, longest: list[float]) -> DataFrame:
    """``users`` with ``floor``, the score that a further product must reach, and ``reach``,
    the number of blocks after the first one that may hold such a product."""
    found = first.groupBy("user_id").agg(F.count("*").alias("_n"), F.min("score").alias("_least"))
    known = users.join(found, "user_id", "left")
    depth = F.col("depth")
    if rated is not None:
        own = rated.where("item_block = 0").select("user_id", "_r")
        known = known.join(own, "user_id", "left")
        depth = depth + F.coalesce("_r", F.lit(0))
    floor = F.when(F.col("_n") >= depth, F.col("_least")).otherwise(F.lit(0.0))
    known = known.select("user_id", "features", "depth", floor.alias("floor"))
    known = computed_once(known, _norm=norm(F.col("features")))  # not anew for every block
    # Predictions are sums of floats: the bound is widened by more than their rounding.
    bounds = F.transform(F.lit([1.0001 * x for x in longest[1:]]), lambda x: x * F.col("_norm"))
    may = F.filter(bounds, lambda x: (x > 0) & (x >= F.col("floor")))
    return computed_once(known, reach=F.size(may)).select("user_id", "features", "depth", "floor", "reach")


def _first_block(users, items, rated, user_blocks, cores) -> DataFrame:
    """The best of the first block of products for every user."""
    block = F.pmod(F.xxhash64("user_id"), F.lit(user_blocks)).cast("int").alias("user_block")
    left = users.select(
        block, F.lit(0).alias("item_block"), "user_id", "features", "depth", F.lit(0.0).alias("floor")
    )
    if rated is not None and "item_block" not in rated.columns:
        rated = rated.groupBy("user_id").agg(F.count("*").alias("_r")).withColumn("item_block", F.lit(0))
    left = _deeper(left, rated)
    right = items.where("item_block = 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))).alias("user_block"),
        "item_block",
        "product_id",
        F.col("features").alias("features"),  # both sides may stem from one table
    )
    return _best_pairs(left, right, ("user_block", "item_block"), min(user_blocks, 8 * cores))


def _deeper(left: DataFrame, rated: DataFrame | None) -> DataFrame:
    """A user's depth in a block, more by the products of the block that the user rated."""
    if rated is None:
        return left
    deep = F.col("depth") + F.coalesce("_r", F.lit(0))
    return left.join(rated, ["user_id", "item_block"], "left").withColumn("depth", deep.cast("int")).drop("_r")


def _best_pairs(left: DataFrame, right: DataFrame, keys: tuple[str, ...], partitions: int) -> DataFrame:
    left, right = left.repartition(partitions, *keys), right.repartition(partitions, *keys)
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_best_of_blocks, "user_id int, product_id int, score double")
    )


def _best_of_blocks(users: pa.Table, items: pa.Table) -> pa.Table:
    """Per user the ``depth`` best positive products at or above ``floor``, and what ties.

    Products are met in slices of falling vector length; a user leaves once the next
    slice's longest vector cannot reach the least of what it keeps. Of a slice only the
    users are looked at whose greatest prediction in it reaches that.
    """
    user_ids, product_ids, scores = [], [], []
    if users.num_rows and items.num_rows:
        ids, depth, floor = (users[c].to_numpy() for c in ("user_id", "depth", "floor"))
        products, vectors, item_rows = items["product_id"].to_numpy(), _matrix(users), _matrix(items)
        lengths = _lengths(item_rows)
        order = np.argsort(-lengths, kind="stable")  # vectors without a length, NaN, come last
        order = order[: np.count_nonzero(~np.isnan(lengths))]
        products, item_rows, lengths = products[order], item_rows[order], lengths[order]
        reach = 1.0001 * _lengths(vectors)
        kind = np.result_type(vectors, item_rows)
        space = np.empty(min(USER_SLICE, len(ids)) * min(ITEM_SLICE, len(products)), kind)  # one for all slices
        for start in range(0, len(ids), USER_SLICE):
            part = slice(start, start + USER_SLICE)
            best = BestHits(floor[part].astype(np.float64), depth[part])
            own, far = vectors[part], reach[part]
            alive = np.arange(len(own))
            for first in range(0, len(products), ITEM_SLICE):
                with np.errstate(invalid="ignore"):
                    bound = far[alive] * lengths[first]
                alive = alive[(bound > 0) & (bound >= best.floor[alive])]
                if not len(alive):
                    break
                others = item_rows[first : first + ITEM_SLICE]
                sims = space[: len(alive) * len(others)].reshape(len(alive), len(others))
                with np.errstate(invalid="ignore"):
                    np.matmul(own[alive], others.T, out=sims)
                lowest = _at_least(best.floor[alive], kind)
                new = np.flatnonzero(best.floor[alive] <= 0) if first == 0 else ()
                if len(new):  # users who know no floor yet
                    last = np.maximum(sims.shape[1] - depth[part][alive[new]], 0)
                    rising = np.partition(sims[new], np.unique(last), axis=1)[np.arange(len(last)), last]
                    lowest[new] = np.fmax(lowest[new], rising)
                some = np.flatnonzero(~(sims.max(axis=1) < lowest))  # with NaN too, which hides the greatest
                if len(some) < len(alive):
                    sims, lowest = sims[some], lowest[some]
                a, b = cells(sims >= lowest[:, None])
                best.add(alive[some[a]], b + first, sims[a, b].astype(np.float64))
            own, theirs, values = best.cut()
            user_ids.append(ids[part][own])
            product_ids.append(products[theirs])
            scores.append(values)

    def column(parts, kind):
        return pa.array(np.concatenate(parts) if parts else [], kind)

    return pa.table(
        {
            "user_id": column(user_ids, pa.int32()),
            "product_id": column(product_ids, pa.int32()),
            "score": column(scores, pa.float64()),
        }
    )


def _lengths(rows: np.ndarray) -> np.ndarray:
    """Vector lengths, of very long and very short ones too."""
    top = np.abs(rows).max(axis=1, initial=0.0).astype(np.float64)
    scale = np.where((top > 0) & (top < np.inf), top, 1.0)
    return scale * np.linalg.norm(rows / scale[:, None], axis=1)


def _at_least(floor: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Floors as numbers of the scores' kind, none above what was asked and all positive."""
    lowest = floor.astype(kind)
    lowest = np.where(lowest > floor, np.nextafter(lowest, kind.type(-np.inf)), lowest)
    return np.maximum(lowest, np.finfo(kind).smallest_subnormal)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["features"].combine_chunks().flatten().to_numpy()
    return flat.reshape(table.num_rows, -1)


def recs_from_predictions(predictions: DataFrame, k: int = constants.USER_RECS_LENGTH) -> DataFrame:
    """Recommendation lists from prediction rows ``(user_id, product_id, score)``."""
    positive = predictions.where((F.col("score") > 0) & ~F.isnan("score"))
    return pack_recs(
        top_per_key(positive, ("user_id",), (F.desc("score"), "product_id"), k), "user_id"
    )


def user_vectors(model: Model) -> DataFrame:
    return model.userFactors.select(F.col("id").alias("user_id"), "features")


def item_vectors(model: Model) -> DataFrame:
    return model.itemFactors.select(F.col("id").alias("product_id"), "features")


def rmse(pairs: DataFrame, actual: str = "score", predicted: str = "prediction") -> DataFrame:
    """One row: root of the mean squared difference."""
    error = F.col(actual) - F.col(predicted)
    return pairs.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def holdout_split(
    ratings: DataFrame, train: float = constants.TRAIN_FRACTION, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the rating, so every rerun splits alike."""
    prime = F.lit(2_147_483_647).cast("bigint")
    mixed = F.col("user_id").cast("bigint") * 1_000_003 + F.col("product_id")
    mixed = F.pmod(mixed, prime) * 48_271 + F.pmod(F.col("ts") + seed, prime)
    bucket = F.pmod(F.pmod(mixed, prime) * 69_621, prime) % 10_000
    in_train = bucket < round(train * 10_000)
    return ratings.where(in_train), ratings.where(~in_train)


def random_split(ratings: DataFrame, train: float = constants.TRAIN_FRACTION, seed: int = 0):
    return ratings.randomSplit([train, 1 - train], seed)


def tune_als(
    train: DataFrame,
    test: DataFrame,
    ranks=constants.GRID_RANKS,
    reg_params=constants.GRID_REGULARISATIONS,
    iterations: int = constants.ALS_ITERATIONS,
    parallelism: int = 2,
    seed: int = 0,
) -> DataFrame:
    """Test error of every rank and regularisation, as a table.

    Ranks above the mean number of ratings of a user or product are fitted by
    ``gram.fit_factors``, from the start that ``fit_als`` takes: there an id with few ratings
    needs no equations as wide as the rank. As many regularisations are fitted at once as
    need no more blocks than one; all share the rank's dealt ratings.
    """
    spark = train.sparkSession
    train = read_stored(train.select("user_id", "product_id", "score"), "train")
    test = read_stored(test.select("user_id", "product_id", "score"), "test")
    counts = train.agg(
        F.count("*").alias("n"), *(F.approx_count_distinct(c).alias(c) for c in ("user_id", "product_id"))
    ).first()
    per_id = 2 * counts["n"] / max(1, counts["user_id"] + counts["product_id"])

    def evaluate(point):
        rank, some = point
        if iterations > 0 and rank > per_id and min(some) > 0:
            return _summed_errors(rows, turned, load, test, rank, some, iterations, seed)
        return [
            (rank, x, rmse(predict(fit_als(train, rank, iterations, x, seed), test)).first()["rmse"]) for x in some
        ]

    every = tuple(float(reg) for reg in reg_params)
    together = [(int(r), every) for r in ranks if r > per_id]
    alone = [(int(r), (reg,)) for r in ranks if r <= per_id for reg in every]
    if together:
        rows = _checked(train)
        turned = gram.ratings_to_fit(_turned(rows))
        load = gram.load_of(turned)
    with ThreadPoolExecutor(parallelism) as pool:
        found = {row[:2]: row for rows in pool.map(evaluate, together + alone) for row in rows}
    results = [found[int(r), reg] for r in ranks for reg in every]
    return spark.createDataFrame(results, schemas.TUNING_GRID)


def _summed_errors(rows, turned, load, test, rank, reg_params, iterations, seed):
    """Rank, regularisation and test error of fits from the same start as ``fit_als``."""
    begin = user_vectors(fit_als(_one_each(rows), rank, 0, reg_params[0], seed, _fit_blocks(rows, rank)))
    begin = read_stored(begin, "start")
    at_once = gram.fits_at_once(load, len(reg_params), rank * np.dtype(np.float32).itemsize, gram.cores_of(rows))
    dealt = gram.deal(turned, load, at_once * rank * np.dtype(np.float32).itemsize)
    found = []
    for first in range(0, len(reg_params), at_once):
        some = reg_params[first : first + at_once]
        errors = gram.squared_errors(test, _alternated(dealt, rank, iterations, some, begin), rank, len(some)).collect()
        mean = {r["fit"]: r["squares"] / r["n"] for r in errors if r["n"]}
        found += [(rank, x, math.sqrt(mean[j]) if j in mean else None) for j, x in enumerate(some)]
    return found


def best_parameters(grid: DataFrame) -> DataFrame:
    return grid.orderBy("rmse", "rank", "reg_param").limit(1)
