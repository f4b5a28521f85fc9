import functools

import numpy as np
import pyarrow as pa
import pytest
from helpers import rows
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.functions.ranking import unpack_recs
from merchlens.operators import factorization as fm
from merchlens.operators import gram


@pytest.fixture(scope="module")
def ratings(table):
    """Planted rank-2 structure on 40 users and 30 products; user 0 rated everything."""
    rng = np.random.default_rng(1)
    users, items = rng.uniform(0.5, 1.5, (40, 2)), rng.uniform(0.5, 1.5, (30, 2))
    data = [
        (u, i, float(users[u] @ items[i]), 100 + u * 30 + i)
        for u in range(40)
        for i in range(30)
        if u == 0 or rng.random() < 0.6
    ]
    return table(data, schemas.RATING).cache()


@pytest.fixture(scope="module")
def model(ratings):
    return fm.fit_als(ratings, rank=4, iterations=5, reg_param=0.01, seed=7)


def scores(model):
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    return {(u, i): float(a @ b) for u, a in users.items() for i, b in items.items()}


def test_error_beats_the_mean(ratings):
    train, test = fm.holdout_split(ratings)
    model = fm.fit_als(train, rank=4, reg_param=0.01)
    mean = train.agg(F.avg("score")).first()[0]
    error = fm.rmse(fm.predict(model, test)).first()["rmse"]
    base = fm.rmse(test.withColumn("prediction", F.lit(mean))).first()["rmse"]
    assert error < 0.5 * base


def test_user_recs(model):
    lists = fm.user_recs(model, 20)
    assert lists.schema.simpleString() == "struct<user_id:int,recs:array<struct<product_id:int,score:double>>>"
    best = scores(model)
    for row in lists.collect():
        got = [r.score for r in row.recs]
        want = sorted((s for (u, _), s in best.items() if u == row.user_id and s > 0), reverse=True)
        assert got == pytest.approx(want[: len(got)], abs=1e-4) and len(got) == min(20, len(want))
    assert lists.count() == 40


def test_only_positive_predictions(table):
    predictions = table(
        [(1, 1, 2.0), (1, 2, -1.0), (1, 3, 2.0), (2, 1, 0.0), (3, 1, float("nan"))],
        "user_id INT, product_id INT, score DOUBLE",
    )
    got = unpack_recs(fm.recs_from_predictions(predictions))
    assert rows(got) == [(1, 1, 1, 2.0), (1, 2, 3, 2.0)]


def test_unrated_recs(model, ratings):
    rated = {(r.user_id, r.product_id) for r in ratings.collect()}
    best = scores(model)
    got = {r.user_id: r.recs for r in fm.unrated_user_recs(model, ratings, 3).collect()}
    assert 0 not in got
    for user in range(1, 40):
        want = sorted(
            (s for (u, i), s in best.items() if u == user and (u, i) not in rated and s > 0),
            reverse=True,
        )[:3]
        assert [r.score for r in got.get(user, [])] == pytest.approx(want, abs=1e-4)


def test_unknown_pairs_drop_out(model, table):
    pairs = table([(1, 2), (999, 2), (1, 999)], "user_id INT, product_id INT")
    assert fm.predict(model, pairs).count() == 1


def test_fit_repeats(ratings, model):
    again = fm.fit_als(ratings, rank=4, iterations=5, reg_param=0.01, seed=7)
    a, b = scores(model), scores(again)
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-2


def test_split_is_stable_and_whole(ratings):
    train, test = fm.holdout_split(ratings)
    assert rows(train) == rows(fm.holdout_split(ratings.repartition(7))[0])
    assert rows(train.unionByName(test)) == rows(ratings)
    assert 0.72 < train.count() / ratings.count() < 0.88
    assert rows(fm.holdout_split(ratings, seed=1)[0]) != rows(train)
    random_train, random_test = fm.random_split(ratings)
    assert random_train.count() + random_test.count() == ratings.count()


def test_grid(ratings):
    train, test = fm.holdout_split(ratings)
    grid = fm.tune_als(train, test, ranks=(2, 3), reg_params=(1.0, 0.01))
    assert [(r.rank, r.reg_param) for r in grid.collect()] == [(2, 1.0), (2, 0.01), (3, 1.0), (3, 0.01)]
    best = fm.best_parameters(grid).first()
    assert best.reg_param == 0.01 and best.rmse == min(r.rmse for r in grid.collect())


def test_wide_ranks_are_fitted_as_by_the_fit(ratings, monkeypatch):
    """Ranks above the ratings of an id have the errors of single fits, without such fits."""
    train, test = fm.holdout_split(ratings)
    want = [
        fm.rmse(fm.predict(fm.fit_als(train, 40, 3, reg), test)).first()["rmse"] for reg in (0.5, 0.05)
    ]
    fits, fit = [], fm.fit_als
    monkeypatch.setattr(fm, "fit_als", lambda t, rank, n, *more: fits.append(n) or fit(t, rank, n, *more))
    grid = fm.tune_als(train, test, ranks=(40,), reg_params=(0.5, 0.05), iterations=3)
    assert [r.rmse for r in grid.collect()] == pytest.approx(want, rel=1e-4)
    assert fits == [0]


def test_blocks_of_short_vectors_are_few(spark, ratings):
    """Low ranks send their vectors to fewer blocks than there are cores."""
    made, als = [], fm.ALS
    try:
        fm.ALS = lambda **more: made.append(more["numUserBlocks"]) or als(**more)
        for rank in (4, 50):
            fm.fit_als(ratings, rank, 1)
    finally:
        fm.ALS = als
    assert made == [2, spark.sparkContext.defaultParallelism]


def test_the_fit_equals_sparks_without_its_rounds(spark, ratings, monkeypatch):
    """From Spark's start by the same steps; of ``ALS`` itself no round, which sends vectors to all blocks."""
    want = fm.ALS(
        rank=3, maxIter=3, regParam=0.05, numUserBlocks=4, numItemBlocks=4, userCol="user_id", itemCol="product_id",
        ratingCol="score", seed=5,
    ).fit(ratings)
    made, als = [], fm.ALS
    monkeypatch.setattr(fm, "ALS", lambda **more: made.append(more["maxIter"]) or als(**more))
    found = fm.fit_als(ratings, 3, 3, 0.05, 5, 4)
    assert made == [0]
    for got, side in ((found.userFactors, want.userFactors), (found.itemFactors, want.itemFactors)):
        vectors = {r.id: np.array(r.features) for r in side.collect()}
        rows = {r.id: np.array(r.features) for r in got.collect()}
        assert rows.keys() == vectors.keys()
        assert max(np.abs(rows[k] - vectors[k]).max() for k in rows) < 1e-3
    pairs = ratings.select("ts", "product_id", "user_id", F.array("score").alias("list")).union(
        spark.createDataFrame([(1, 2, 999, [1.0]), (1, 999, 2, None)], "ts BIGINT, product_id INT, user_id INT, list ARRAY<DOUBLE>")
    )
    got, old = fm.predict(found, pairs), want.transform(pairs).where("NOT isnan(prediction)")
    assert got.columns == old.columns and got.count() == old.count() == ratings.count()
    both = got.withColumnRenamed("prediction", "p").join(old, ["ts", "product_id", "user_id", "list"])
    assert both.count() == ratings.count() and both.where("abs(p - prediction) > 1e-3").isEmpty()


@pytest.mark.parametrize("odd", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan")), (1, 1, float("inf"))])
def test_lost_ratings_are_refused(spark, odd):
    rows = [(u, p, 1.0) for u in range(3) for p in range(3)] + [odd]
    with pytest.raises(Exception, match="null"):
        fm.fit_als(spark.createDataFrame(rows, "user_id INT, product_id INT, score DOUBLE"), 2, 1)


def test_item_vectors(model):
    assert fm.item_vectors(model).columns == ["product_id", "features"]
    assert fm.item_vectors(model).count() == 30


# Blocks of falling vector length


def skewed(n_users, n_items, size=6, seed=5):
    """Users, and items of which a few are far longer than the rest."""
    rng = np.random.default_rng(seed)
    users = {u: rng.normal(size=size) for u in range(n_users)}
    items = {p: rng.normal(size=size) * (20 if p % 23 == 0 else 0.5) for p in range(n_items)}
    items[5], items[6] = items[23] * 1.0, items[23] * 1.0  # ties
    return users, items


def tables_of(spark, users, items, depth):
    left = [(u, [float(x) for x in v], depth) for u, v in users.items()]
    right = [(p, [float(x) for x in v]) for p, v in items.items()]
    return (
        spark.createDataFrame(left, "user_id INT, features ARRAY<DOUBLE>, depth INT"),
        spark.createDataFrame(right, "product_id INT, features ARRAY<DOUBLE>").repartition(3),
    )


def best_by_loops(users, items, k, rated=()):
    out = []
    for u, v in users.items():
        scored = [(-float(v @ w), p) for p, w in items.items() if v @ w > 0 and (u, p) not in rated]
        out += [(u, p, round(-s, 9)) for s, p in sorted((round(s, 9), p) for s, p in scored)[:k]]
    return sorted(out)


def unpacked(lists):
    return sorted((r["user_id"], e["product_id"], round(e["score"], 9)) for r in lists.collect() for e in r["recs"])


@pytest.mark.parametrize("item_block", [16, 50, 1000])
def test_pruned_lists_equal_loops(spark, item_block):
    users, items = skewed(40, 300)
    users[3] = users[3] * 0
    left, right = tables_of(spark, users, items, 7)
    best = fm.best_products(left, right, item_block=item_block)
    assert unpacked(fm.recs_from_predictions(best, 7)) == best_by_loops(users, items, 7)
    rated = {(u, p) for u in range(0, 40, 2) for p in range(0, 300, 23 if u % 4 else 2)}
    table = spark.createDataFrame(sorted(rated), "user_id INT, product_id INT")
    best = fm.best_products(left, right, table, item_block)
    fresh = best.join(table, ["user_id", "product_id"], "left_anti")
    assert unpacked(fm.recs_from_predictions(fresh, 7)) == best_by_loops(users, items, 7, rated)


def test_short_vectors_are_never_multiplied(spark):
    users, items = skewed(40, 460)
    left, right = tables_of(spark, users, items, 7)
    blocks, longest = fm.norm_blocks(right, 460, 20)
    assert len(longest) == 23 and longest == sorted(longest, reverse=True)
    assert blocks.count() == 460 and blocks.select("item_block").distinct().count() == 23
    first = fm._first_block(left, blocks, None, 1, 2)
    reached = fm.reach(left, first, None, longest).agg(F.sum("reach")).first()[0]
    assert reached <= 0.25 * 40 * 22


def test_users_are_sent_once_per_wide_block(spark, monkeypatch):
    """Small blocks of products do not multiply the rows of users that reach into many."""
    users, items = skewed(30, 400)
    items = {p: v / (v @ v) ** 0.5 for p, v in items.items()}  # of one length: nothing is pruned
    left, right = tables_of(spark, users, items, 3)
    sent, join = [], fm._best_pairs
    monkeypatch.setattr(fm, "_best_pairs", lambda a, b, *more: sent.append(a.count()) or join(a, b, *more))
    best = fm.best_products(left, right, item_block=10)
    assert unpacked(fm.recs_from_predictions(best, 3)) == best_by_loops(users, items, 3)
    assert sent == [30, 30]


def test_extreme_lengths_are_compared(spark):
    users, items = skewed(6, 30)
    users[1], items[7] = users[1] * 1e-200, items[7] * 1e-170
    best = fm.best_products(*tables_of(spark, users, items, 40))
    assert {(r.user_id, r.product_id) for r in best.collect() if r.user_id > 1} >= {
        (u, 7) for u in range(2, 6) if users[u] @ items[7] > 0
    }


def test_vectors_of_another_size_have_no_predictions(spark):
    users, items = skewed(6, 30)
    left, right = tables_of(spark, users, items, 4)
    odd = spark.createDataFrame([(900, [1.0, 2.0])], "product_id INT, features ARRAY<DOUBLE>")
    lost = spark.createDataFrame([(901, [1.0], 4)], "user_id INT, features ARRAY<DOUBLE>, depth INT")
    best = fm.best_products(left.union(lost), right.union(odd))
    assert unpacked(fm.recs_from_predictions(best, 4)) == best_by_loops(users, items, 4)


def test_penalties_one_by_one_and_at_once(spark, monkeypatch):
    """The grid does not depend on how many penalties are fitted at once."""
    rng = np.random.default_rng(6)
    rows = sorted({(int(u), int(p)) for u, p in rng.integers(0, 30, size=(150, 2))})
    data = spark.createDataFrame([(u, p, float(1 + (u * p) % 5)) for u, p in rows], "user_id INT, product_id INT, score DOUBLE")
    grids, seen, deal = [], [], gram.deal
    monkeypatch.setattr(gram, "deal", lambda *more: seen.append(more) or deal(*more))
    for at_once in (1, 2):
        monkeypatch.setattr(gram, "fits_at_once", lambda *more, n=at_once: n)
        grid = fm.tune_als(data, data, ranks=(12,), reg_params=(1.0, 0.1, 0.01), iterations=2)
        grids.append([tuple(r) for r in grid.collect()])
    assert np.allclose(*grids) and len(grids[0]) == 3 and len(seen) == 2


def test_users_without_a_better_product_are_passed_over(monkeypatch):
    """Later slices are searched only for users who find something there; NaN hides nothing."""
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(60, 6)).astype(np.float32), rng.normal(size=(900, 6)).astype(np.float32)
    users[3, 0], items[800] = 0.0, [np.inf, 0, 0, 0, 0, 0]
    items /= np.linalg.norm(items[:, 1:], axis=1, keepdims=True) + 1e-9  # slices bound nothing
    looked, cells = [], fm.cells
    monkeypatch.setattr(fm, "cells", lambda mask: looked.append(mask.size) or cells(mask))
    monkeypatch.setattr(fm, "ITEM_SLICE", 30)
    monkeypatch.setattr(fm, "BestHits", functools.partial(fm.BestHits, waiting=50))

    def table(key, vectors, **more):
        lists = pa.array([v.tolist() for v in vectors], pa.list_(pa.float32()))
        return pa.table({key: pa.array(range(len(vectors)), pa.int32()), "features": lists, **more})

    depth, floor = pa.array([2] * 60, pa.int32()), pa.array([0.0] * 60)
    found = fm._best_of_blocks(table("user_id", users, depth=depth, floor=floor), table("product_id", items))
    with np.errstate(invalid="ignore"):
        sims = users @ items.T
    sims[np.isnan(sims)] = -1
    pairs = set(zip(found["user_id"].to_pylist(), found["product_id"].to_pylist()))
    for u in range(60):
        best = np.argsort(-sims[u], kind="stable")[:2]
        assert {(u, int(p)) for p in best if sims[u, p] > 0} <= pairs
    assert sum(looked) < 0.6 * sims.size
