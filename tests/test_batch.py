"""Statistics, ratings, users and the read side on small tables."""

import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.functions.ranking import pack_recs, top_per_key, unpack_recs
from merchlens.operators import ratings as rating_ops
from merchlens.operators import serving, statistics, users

DAY = 86_400


@pytest.fixture
def ratings(table):
    return table(
        [
            (1, 10, 5.0, 1260759144),
            (2, 10, 3.0, 1260759144),
            (1, 11, 4.0, 1260759144 + 40 * DAY),
            (3, 12, 1.0, 1260759144 + 40 * DAY),
            (4, 12, 2.0, 1260759144),
        ],
        schemas.RATING,
    )


def test_statistics(ratings):
    assert rows(statistics.rate_more(ratings)) == [(10, 2), (11, 1), (12, 2)]
    assert rows(statistics.average_products(ratings)) == [(10, 4.0), (11, 4.0), (12, 1.5)]
    recently = statistics.rate_more_recently(ratings).collect()
    assert [tuple(r) for r in recently] == [
        (11, 1, 201001), (12, 1, 201001), (10, 2, 200912), (12, 1, 200912),
    ]


def test_one_pass_statistics_agree(ratings):
    totals = statistics.product_totals(statistics.monthly_totals(ratings))
    both = statistics.rate_more(ratings).join(statistics.average_products(ratings), "product_id")
    assert rows(totals) == rows(both)


def test_hot_products_keep_best_rank(ratings):
    recently = statistics.rate_more_recently(ratings, ordered=False)
    assert rows(statistics.hot_products(recently, 4)) == [(10, 3), (11, 1), (12, 2)]
    assert rows(statistics.hot_products(recently, 1)) == [(11, 1)]


def test_upsert(table):
    base = table([(1, 2, 3.0, 1), (5, 5, 1.0, 9)], schemas.RATING)
    updates = table([(1, 2, 5.0, 2), (5, 5, 2.0, 9), (7, 7, 4.0, 3), (7, 7, 3.0, 2)], schemas.RATING)
    expected = [(1, 2, 5.0, 2), (5, 5, 2.0, 9), (7, 7, 4.0, 3)]
    assert rows(rating_ops.upsert_ratings(base, updates)) == expected
    kept = rating_ops.upsert_ratings(base, updates, keep_ts=True)
    assert rows(kept) == [(1, 2, 5.0, 1), (5, 5, 2.0, 9), (7, 7, 4.0, 2)]


small_ratings = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 4), st.sampled_from([1.0, 2.0, 5.0]), st.integers(0, 6)),
    min_size=1,
    max_size=25,
)


@settings(max_examples=5, deadline=None)
@given(small_ratings, small_ratings)
def test_upsert_is_idempotent(table, base, updates):
    base, updates = table(base, schemas.RATING), table(updates, schemas.RATING)
    once = rating_ops.upsert_ratings(base, updates)
    assert rows(rating_ops.upsert_ratings(once, updates)) == rows(once)


@settings(max_examples=5, deadline=None)
@given(small_ratings, st.integers(1, 5))
def test_top_per_key_is_sort_and_take(table, data, k):
    df = table(data, schemas.RATING)
    got = top_per_key(df, ("user_id",), (F.desc("ts"), F.desc("product_id"), F.desc("score")), k)
    want = []
    for user in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == user), key=lambda r: (r[3], r[1], r[2]), reverse=True)
        want += mine[:k]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("pushes, kept", [(39, 39), (40, 40), (41, 40)])
def test_capped_list(table, pushes, kept):
    df = table([(1, p, 3.0, p) for p in range(1, pushes + 1)], schemas.RATING)
    recents = rating_ops.capped_recent_lists(df).first().recents
    assert [r.product_id for r in recents] == list(range(pushes, pushes - kept, -1))


def test_recent_slice(table):
    df = table([(1, p, 3.0, p) for p in range(30)], schemas.RATING)
    assert rating_ops.recent_ratings(df).count() == 20
    assert rating_ops.recent_ratings(df, inclusive=True).count() == 21


def test_recent_repeats(table):
    df = table([(1, 5, 3.0, 1), (1, 5, 4.0, 2), (1, 6, 2.0, 0)], schemas.RATING)
    assert rating_ops.recent_ratings(df).count() == 3
    distinct = rating_ops.recent_ratings(df, distinct_products=True)
    assert rows(distinct.select("product_id", "score", "position")) == [(5, 4.0, 1), (6, 2.0, 2)]


def test_hot_user_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("user_id"),
        F.col("id").cast("int").alias("product_id"),
        F.lit(3.0).alias("score"),
        F.col("id").alias("ts"),
    )
    recent = rating_ops.recent_ratings(df)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    hot = recent.where("user_id = 1").collect()
    assert sorted(r.product_id for r in hot) == list(range(29997 - 19 * 3, 29998, 3))


def test_pack_and_unpack(table):
    df = table([(1, 7, 0.5), (1, 3, 0.5), (1, 9, 0.9), (2, 1, 0.1)], "k INT, product_id INT, score DOUBLE")
    packed = pack_recs(df, "k")
    assert [r.product_id for r in packed.where("k = 1").first().recs] == [9, 3, 7]
    assert rows(unpack_recs(packed)) == [(1, 1, 9, 0.9), (1, 2, 3, 0.5), (1, 3, 7, 0.5), (2, 1, 1, 0.1)]


def user_table(table, *names):
    df = table([(n, True, ["a"]) for n in names], "username STRING, first BOOLEAN, pref_genres ARRAY<STRING>")
    return df.select(users.name_hash(F.col("username")).alias("user_id"), "*")


def test_register_users(table):
    existing = user_table(table, "ann")
    requests = table([("ann", 5), ("bob", 9), ("bob", 3), ("cleo", None)], "username STRING, requested_at BIGINT")
    new = users.register_users(existing, requests)
    got = {r.username: r for r in new.collect()}
    assert set(got) == {"bob", "cleo"}
    assert got["bob"].created_at.timestamp() == 3 and got["bob"].first and got["bob"].pref_genres == []
    assert got["cleo"].created_at is not None
    assert rows(users.taken_names(existing, requests)) == [("ann",)]


def test_id_collisions(table):
    everyone = user_table(table, "Aa", "BB", "Cc")
    assert [r.username for r in users.id_collisions(everyone).orderBy("username").collect()] == ["Aa", "BB"]


def test_update_preferences(table):
    everyone = user_table(table, "ann", "bob")
    ann = everyone.where("username = 'ann'").first().user_id
    updates = table(
        [(ann, False, ["x"], 1), (ann, None, ["y"], 2)],
        "user_id INT, first BOOLEAN, pref_genres ARRAY<STRING>, updated_at BIGINT",
    )
    got = {r.username: r for r in users.update_preferences(everyone, updates).collect()}
    assert (got["ann"].first, got["ann"].pref_genres) == (True, ["y"])
    assert (got["bob"].first, got["bob"].pref_genres) == (True, ["a"])


@pytest.fixture
def served(table):
    products = table([(i, f"name {i}", "", "c", "t") for i in (1, 2, 3)], schemas.PRODUCT)
    averages = table([(1, 4.5)], "product_id INT, avg DOUBLE")
    return serving.served_products(products, averages)


def test_served_products(served):
    assert rows(served.select("product_id", "score")) == [(1, 4.5), (2, 0.0), (3, 0.0)]


def test_serve_recs(table, served):
    recs = table([(5, [(2, 0.9), (77, 0.8), (1, 0.7)]), (6, [])], schemas.USER_RECS)
    requests = table([(5,), (6,), (7,)], "user_id INT")
    got = serving.serve_recs(requests, recs, served, "user_id", 3)
    assert rows(got.select("user_id", "rank", "product_id", "avg_score")) == [
        (5, 1, 2, 0.0), (5, 3, 1, 4.5), (6, None, None, None), (7, None, None, None),
    ]
    strict = serving.serve_recs(requests, recs, served, "user_id", 1, drop_missing=True)
    assert rows(strict.select("user_id", "product_id")) == [(5, 2)]


def test_search_is_a_case_sensitive_pattern(served):
    got = serving.search_products(served, {"a": "me [12]", "b": "NAME"})
    assert rows(got.select("query", "product_id")) == [("a", 1), ("a", 2)]


def test_record_ratings(table):
    everyone = user_table(table, "ann")
    ann = everyone.first().user_id
    stored = table([(ann, 1, 2.0, 1)], schemas.RATING)
    requests = table(
        [("ann", 1, 9.0, 5), ("zoe", 1, 1.0, 5)],
        "username STRING, product_id INT, score DOUBLE, ts BIGINT",
    )
    accepted, merged, lines, unknown = serving.record_ratings(requests, everyone, stored)
    assert rows(accepted) == rows(merged) == [(ann, 1, 4.5, 5)]
    assert rows(lines) == [(f"PRODUCT_RATING_PREFIX:{ann}|1|4.5|5",)]
    assert [r.username for r in unknown.collect()] == ["zoe"]
