"""Logged tables, statistics that follow merges, name search and predecessors."""

import random
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.operators import ratings as rating_ops
from merchlens.operators import search, statistics
from merchlens.sources.table_log import RatingsLog, TotalsLog


def some_ratings(seed, n, scores=(1.0, 2.5, 5.0)):
    rng = random.Random(seed)
    return [(rng.randrange(30), rng.randrange(20), rng.choice(scores), rng.randrange(10**9)) for _ in range(n)]


def test_merges_come_once_and_readers_keep_their_state(spark, tmp_path):
    log = RatingsLog(spark, str(tmp_path), 4)
    assert log.read().count() == 0 and log.last() == 0
    base = spark.createDataFrame(some_ratings(1, 80) + some_ratings(1, 5), schemas.RATING)
    log.overwrite(base)
    assert rows(schemas.as_ratings(log.read())) == rows(base)
    reader = log.read()
    updates = spark.createDataFrame(some_ratings(2, 40), schemas.RATING)
    before, after = log.merge(updates, "a")
    pairs = updates.select("user_id", "product_id").distinct()
    touched = base.join(pairs, ["user_id", "product_id"], "left_semi")
    rest = base.join(pairs, ["user_id", "product_id"], "left_anti")
    want = rating_ops.upsert_ratings(touched, updates).unionByName(rest)
    assert rows(schemas.as_ratings(log.read())) == rows(want)
    assert rows(before) == rows(touched) and after.count() == pairs.count()
    assert log.merge(updates, "a") is None and log.last() == 2
    assert rows(schemas.as_ratings(reader)) == rows(base)  # begun before the merge
    one = spark.createDataFrame([(3, 1, 9.0, 2 * 10**9)], schemas.RATING)
    log.merge(one, "b")
    assert log.commits().where("seq = 3").count() == 1  # one user, one bucket
    assert log.drop_retired(keep=1) and log.drop_retired(keep=1) == []
    assert log.read().where("user_id = 3 AND product_id = 1").select("score").first()[0] == 9.0
    assert log.read().count() == log.read().select("user_id").count()


def test_statistics_follow_merges(spark, tmp_path):
    log, totals = RatingsLog(spark, str(tmp_path / "r"), 4), TotalsLog(spark, str(tmp_path / "t"))
    base = rating_ops.latest_ratings(spark.createDataFrame(some_ratings(3, 200), schemas.RATING))
    log.overwrite(base)
    totals.add(statistics.monthly_totals(base), "base")
    for k in range(3):
        updates = spark.createDataFrame(some_ratings(10 + k, 60, (0.5, 4.0)), schemas.RATING)
        changed = log.merge(updates, f"m{k}")
        assert totals.add(statistics.monthly_changes(*changed), f"m{k}")
        assert not totals.add(statistics.monthly_changes(*changed), f"m{k}")
        if k == 1:
            totals.fold()
        want = statistics.monthly_totals(schemas.as_ratings(log.read()))
        assert rows(totals.totals()) == rows(want.select(*totals.totals().columns))
    assert totals.state().count() == 2


def test_fold_spreads_the_sums(spark, tmp_path):
    """As many tasks add up a table as its shuffle has, not as there are changes."""
    totals = TotalsLog(spark, str(tmp_path))
    rows_ = spark.range(4000).selectExpr(
        "CAST(id AS INT) AS product_id", "202401 AS yearmonth", "2L AS count", "1L AS n_scores", "3.5D AS sum_score"
    )
    totals.add(rows_, "base")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        totals.fold()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(totals.read().inputFiles()) > 1
    assert rows(totals.totals()) == rows(rows_)


PATTERNS = {
    "abc": ["abc"], "^abcd$": ["abc", "bcd"], "ab?cd": [], "abcx?": ["abc"], "abc*de": [], "a.c": [], "[abc]def": ["def"],
    r"a\.bc": ["a.b", ".bc"], r"\dabc": ["abc"], "abc|d": [], "(abc)": [], "(?i)abc": [], "abc+de": ["abc"],
    "xab{2}cde": ["cde"], "ab{0}cde": ["cde"], "": [], r"abc\b": ["abc"], "[^]x]yyy": ["yyy"],
}


@pytest.mark.parametrize("pattern", PATTERNS)
def test_required_pieces(pattern):
    assert search.required_pieces(pattern) == sorted(PATTERNS[pattern])


def test_search_equals_trying_every_name(spark):
    rng = random.Random(5)
    names = [(i, "".join(rng.choice("abcde. ") for _ in range(rng.randrange(9)))) for i in range(400)]
    names += [(900, None), (901, ""), (902, "a.bc"), (903, "xabbcde"), (904, "abcde")]
    products = spark.createDataFrame(names, "product_id INT, name STRING").repartition(3)
    asked = [(f"q{k}", p) for k, p in enumerate([*PATTERNS, "abc", "a", "b.d", "nowhere"])] + [("null", None)]
    requests = spark.createDataFrame(asked + asked[:2], "query STRING, pattern STRING")
    want = sorted((q, i) for q, p in asked if p is not None for i, n in names if n is not None and re.search(p, n))
    assert sorted(map(tuple, search.search_names(products, requests).collect())) == want
    postings = search.name_postings(products).cache()
    assert search.search_names(products, requests, postings).count() == len(want)
    assert search.search_names(products, requests.where("false")).count() == 0


@pytest.mark.parametrize("ranges", [2, 64])
def test_predecessors(spark, ranges):
    rng = random.Random(6)
    events = [(k, 7 if rng.random() < 0.4 else rng.randrange(20), rng.randrange(9), rng.randrange(300)) for k in range(600)]
    events += [(600, None, 1, 5), (601, None, 2, 9), (602, 3, 4, None)]
    df = spark.createDataFrame(events, "event_id LONG, user_id INT, product_id INT, ts LONG").repartition(4)
    got = {r["event_id"]: r["previous"] for r in rating_ops.previous_products(df, ranges).collect()}
    want = {r["event_id"]: r["p"] for r in df.withColumn("p", F.expr(
        "lag(product_id) OVER (PARTITION BY user_id ORDER BY ts, event_id)")).collect()}
    assert got == want


def test_sql_months_of_any_number(spark):
    from merchlens.functions.expr import register_sql_functions

    register_sql_functions(spark)
    row = spark.sql(
        "SELECT changeDate(0), changeDate(1260759144), changeDate(9223372036854775807), changeDate(-99999999999999),"
        " changeDateScaled(12607591440, 100), changeDate(NULL)"
    ).first()
    assert tuple(row) == (197001, 200912, None, None, 200912, None)
