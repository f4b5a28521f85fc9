"""Every text input ends typed or in quarantine; no row is lost, no line ends a job."""

import time

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.constants import RATING_MARKER
from merchlens.functions import expr
from merchlens.operators import factorization, serving, statistics
from merchlens.plans import jobs
from merchlens.sources import files, tables
from merchlens.streaming import log_events, scorer


def test_products_with_empty_fields(spark, tmp_path):
    (tmp_path / "p.txt").write_text("1^^c^e^img^a|b^t\n2^n^c^e^img^a|b^\n3^n^^^^^^more\n^n^c^e^i^a^t\n\n4^n^c^e^i^a\n")
    good, bad = files.scan_product_file(spark, str(tmp_path / "p.txt"))
    assert rows(good) == [(1, "", "img", "a|b", "t"), (2, "n", "img", "a|b", ""), (3, "n", "", "", "")]
    assert bad.count() == 2


def test_load_keeps_repeated_ratings(spark, tmp_path):
    (tmp_path / "p.txt").write_text("1^n^c^e^i^a^t\n")
    (tmp_path / "r.csv").write_text("1,1,5.0,100\n1,1,1.0,200\n2,1,3.0,300\n")
    store = str(tmp_path / "store")
    jobs.load(spark, str(tmp_path / "p.txt"), str(tmp_path / "r.csv"), store)
    jobs.compute_statistics(spark, store)
    assert rows(jobs.table(spark, store, jobs.RATE_MORE)) == [(1, 3)]
    assert rows(jobs.table(spark, store, jobs.AVERAGE)) == [(1, 3.0)]
    stream = spark.createDataFrame([(2, 1, 4.0, 400)], schemas.RATING)
    jobs.ratings_log(spark, store).merge(stream, "test")
    merged = jobs.table(spark, store, jobs.RATINGS, schemas.RATING)
    assert rows(merged) == [(1, 1, 1.0, 200), (1, 1, 5.0, 100), (2, 1, 4.0, 400)]


numbers = st.one_of(
    st.integers().map(str),
    st.floats().map(str),
    st.sampled_from(["", " ", "1e100", "1e999", "-1e-999", "NaN", "inf", "0x1", "1_0", "-9223372036854775808", "1" * 400]),
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(numbers, numbers, numbers, numbers), min_size=1, max_size=20))
def test_payloads_end_typed_or_in_quarantine(spark, parts):
    payloads = spark.createDataFrame([("|".join(p),) for p in parts], "value string")
    good, bad = log_events.parse_payloads(payloads)
    typed = good.withColumn("month", expr.year_month(F.col("ts"))).collect()
    assert len(typed) + bad.count() == len(parts)
    assert all(v is not None for r in typed for v in r)
    statistics.monthly_totals(good).count()


@pytest.mark.parametrize("ts", [9 * 10**15, 9 * 10**13, -(2**63), 2**63 - 1, None])
def test_months_of_no_date(spark, ts):
    df = spark.createDataFrame([(ts,)], "ts long")
    assert df.select(expr.year_month(F.col("ts")).alias("m")).first()["m"] is None


def test_units(spark):
    df = spark.createDataFrame([(-1,), (1500,), (2**62,)], "ts long")
    assert [r[0] for r in df.select(schemas.epoch_seconds(F.col("ts"), "ms")).collect()] == [-1, 1, None]
    with pytest.raises(ValueError):
        schemas.epoch_seconds(F.col("ts"), "us")


@pytest.mark.parametrize("text", ["\u624b\u673a", "caf\u00e9", "plain", "", None, "end\u2028", "\u00e9\n\u624b", "\u00ff"])
def test_recoding_leaves_right_text(spark, text):
    df = spark.createDataFrame([(text,)], "q string")
    assert df.select(expr.recode_query(F.col("q")).alias("q")).first()["q"] == text


def test_sinks_share_a_front_end(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a").write_text(f"{RATING_MARKER}9|9|9|9\nx {RATING_MARKER}1|2|3.0|4\nx {RATING_MARKER}bad\n")
    lines = files.stream_lines(spark, str(tmp_path / "log"))
    out = str(tmp_path)
    log_events.write_ratings_log(lines, f"{out}/r", f"{out}/c1", True).awaitTermination()
    log_events.write_quarantine(lines, f"{out}/b", f"{out}/c2", True).awaitTermination()
    log_events.write_payloads(lines, f"{out}/p", f"{out}/c3", True).awaitTermination()
    assert rows(schemas.as_ratings(spark.read.parquet(f"{out}/r"))) == [(1, 2, 3.0, 4)]
    assert rows(spark.read.text(f"{out}/b")) == [("bad",)]
    assert rows(spark.read.text(f"{out}/p")) == [("1|2|3.0|4",), ("bad",)]


def test_one_clock_for_a_request(spark):
    requests = spark.createDataFrame([("a", 1, 9.0, None)], "username string, product_id int, score double, ts long")
    users = spark.createDataFrame([("a", 7)], "username string, user_id int")
    stored = spark.createDataFrame([], schemas.RATING)
    accepted, table, lines, _ = serving.record_ratings(requests, users, stored, now=5)
    assert rows(accepted) == rows(table) == [(7, 1, 4.5, 5)] and lines.first()[0].endswith("7|1|4.5|5")
    before = int(time.time())
    accepted, table, _, _ = serving.record_ratings(requests, users, stored)
    time.sleep(1.1)
    assert rows(accepted) == rows(table) and before <= accepted.first()["ts"] <= before + 60


def test_versions_switch_as_a_whole(spark, tmp_path):
    root = str(tmp_path / "model")
    tables.write_version(spark, root, a=spark.range(1), b=spark.range(1))
    cached = tables.CachedVersion(spark, root, "id", 0, a="id BIGINT", b="")
    cached.fresh()
    tables.write_version(spark, root, a=spark.range(5), b=spark.range(7))
    assert (cached.table("a").count(), cached.table("b").count()) == (1, 1)
    cached.fresh()
    assert (cached.table("a").count(), cached.table("b").count()) == (5, 7)


def test_compaction_keeps_the_newest_lists(spark, tmp_path):
    path, target = str(tmp_path / "recs"), str(tmp_path / "folded")

    def batch(n, *users):
        recs = [(u, [(n, float(n))]) for u in users]
        spark.createDataFrame(recs, schemas.USER_RECS).write.parquet(f"{path}/batch_id={n}")

    def current(*paths):
        return {r["user_id"]: r["recs"][0]["product_id"] for r in scorer.current_recs(spark, *paths).collect()}

    batch(0, 1, 2)
    assert scorer.compact_stored(spark, path, target) == []
    batch(1, 2, 3)
    batch(2, 3)
    assert scorer.compact_stored(spark, path, target) == [0, 1]
    assert current(path, target) == {1: 0, 2: 1, 3: 2}
    batch(3, 1)
    assert scorer.compact_stored(spark, path, target) == [2]
    assert current(path, target) == {1: 3, 2: 1, 3: 2}
    assert sorted(p.name for p in (tmp_path / "recs").glob("batch*")) == ["batch_id=3"]


def test_unrated_depth_follows_the_block(spark, monkeypatch):
    monkeypatch.setattr(factorization, "ITEM_BLOCK", 10)
    users = spark.createDataFrame([(u, [1.0, u / 7]) for u in range(5)], "user_id int, features array<double>")
    items = spark.createDataFrame([(p, [1.0, p / 9 - 1]) for p in range(60)], "product_id int, features array<double>")
    rated = [(u, p) for u in range(5) for p in range(60) if (u * p) % 3 == 0]
    rated_df = spark.createDataFrame(rated, "user_id int, product_id int")
    got = {r["user_id"]: [x["product_id"] for x in r["recs"]] for r in factorization.unrated_recs(users, items, rated_df, 4).collect()}
    for u in range(5):
        scores = {p: 1.0 + u / 7 * (p / 9 - 1) for p in range(60) if (u, p) not in rated}
        best = [p for p in sorted(scores, key=lambda p: (-scores[p], p)) if scores[p] > 0][:4]
        assert got.get(u, []) == best
    leaving = factorization.best_products(users.withColumn("depth", F.lit(4)), items, rated_df).count()
    assert leaving <= len(rated) + 4 * 5 * 6


def test_bare_payloads_and_the_trigger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("1|2|3.0|4\nx|2|3.0|4\n")
    lines = files.stream_lines(spark, str(tmp_path / "in"))
    query = log_events.write_ratings_log(lines, str(tmp_path / "r"), str(tmp_path / "c"), bare=True)
    try:  # the two-second trigger, stopped once it has taken the file
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(schemas.as_ratings(spark.read.parquet(str(tmp_path / "r")))) == [(1, 2, 3.0, 4)]
    log_events.write_quarantine(lines, str(tmp_path / "b"), str(tmp_path / "c2"), True, bare=True).awaitTermination()
    assert rows(spark.read.text(str(tmp_path / "b"))) == [("x|2|3.0|4",)]


def test_users_sign_up_rate_and_are_served(spark, tmp_path):
    store = str(tmp_path / "store")
    (tmp_path / "p.txt").write_text("".join(f"{p}^n{p}^c^e^i^a^t\n" for p in range(6)))
    (tmp_path / "r.csv").write_text("".join(f"{u},{p},{1 + (u * p) % 5},100\n" for u in (97, 98, 99) for p in range(5)))
    jobs.load(spark, str(tmp_path / "p.txt"), str(tmp_path / "r.csv"), store)
    jobs.compute_statistics(spark, store)
    jobs.train(spark, store, min_sim=0.0)
    names = spark.createDataFrame([("a", 5), ("a", 6), ("b", None)], "username string, requested_at long")
    assert jobs.signup(spark, store, names).count() == 0
    assert rows(jobs.signup(spark, store, names)) == [("a",), ("b",)]
    assert jobs.table(spark, store, jobs.USERS, schemas.USER).count() == 2
    wanted = spark.createDataFrame([("a",), ("nobody",)], "username string")
    answers = jobs.serve(spark, store, wanted, 3)  # "a" has the id 97
    assert {r["username"] for r in answers.where("product_id IS NOT NULL").collect()} == {"a"}
    asked = spark.createDataFrame([("a", 5, 10.0, 9), ("x", 1, 2.0, 9)], "username string, product_id int, score double, ts long")
    assert rows(jobs.rate(spark, store, asked).select("username")) == [("x",)]
    for query in jobs.stream(spark, store, f"{store}/{jobs.LOG}", available_now=True):
        query.awaitTermination()
    streamed = spark.read.parquet(f"{store}/{jobs.STREAM_RATINGS}")
    assert rows(schemas.as_ratings(streamed)) == [(97, 5, 5.0, 9)]
