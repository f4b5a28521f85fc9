import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens.functions import expr


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "ts, scale, month",
    [(1260759144, 1000, 200912), (1260759144, 100, 197312), (0, 1000, 197001), (-1, 1000, 196912)],
)
def test_year_month(spark, ts, scale, month):
    assert one(spark, expr.year_month(F.col("ts"), scale), ts=ts) == month


def test_year_month_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, expr.year_month(F.col("ts")), ts=1259625599) == 200911
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sql_function(spark):
    expr.register_sql_functions(spark)
    assert spark.sql("SELECT changeDate(1260759144) AS m").first()["m"] == 200912


def jvm_hash(text):
    h = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_name_hash_known_value(spark):
    assert one(spark, expr.name_hash(F.col("n")), n="abc") == 96354


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=10, max_size=40
    )
)
def test_name_hash_any_text(spark, names):
    df = spark.createDataFrame([(n,) for n in names + ["", "\U0001f600x", "商品"]], "n string")
    for row in df.select("n", expr.name_hash(F.col("n")).alias("h")).collect():
        assert row.h == jvm_hash(row.n)


@pytest.mark.parametrize("score, half", [(9.0, 4.5), (4.25, 2.13), (4.245, 2.12), (-3.01, -1.51)])
def test_halve_score(spark, score, half):
    assert one(spark, expr.halve_score(F.col("s")), s=score) == half


@pytest.mark.parametrize(
    "line, payload",
    [
        ("x PRODUCT_RATING_PREFIX:1|2|4.5|1700000000 ", "1|2|4.5|1700000000"),
        ("x PRODUCT_RATING_PREFIX:\t1|2|4.5|17\r", "1|2|4.5|17"),
        ("x PRODUCT_RATING_PREFIX:1|2PRODUCT_RATING_PREFIX:3|4", "1|2"),
        ("x PRODUCT_RATING_PREFIX:", ""),
    ],
)
def test_rating_payload(spark, line, payload):
    assert one(spark, expr.rating_payload(F.col("v")), v=line) == payload


def test_event_line(spark):
    columns = [F.col(c) for c in "upst"]
    line = one(spark, expr.event_line(*columns), u=1, p=2, s=4.5, t=1700000000)
    assert line == "PRODUCT_RATING_PREFIX:1|2|4.5|1700000000"


def test_cosine(spark, table):
    df = table(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>"
    )
    got = [r.c for r in df.select(expr.cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got[0] == pytest.approx(math.sqrt(0.5))
    assert got[1] is None


def test_recode_query(spark):
    text = "鼠标"
    garbled = text.encode("utf-8").decode("latin-1")
    assert one(spark, expr.recode_query(F.col("q")), q=garbled) == text
