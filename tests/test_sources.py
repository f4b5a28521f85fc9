import pytest
from helpers import rows
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.session import scratch_path
from merchlens.sources import files, tables, topics


def test_product_file(spark, tmp_path):
    (tmp_path / "p.txt").write_bytes(
        '7^A "quoted" name ^1,2^B00^http://x/y.jpg^a|b^t1|t2|t3\r\n'
        "8^商品^1,2^B01^http://z^外设|鼠标^好用\r\n"
        "x^bad id^1^B^u^c^t\r\n"
        "9^too short^1\r\n".encode()
    )
    good, bad = files.scan_product_file(spark, str(tmp_path / "p.txt"))
    assert rows(good) == [
        (7, 'A "quoted" name', "http://x/y.jpg", "a|b", "t1|t2|t3"),
        (8, "商品", "http://z", "外设|鼠标", "好用"),
    ]
    assert bad.count() == 2
    lists = schemas.with_product_lists(good).where("product_id = 7").first()
    assert lists.category_list == ["a", "b"] and lists.tag_list == ["t1", "t2", "t3"]


def test_rating_file(spark, tmp_path):
    (tmp_path / "r.csv").write_text("1,2,4.5,1260759144\n1,x,4,5\n3,4,NaN,5\n5,6,1e0,1260759144000\n")
    good, bad = files.scan_rating_file(spark, str(tmp_path / "r.csv"))
    assert rows(good) == [(1, 2, 4.5, 1260759144)]
    assert bad.count() == 3  # no file of seconds has a time in the year 41920
    good, bad = files.scan_rating_file(spark, str(tmp_path / "r.csv"), unit="ms")
    assert rows(good) == [(1, 2, 4.5, 1260759), (5, 6, 1.0, 1260759144)]


@pytest.mark.parametrize(
    "text, ok",
    [("4.5", 1), (" 4 ", 1), (".5", 1), ("5.", 1), ("-1e2", 1), ("", 0), ("e5", 0), ("4,5", 0), ("Infinity", 0)],
)
def test_score_text(spark, table, text, ok):
    raw = table([("1", "2", text, "3")], schemas.RATING_FILE)
    good, bad = files.split_ratings_text(raw)
    assert (good.count(), bad.count()) == (ok, 1 - ok)


def test_read_table_prunes_and_casts(spark):
    path = scratch_path(spark, "t")
    tables.overwrite(spark.range(3).select("id", F.lit("x").alias("unused")), path)
    df = tables.read_table(spark, path, "id INT")
    assert df.dtypes == [("id", "int")]
    assert "unused" not in df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_table_joins_without_shuffling_it(spark, table):
    ratings = table([(u, u + 1, 3.0, 5) for u in range(50)], schemas.RATING)
    path = scratch_path(spark, "b")
    stored = tables.save_bucketed(ratings, "bucketed_test", "user_id", 4, path)
    users = stored.select("user_id").distinct()
    assert "Exchange" not in users._jdf.queryExecution().executedPlan().toString()
    assert users.count() == 50
    spark.sql("DROP TABLE bucketed_test")


def test_ratings_of_reads_touched_partitions(spark, table):
    ratings = table([(u, p, 3.0, 5) for u in range(40) for p in range(3)], schemas.RATING)
    path = scratch_path(spark, "r")
    tables.overwrite(tables.with_user_bucket(ratings, 16), path, "user_bucket")
    users = table([(3,), (4,)], "user_id INT")
    found = tables.ratings_of(spark.read.parquet(path), users, 16)
    assert rows(found.select("user_id", "product_id")) == [(u, p) for u in (3, 4) for p in range(3)]
    assert "PartitionFilters: [isnotnull" in found._jdf.queryExecution().executedPlan().toString() or (
        "user_bucket" in found._jdf.queryExecution().executedPlan().toString()
    )


def test_merge_is_idempotent(spark, table):
    base = table([(1, 2, 3.0, 1), (9, 9, 1.0, 1)], schemas.RATING)
    path = scratch_path(spark, "m")
    tables.overwrite(tables.with_user_bucket(base, 4), path, "user_bucket")
    updates = table([(1, 2, 5.0, 2), (1, 3, 4.0, 2)], schemas.RATING)
    expected = [(1, 2, 5.0, 2), (1, 3, 4.0, 2), (9, 9, 1.0, 1)]
    for _ in range(2):
        tables.merge_ratings(spark, path, updates, 4)
        assert rows(tables.read_table(spark, path, schemas.RATING)) == expected


def test_message_encoding(spark, table):
    lines = table([("17|2|3.0|4",)], "value STRING")
    message = topics.encode_messages(lines).first()
    assert bytes(message.key) == b"17" and bytes(message.value) == b"17|2|3.0|4"
    assert rows(topics.decode_values(topics.encode_messages(lines))) == [("17|2|3.0|4",)]


def rows_scanned(df):
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_lookups_pass_over_row_groups(spark, tmp_path):
    many = spark.range(20_000).selectExpr("CAST(id * 7919 % 20011 AS INT) AS product_id", "repeat('x', 200) AS name")
    tables.save_sorted(many, str(tmp_path / "p"), "product_id", files=4, block_bytes=1 << 16)
    table = spark.read.parquet(str(tmp_path / "p"))
    assert table.count() == 20_000
    held = [r[0] for r in many.limit(3).collect()]
    few = table.where(F.col("product_id").isin(held))
    assert few.count() == 3 and rows_scanned(few) <= 0.5 * 20_000
    asked = spark.createDataFrame([(k,) for k in [*held, held[0], None, -5]], "product_id INT")
    for most in (2, 100):
        assert sorted(r[0] for r in tables.lookup(table, asked, "product_id", most).collect()) == sorted(held)
    assert tables.lookup(table, asked.where("false"), "product_id").count() == 0
