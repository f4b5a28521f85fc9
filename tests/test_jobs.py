"""The jobs one after the other over one store, from files to streamed lists."""

import numpy as np
from helpers import rows

from merchlens import schemas
from merchlens.constants import RATING_MARKER
from merchlens.functions.ranking import unpack_recs
from merchlens.operators import serving, statistics
from merchlens.plans import jobs
from merchlens.streaming import scorer


def test_store(spark, tmp_path):
    rng = np.random.default_rng(4)
    store = str(tmp_path / "store")
    (tmp_path / "products.txt").write_text(
        "".join(f"{i}^product {i}^1,2^B^http://{i}^a|b^x|y\n" for i in range(20)) + "broken^row\n"
    )
    ratings = sorted({(u, p): float(rng.integers(1, 6)) for u in range(15) for p in rng.integers(0, 20, 9)}.items())
    (tmp_path / "ratings.csv").write_text(
        "".join(f"{u},{p},{s},{1260759144 + 86400 * (u + p)}\n" for (u, p), s in ratings)
    )

    jobs.load(spark, str(tmp_path / "products.txt"), str(tmp_path / "ratings.csv"), store)
    assert jobs.table(spark, store, jobs.PRODUCTS).count() == 20
    assert jobs.table(spark, store, "bad_products").count() == 1
    stored = jobs.table(spark, store, jobs.RATINGS, schemas.RATING)
    assert stored.count() == len(ratings)

    jobs.compute_statistics(spark, store)
    counts = jobs.table(spark, store, jobs.RATE_MORE, "product_id INT, count BIGINT")
    assert rows(counts) == rows(statistics.rate_more(stored))
    recently = jobs.table(spark, store, jobs.RATE_MORE_RECENTLY)
    assert rows(recently) == rows(statistics.rate_more_recently(stored))

    jobs.train(spark, store, min_sim=0.0)
    recs = jobs.model_table(spark, store, jobs.USER_RECS, schemas.USER_RECS)
    served = serving.served_products(
        jobs.table(spark, store, jobs.PRODUCTS, schemas.PRODUCT), jobs.table(spark, store, jobs.AVERAGE)
    )
    requests = spark.createDataFrame([(3,)], "user_id INT")
    assert serving.serve_recs(requests, recs, served, "user_id", 5).count() == 5

    best = jobs.tune(spark, store, ranks=(2,), reg_params=(0.1, 1.0), iterations=2)
    assert best.count() == 1

    log = tmp_path / "log"
    log.mkdir()
    (log / "a.log").write_text(f"i {RATING_MARKER}3|5|4.5|1700000000\ni {RATING_MARKER}3|x|4.5|17\n")
    for query in jobs.stream(spark, store, str(log), available_now=True):
        query.awaitTermination()
    streamed = unpack_recs(scorer.current_recs(spark, f"{store}/{jobs.STREAM_RECS}"), outer=True)
    known = {p for (u, p), _ in ratings if u == 3} | {5}
    assert {r.user_id for r in streamed.collect()} == {3}
    assert not known & {r.product_id for r in streamed.collect()}
    assert rows(spark.read.text(f"{store}/bad_{jobs.STREAM_RATINGS}")) == [("3|x|4.5|17",)]

    jobs.merge_stream_ratings(spark, store)
    merged = jobs.table(spark, store, jobs.RATINGS, schemas.RATING)
    assert rows(merged.where("user_id = 3 AND product_id = 5")) == [(3, 5, 4.5, 1700000000)]
    assert merged.count() == len(ratings) + ((3, 5) not in dict(ratings))
