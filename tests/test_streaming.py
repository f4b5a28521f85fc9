from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from helpers import rows

from merchlens import schemas
from merchlens.constants import RATING_MARKER
from merchlens.functions.ranking import unpack_recs
from merchlens.operators import ratings as rating_ops
from merchlens.operators import rerank
from merchlens.operators.similarity import similar_levels
from merchlens.session import scratch_path
from merchlens.sources import files, tables
from merchlens.streaming import log_events, recents, scorer

SIMS = "product_id INT, sim_product_id INT, sim DOUBLE"


class Pipeline:
    """Log folder, ratings table and scorer of one test."""

    def __init__(self, spark, sims, **scoring):
        self.spark, self.sims, self.scoring = spark, sims, scoring
        self.root = scratch_path(spark, "pipeline")
        self.files = 0
        Path(self.root, "log").mkdir(parents=True)

    def log(self, events, extra=()):
        lines = [f"INFO {RATING_MARKER}{u}|{p}|{s}|{t}" for u, p, s, t in events] + list(extra)
        Path(self.root, "log", f"{self.files}.log").write_text("\n".join(lines) + "\n")
        self.files += 1

    def run(self):
        lines = files.stream_lines(self.spark, f"{self.root}/log")
        log_events.write_ratings_log(
            lines, f"{self.root}/ratings", f"{self.root}/ck1", True, 4
        ).awaitTermination()
        scorer.start_scorer(
            self.spark, f"{self.root}/ratings", lambda: self.sims, f"{self.root}/recs",
            f"{self.root}/ck2", available_now=True, buckets=4, **self.scoring,
        ).awaitTermination()
        return self.current()

    def current(self):
        recs = unpack_recs(scorer.current_recs(self.spark, f"{self.root}/recs"), outer=True)
        return rows(recs)


@pytest.fixture(scope="module")
def sims(table):
    rng = np.random.default_rng(2)
    data = {}
    for a in range(30):
        for b in range(a):
            data[a, b] = data[b, a] = float(np.round(rng.uniform(0.4, 1.0), 6))
    return table([(a, b, s) for (a, b), s in data.items()], SIMS).cache()


def batch_result(table, events, sims):
    df = table(events, schemas.RATING)
    triggers = rerank.latest_triggers(df)
    recent = rating_ops.recent_ratings(df).withColumnRenamed("user_id", "trigger_id")
    scored = rerank.rerank(triggers, recent, df.select("user_id", "product_id"), sims)
    lists = rerank.rerank_lists(triggers, scored).select("user_id", "recs")
    return rows(unpack_recs(lists, outer=True))


def close(a, b):
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert [r[3] for r in a] == pytest.approx([r[3] for r in b], nan_ok=True)


def test_stream_equals_batch_over_two_runs(spark, table, sims):
    """State survives a restart; a third of the events belong to one user."""
    rng = np.random.default_rng(9)
    events = [
        (0 if rng.random() < 1 / 3 else int(rng.integers(1, 8)), int(rng.integers(30)),
         float(rng.integers(1, 6)), 1000 + t)
        for t in range(240)
    ]
    pipeline = Pipeline(spark, sims, levels=lambda: similar_levels(sims))
    pipeline.log(events[:120])
    close(pipeline.run(), batch_result(table, events[:120], sims))
    pipeline.log(events[120:])
    close(pipeline.run(), batch_result(table, events, sims))
    before = pipeline.current()
    assert pipeline.run() == before


def test_bad_lines_go_to_quarantine(spark, sims):
    pipeline = Pipeline(spark, sims)
    pipeline.log(
        [(1, 2, 4.5, 1700000000)],
        [f"x {RATING_MARKER}", f"x {RATING_MARKER}1|2|abc|5", f"x {RATING_MARKER}1|2", "plain line"],
    )
    lines = files.stream_lines(spark, f"{pipeline.root}/log")
    log_events.write_quarantine(
        lines, f"{pipeline.root}/bad", f"{pipeline.root}/ck3", True
    ).awaitTermination()
    assert rows(spark.read.text(f"{pipeline.root}/bad")) == [("",), ("1|2",), ("1|2|abc|5",)]
    pipeline.run()
    stored = spark.read.parquet(f"{pipeline.root}/ratings")
    assert rows(schemas.as_ratings(stored)) == [(1, 2, 4.5, 1700000000)]


def test_payload_stream(spark, sims):
    pipeline = Pipeline(spark, sims)
    pipeline.log([(1, 2, 4.5, 17)], [f"{RATING_MARKER}9|9|9|9", "other"])
    lines = files.stream_lines(spark, f"{pipeline.root}/log")
    log_events.write_payloads(
        lines, f"{pipeline.root}/out", f"{pipeline.root}/ck4", True
    ).awaitTermination()
    # The collector wants at least one character before the marker.
    assert rows(spark.read.text(f"{pipeline.root}/out")) == [("1|2|4.5|17",)]


def test_product_without_similars_replaces_by_an_empty_list(spark, sims):
    pipeline = Pipeline(spark, sims)
    pipeline.log([(1, 3, 5.0, 10)])
    assert pipeline.run()[0][2] is not None
    pipeline.log([(1, 999, 5.0, 11)])
    assert pipeline.run() == [(1, None, None, None)]


def test_history_counts_as_rated(spark, table, sims):
    history = table([(1, p, 3.0, 1) for p in range(29)], schemas.RATING)
    pipeline = Pipeline(spark, sims, history=lambda: tables.with_user_bucket(history))
    pipeline.log([(1, 3, 5.0, 10)])
    assert {r[2] for r in pipeline.run()} <= {29, None}


def test_compaction_keeps_the_view(spark, sims):
    pipeline = Pipeline(spark, sims)
    for t in range(3):
        pipeline.log([(t % 2, 3 + t, 5.0, 10 + t)])
        pipeline.run()
    target = scratch_path(spark, "compacted")
    scorer.compact_recs(spark, f"{pipeline.root}/recs", target, 1)
    later = scratch_path(spark, "later")
    spark.read.parquet(f"{pipeline.root}/recs/batch_id=2").write.parquet(f"{later}/batch_id=2")
    view = scorer.current_recs(spark, target, later)
    assert rows(unpack_recs(view, outer=True)) == pipeline.current()


def test_trim_keeps_the_newest_per_user(spark):
    df = spark.range(0, 5000, 1, 2).selectExpr(
        "CAST(id % 2 AS INT) AS user_id", "CAST(id AS INT) AS product_id",
        "1.0D AS score", "id AS ts",
    )
    trimmed = recents.trim_batches(df, 40)
    assert trimmed.count() <= 2 * 2 * 40
    newest = [r.ts for r in trimmed.where("user_id = 1").orderBy("ts", ascending=False).take(40)]
    assert newest == list(range(4999, 4999 - 80, -2))


def test_newest_order():
    pdf = pd.DataFrame({"user_id": 1, "ts": [5, 5, 6, 5], "product_id": [1, 2, 0, 2], "score": [1.0, 1.0, 1.0, 9.0]})
    got = recents.newest(pdf, 3)[["ts", "product_id", "score"]].values.tolist()
    assert got == [[6, 0, 1.0], [5, 2, 9.0], [5, 2, 1.0]]
