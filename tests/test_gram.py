"""Factors from added-up normal equations against a dense fit."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from merchlens.operators import gram

RATINGS = "user_id INT, product_id INT, score DOUBLE"


def dense_fit(rows, start, iterations, reg_param):
    items = {p: np.array(v) for p, v in start.items()}
    users = {}

    def solve(mine, other):
        x = np.array([other[k] for k, _ in mine])
        r = np.array([s for _, s in mine])
        return np.linalg.solve(x.T @ x + reg_param * len(mine) * np.eye(x.shape[1]), x.T @ r)

    for _ in range(iterations):
        users = {u: solve([(p, s) for v, p, s in rows if v == u], items) for u in {u for u, _, _ in rows}}
        items = {p: solve([(u, s) for u, q, s in rows if q == p], users) for p in {p for _, p, _ in rows}}
    return users, items


@pytest.fixture(scope="module")
def rated():
    """Half of all ratings are of product 0, a fifth by user 0; some repeat."""
    rng = np.random.default_rng(2)
    rows = [(u, 0, float(rng.integers(1, 6))) for u in range(150)]
    rows += [(0, p, float(rng.integers(1, 6))) for p in range(1, 40)]
    rows += [(int(rng.integers(150)), int(rng.integers(40)), float(rng.normal())) for _ in range(150)]
    return rows + rows[:5]


@pytest.mark.parametrize("heavy", [30, 10**6])
def test_fit_equals_a_dense_one(spark, rated, heavy):
    rng = np.random.default_rng(3)
    start = {p: rng.normal(size=4) for p in range(40)}
    table = spark.createDataFrame([(p, [float(x) for x in v]) for p, v in start.items()], "product_id INT, features ARRAY<DOUBLE>")
    odd = [(None, 3, 1.0), (4, None, 1.0), (4, 4, None), (4, 4, float("nan")), (4, 4, float("inf"))]
    ratings = spark.createDataFrame(rated + odd, RATINGS).repartition(6)
    found = gram.fit_factors(ratings, 4, 3, 0.05, heavy=heavy, start=table)
    users, items = dense_fit(rated, start, 3, 0.05)
    for got, want, key in ((found.users, users, "user_id"), (found.items, items, "product_id")):
        rows = {r[key]: np.array(r["features"]) for r in got.collect()}
        assert rows.keys() == want.keys()
        assert max(np.abs(rows[k] - want[k]).max() for k in want) < 1e-6
    left = gram.gradients(spark.createDataFrame(rated, RATINGS), found, 0.05)
    assert left.count() == 40 and left.agg(F.max("gradient")).first()[0] < 1e-8


def test_heavy_ratings_are_not_shuffled(spark, rated, monkeypatch):
    """Of a heavy product only the tasks' sums leave them."""
    sent = []
    apply = gram._heavy

    def watched(rows, rank, reg_param):
        sent.append((rows.count(), apply(rows, rank, reg_param)))
        return sent[-1][1]

    monkeypatch.setattr(gram, "_heavy", watched)
    gram.fit_factors(spark.createDataFrame(rated, RATINGS).repartition(3), 3, 1, 0.1, heavy=100)
    assert [n for n, _ in sent] == [0, sum(p == 0 for _, p, _ in rated)]
    assert sent[1][1].count() == 1


def test_vectors_are_sent_once_per_block(spark, rated, monkeypatch):
    """Many ratings of one product by the users of a block need its vector there once."""
    sent, met = [], gram._met
    monkeypatch.setattr(gram, "_met", lambda blocks, *more, **kw: sent.append(blocks) or met(blocks, *more, **kw))
    gram.fit_factors(spark.createDataFrame(rated, RATINGS), 3, 1, 0.1)
    for blocks in sent:
        links = [tuple(r) for r in blocks.links.collect()]
        assert len(links) == len(set(links)) < blocks.rows.count()
    assert len(sent) == 2 and sent[0].links.where("other = 0").count() <= sent[0].count < 150


@pytest.mark.parametrize("n", [2, 5, 9])
def test_few_ratings_are_solved_in_their_own_space(n):
    rng = np.random.default_rng(n)
    x, r = rng.normal(size=(3, n, 5)), rng.normal(size=(3, n))
    for found, a, b in zip(gram.solved_rows(x, r, 0.1), x, r):
        assert np.allclose(found, np.linalg.solve(a.T @ a + 0.1 * n * np.eye(5), a.T @ b))


def test_chunks_several_penalties_and_errors(spark, rated, monkeypatch):
    """Ids that go on in the next chunk, fits side by side, and what they leave undone."""
    data = spark.createDataFrame(rated, RATINGS)
    both = gram.fit_factors(data, 4, 2, (0.05, 0.5), seed=1)
    vectors = {r["product_id"]: r["features"] for r in both.items.collect()}
    for j, reg in enumerate((0.05, 0.5)):
        one = gram.fit_factors(data, 4, 2, reg, seed=1, heavy=30)
        for r in one.items.collect():
            assert np.allclose(vectors[r["product_id"]][4 * j : 4 * j + 4], r["features"])
    users = {r["user_id"]: np.array(r["features"]) for r in both.users.collect()}
    odd = spark.createDataFrame([(1, 1, None), (999, 1, 2.0), (1, 999, 2.0), (None, 1, 1.0)], RATINGS)
    found = gram.squared_errors(data.union(odd), both, 4, 2).orderBy("fit").collect()
    for j, r in enumerate(found):
        cut = slice(4 * j, 4 * j + 4)
        want = sum((s - users[u][cut] @ np.array(vectors[p][cut])) ** 2 for u, p, s in rated)
        assert (r["fit"], r["n"]) == (j, len(rated)) and r["squares"] == pytest.approx(want)


def test_a_task_hands_on_whole_ids():
    calls = []
    task = gram._Task(0, lambda ids, *more: calls.append(ids.tolist()) or [], True)
    def batch(other):
        return pa.RecordBatch.from_arrays([pa.array(other, pa.int32()), pa.array([1.0] * len(other))], names=["other", "score"])
    task.vectors(0, np.array([4, 6], np.int32), pa.array([[1.0, 2.0], [3.0, 4.0]]))
    few, gram.CHUNK_ROWS = gram.CHUNK_ROWS, 2
    try:
        list(task.ratings(np.array([1, 2], np.int32), batch([4, 6])))
        list(task.ratings(np.array([2, 3], np.int32), batch([5, 4])))
        list(task.ratings(None))
    finally:
        gram.CHUNK_ROWS = few
    assert calls == [[1], [2], [3]]


def test_sums_in_slices(monkeypatch):
    rng = np.random.default_rng(0)
    ids = np.sort(rng.integers(0, 9, 200))
    x, r = rng.normal(size=(200, 3)), rng.normal(size=200)
    monkeypatch.setattr(gram, "SLICE_CELLS", 9 * 7)
    sums = gram.Sums(3)
    sums.add(ids, x, r)
    for i, (a, b, n) in sums.held.items():
        own = ids == i
        assert np.allclose(a, x[own].T @ x[own]) and np.allclose(b, x[own].T @ r[own]) and n == own.sum()


def test_nothing_to_fit_and_fixed_start(spark):
    none = gram.fit_factors(spark.createDataFrame([], RATINGS), 3, 2)
    assert none.users.count() == none.items.count() == 0
    ids = spark.createDataFrame([(1,), (2,)], "id INT")
    one, two = (sorted(map(tuple, gram.start_vectors(ids.repartition(n), 5, 7).collect())) for n in (1, 2))
    assert one == two and one[0][1] != one[1][1]
    many = gram.start_vectors(spark.range(4000).select(F.col("id").cast("int").alias("id")), 4, 1)
    x = np.array([r["features"] for r in many.collect()])
    assert np.abs(x.mean(axis=0)).max() < 0.05 and np.abs(x.std(axis=0) - 0.5).max() < 0.05


def test_vectors_are_not_shuffled(spark, rated, monkeypatch):
    """Every block is a task of its own, which reads the vectors where they are stored."""
    monkeypatch.setattr(gram, "BLOCK_ROWS", 50)
    found, light = [], gram._light
    monkeypatch.setattr(gram, "_light", lambda blocks, *more: found.append((blocks, light(blocks, *more))) or found[-1][1])
    gram.fit_factors(spark.createDataFrame(rated, RATINGS).repartition(3), 3, 1, 0.1)
    assert len(found) == 2
    for blocks, df in found:
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.rdd.getNumPartitions() == len(blocks.sizes) > 3
        assert blocks.rows.count() == sum(blocks.sizes.values()) == len(rated)


def test_vectors_are_kept_in_any_order():
    """Those that came before it was known which are wanted too, and none that is not."""
    task = gram._Task(0, None, False)
    task.vectors(0, np.array([9, 4], np.int32), pa.array([[9.0], [4.0]]))
    task.want(0, pa.chunked_array([[7, 4, 4], [5, None]], pa.int32()))
    task.vectors(0, np.array([7, 8], np.int32), pa.array([[7.0], [8.0]]))
    (ids, vectors), (own, _) = task.sides()
    assert ids.tolist() == [4, 7] and vectors.tolist() == [[4.0], [7.0]] and not len(own)


@pytest.mark.parametrize("heavy", [0, 2, 3, 10])
def test_heavy_ids_by_buckets(spark, heavy, monkeypatch):
    monkeypatch.setattr(gram, "BUCKETS", 3)
    rows = spark.createDataFrame([(i,) for i in range(12) for _ in range(i % 4)], "id INT")
    want = sorted(i for i in range(12) if i % 4 > heavy)
    found = gram.heavy_ids(rows, "id", heavy)
    assert want == ([] if found is None else sorted(r.id for r in found.collect()))
    assert want or found is None


def test_vectors_and_ratings_travel_in_chunks(spark, rated, monkeypatch):
    """A half round is handed rows of many vectors or ratings, none of a single one."""
    monkeypatch.setattr(gram, "CHUNK_BYTES", 400)
    seen, beside = [], gram._beside
    monkeypatch.setattr(gram, "_beside", lambda blocks, fixed, *more: seen.append((blocks, fixed)) or beside(blocks, fixed, *more))
    found = gram.fit_factors(spark.createDataFrame(rated, RATINGS).repartition(3), 4, 2, 0.1)
    assert len(seen) == 4
    for blocks, fixed in seen:
        vectors, ratings = fixed.collect(), blocks.chunks.collect()
        assert max(len(r.ids) for r in vectors) == 4 * (400 // 36) and sum(r.n for r in ratings) == len(rated)
        assert len(ratings) <= len(rated) / 20
    for (blocks, _), turned in zip(seen, (1, -1)):
        held = sorted((r.id, r.other)[::turned] for r in blocks.rows.collect())
        assert held == sorted((u, p) for u, p, _ in rated)
    users, items = found.stored_chunks()
    again = gram.from_chunks(gram.in_chunks(found.items), "product_id", np.dtype(np.float64))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.items.collect()))
    assert gram.from_chunks(users, "user_id", np.dtype(np.float64)).count() == found.users.count() == 150


def test_numbers_of_sliced_bytes():
    columns = gram._in_bytes(np.arange(5000, dtype=np.int32), np.arange(10000.0).reshape(5000, 2))
    assert len({len(c) for c in columns}) == 1 < len(columns[0])
    part = columns[1].slice(1, 2)
    width = len(columns[1][0].as_py()) // 8
    assert gram._numbers(part, np.float64).tolist() == list(range(width, 3 * width))
    assert len(gram._numbers(pa.array([], pa.binary()), np.int32)) == 0


def test_a_block_holds_no_more_than_its_bytes():
    """Each has room for its ratings and for the vectors that they may need, however they are spread."""
    rng = np.random.default_rng(1)
    load, width = gram.Load(3_000_000, 90_000, 120_000), 1000
    few = gram.BLOCK_BYTES
    try:
        gram.BLOCK_BYTES = 60_000_000
        count = load.blocks(4, width)
    finally:
        gram.BLOCK_BYTES = few
    assert 4 < count < 3_000_000 * (width + gram.ROW_BYTES) / 60_000_000
    users, items = rng.integers(90_000, size=3_000_000), rng.integers(120_000, size=3_000_000)
    needed = max(len(np.unique(items[users % count == b])) for b in range(3))
    assert 3_000_000 / count * gram.ROW_BYTES + needed * width < 1.02 * 60_000_000
    assert gram.Load(0, 1, 1).blocks(8, 200) == 1 and gram.Load(10**6, 10**5, 10**5).blocks(8, 200) == 8


def test_fits_that_need_more_blocks_together_run_one_by_one():
    small, large = gram.Load(600_000, 15_000, 20_000), gram.Load(28_800_000, 900_000, 1_200_000)
    assert gram.fits_at_once(small, 4, 1000, 8) == 4
    assert gram.fits_at_once(large, 4, 1000, 12) == 1
