"""Explicit-feedback factors from normal equations that are added up, not gathered.

One side's vectors are solved from the other's. Light users (or products) are cut into
blocks, whose ratings are dealt out once and stored. A round writes a vector once; a block's
task reads the stored vectors past it and keeps those that its ratings need, so no vector is
shuffled. Both travel in chunks, rows that hold the bytes of many ids and numbers: Spark hands
them on as they are instead of number by number. A heavy one, with more ratings than a task should hold, is never gathered: every task adds up its
own share, and only these sums, one matrix per task, meet. So no task holds all ratings of a
product, and none of a heavy one's ratings is shuffled for it.
"""

import functools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructType

from merchlens import constants
from merchlens.session import read_stored, scratch_path

#: Ratings from which on a user or product is heavy.
HEAVY = 100_000
#: Heavy ones whose sums a task holds at once; more are handed on in turn.
HELD = 512
#: Numbers in a slice of outer products.
SLICE_CELLS = 4_000_000
#: Bytes of a block's ratings and of the vectors that they may need, and about those of a rating.
BLOCK_BYTES, ROW_BYTES = 700_000_000, 40
#: Ratings that a block has at least, if there is more than one.
BLOCK_ROWS = 20_000
#: Parts in which ratings are counted before their ids are.
BUCKETS = 65_536
#: Ratings of a block that are solved at once.
CHUNK_ROWS = 100_000
#: Bytes of a chunk: far below what a batch of rows may hold, far above what a row costs.
CHUNK_BYTES = 16_384
#: Vectors in chunks, of numbers of ``size`` bytes; ratings in chunks.
VECTOR_CHUNKS = "ids binary, features binary, size int"
RATING_CHUNKS = "block int, ids binary, others binary, scores binary, n int"


class Factors(NamedTuple):
    """``user_id, features`` and ``product_id, features``."""

    users: DataFrame
    items: DataFrame

    def stored_chunks(self) -> tuple[DataFrame, DataFrame]:
        return tuple(read_stored(in_chunks(side), "chunks") for side in self)


class Fitted(Factors):
    """Factors of a fit, which has stored them in chunks."""

    chunks: tuple[DataFrame, DataFrame]

    def stored_chunks(self) -> tuple[DataFrame, DataFrame]:
        return self.chunks


def with_chunks(users: DataFrame, items: DataFrame, chunks: tuple[DataFrame, DataFrame]) -> Fitted:
    factors = Fitted(users, items)
    factors.chunks = chunks
    return factors


class Sums:
    """Normal equations of several ids: Gram matrix, right side and number of ratings."""

    def __init__(self, rank: int):
        self.rank = rank
        self.held: dict[int, list] = {}

    def add(self, ids: np.ndarray, vectors: np.ndarray, scores: np.ndarray) -> None:
        """Add rows whose equal ids stand together."""
        step = max(1, SLICE_CELLS // self.rank**2)
        for a in range(0, len(ids), step):
            own, x, r = ids[a : a + step], vectors[a : a + step], scores[a : a + step]
            begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            gram = np.add.reduceat(x[:, :, None] * x[:, None, :], begin, axis=0)
            right = np.add.reduceat(x * r[:, None], begin, axis=0)
            n = np.diff(np.append(begin, len(own)))
            for k, i in enumerate(own[begin].tolist()):
                self.add_sums(i, gram[k], right[k], int(n[k]))

    def add_sums(self, i: int, gram: np.ndarray, right: np.ndarray, n: int) -> None:
        if i in self.held:
            before = self.held[i]
            self.held[i] = [before[0] + gram, before[1] + right, before[2] + n]
        else:
            self.held[i] = [gram, right, n]

    def taken(self, ids: list[int] | None = None) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Ids with their sums, which are then forgotten; of all if none are named."""
        ids = list(self.held) if ids is None else ids
        parts = [self.held.pop(i) for i in ids]
        gram = np.array([p[0] for p in parts]).reshape(-1, self.rank, self.rank)
        right = np.array([p[1] for p in parts]).reshape(-1, self.rank)
        return ids, gram, right, np.array([p[2] for p in parts], np.int64)


def solved(gram: np.ndarray, right: np.ndarray, n: np.ndarray, reg_param: float) -> np.ndarray:
    """The vectors that least squares with a penalty per rating asks for."""
    rank = gram.shape[1]
    ridge = gram + (reg_param * n)[:, None, None] * np.eye(rank)
    if reg_param > 0:
        return np.linalg.solve(ridge, right[:, :, None])[:, :, 0]
    return np.stack([np.linalg.lstsq(a, b, rcond=None)[0] for a, b in zip(ridge, right)]) if len(n) else right


def _matrix(column: pa.Array, rank: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, rank)


def _in_bytes(*columns: np.ndarray) -> list[pa.Array]:
    """The columns cut alike into rows of about ``CHUNK_BYTES``."""
    columns = [np.ascontiguousarray(c) for c in columns]
    n, widths = len(columns[0]), [c.nbytes // len(c) for c in columns]
    cuts = np.append(np.arange(0, n, max(1, CHUNK_BYTES // sum(widths))), n)
    return [
        pa.Array.from_buffers(
            pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(c)]
        )
        for c, width in zip(columns, widths)
    ]


def _numbers(column: pa.Array, kind) -> np.ndarray:
    """The numbers of all rows of a column of bytes, one after the other."""
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, end = (int(places[column.offset + k]) for k in (0, len(column)))
    return np.frombuffer(data, kind, (end - first) // np.dtype(kind).itemsize, first) if end > first else np.empty(0, kind)


def _vector_chunks(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    found = _in_bytes(ids.astype(np.int32), vectors)
    return pa.RecordBatch.from_arrays(
        [*found, pa.array(np.full(len(found[0]), vectors.itemsize, np.int32))], names=["ids", "features", "size"]
    )


def _number_type(side: DataFrame) -> np.dtype:
    return np.dtype(np.float32 if side.schema["features"].dataType.elementType == FloatType() else np.float64)


def in_chunks(side: DataFrame) -> DataFrame:
    """``VECTOR_CHUNKS`` of an id, the first column, and ``features``; without null ids."""
    kind = _number_type(side)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield _vector_chunks(batch.column("id").to_numpy(), rows.astype(kind, copy=False))

    named = side.select(F.col(side.columns[0]).cast("int").alias("id"), "features")
    return named.where("id IS NOT NULL").mapInArrow(pack, VECTOR_CHUNKS)


def from_chunks(chunks: DataFrame, key: str, kind: np.dtype) -> DataFrame:
    """``key, features`` of vectors in chunks."""
    number = FloatType() if kind == np.float32 else DoubleType()
    schema = StructType().add(key, IntegerType()).add("features", ArrayType(number))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, flat = _numbers(batch.column("ids"), np.int32), _numbers(batch.column("features"), kind)
                yield pa.RecordBatch.from_arrays(_vectors(ids, flat.reshape(len(ids), -1)).columns, names=[key, "features"])

    return chunks.mapInArrow(unpack, schema)


def _vectors(ids, vectors: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    lists = pa.ListArray.from_arrays(offsets, pa.array(vectors.reshape(-1)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), lists], names=["id", "features"])


class Blocks(NamedTuple):
    """Ratings dealt to blocks by one side: the stored ``rows`` (``id, other, score, block``),
    how many each block has if it has some, and the number of blocks; where scores are plain
    numbers also the stored ``RATING_CHUNKS`` that the rows are read from."""

    rows: DataFrame
    sizes: dict[int, int]
    count: int
    chunks: DataFrame | None = None

    @property
    def links(self) -> DataFrame:
        """The distinct ``block, other``: the vectors that the blocks need."""
        return self.rows.select("block", "other").distinct()


def _block(key: str, count: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("int")), F.lit(count)).cast("int")


class Load(NamedTuple):
    """How much a fit's blocks have to hold: ratings and, about, users and products."""

    rows: int
    users: int
    items: int

    def turned(self) -> "Load":
        return Load(self.rows, self.items, self.users)

    def blocks(self, cores: int, width: int, own: bool = False) -> int:
        """Blocks of users that keep to ``BLOCK_BYTES`` with ``width`` bytes for each vector.

        No more than one for a core while they are that small: each reads all vectors. A
        product of ``d`` ratings is needed by a block of ``count`` with a chance of at most
        ``1 - (1 - 1/count)^d``; for their mean ``d`` the sum of the chances is greatest.
        """

        def held(count: int) -> float:
            needed = self.items if count == 1 else -self.items * math.expm1(self.rows / self.items * math.log1p(-1 / count))
            return (self.rows * ROW_BYTES + own * self.users * width) / count + needed * width

        count = max(1, min(cores, self.rows // BLOCK_ROWS))
        while self.rows and held(count) > BLOCK_BYTES:
            count += max(1, count // 32)
        return count


def load_of(rows: DataFrame) -> Load:
    """Of ``user_id, product_id``: distinct ids are counted with an error of some hundredths."""
    distinct = [F.approx_count_distinct(c, 0.02).alias(c) for c in ("user_id", "product_id")]
    found = rows.agg(F.count("*").alias("n"), *distinct).first()
    # Not fewer than there are by the counts' error, which is rarely thrice its mean.
    users, items = (max(1, min(found["n"], math.ceil(1.06 * found[c]))) for c in ("user_id", "product_id"))
    return Load(found["n"], users, items)


def fits_at_once(load: Load, fits: int, width: int, cores: int) -> int:
    """As many fits, whose vectors of ``width`` bytes then stand one after the other, as need the
    fewest blocks: every block reads all vectors, so more blocks read more for the same fits."""

    def most(n: int) -> int:
        return max(side.blocks(cores, n * width) for side in (load, load.turned()))

    return min(range(1, fits + 1), key=lambda n: (most(n), -n))


def blocks_of(rows: DataFrame, key: str, other: str, count: int, score: str = "score") -> Blocks:
    """Ratings dealt to so many blocks by ``key``."""
    spark = rows.sparkSession
    path = scratch_path(spark, f"blocks-{key}")
    dealt = _dealt(rows, key, other, count, score).sortWithinPartitions("block", "id")
    dealt.write.partitionBy("block").parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    sizes = {r["block"]: r["n"] for r in stored.groupBy("block").agg(F.count("*").alias("n")).collect()}
    return Blocks(stored, sizes, count)


def blocks_in_chunks(rows: DataFrame, key: str, other: str, count: int) -> Blocks:
    """``blocks_of`` ratings whose scores are numbers and not null, stored in chunks."""
    spark = rows.sparkSession
    path = scratch_path(spark, f"blocks-{key}")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            columns = [batch.column(c).to_numpy() for c in ("id", "other", "score")]
            for block in np.unique(blocks).tolist():
                own = slice(None) if (blocks == block).all() else blocks == block
                held.setdefault(block, []).append([c[own] for c in columns])
        for block in list(held):
            columns = [np.concatenate(c) for c in zip(*held.pop(block))]
            order = np.argsort(columns[0], kind="stable")
            for start in range(0, len(order), 10 * CHUNK_ROWS):
                yield _rating_chunks(block, *(c[order[start : start + 10 * CHUNK_ROWS]] for c in columns))

    # A block is sorted where it is packed, all at once: it is no more than a task may hold.
    chunks = _dealt(rows, key, other, count, "score").mapInArrow(pack, RATING_CHUNKS)
    chunks.write.partitionBy("block").parquet(path)
    stored = spark.read.schema(chunks.schema).parquet(path)
    sizes = {r["block"]: r["n"] for r in stored.groupBy("block").agg(F.sum("n").alias("n")).collect()}

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, others, scores = _ratings(batch)
            block = np.repeat(batch.column("block").to_numpy(), batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([ids, others, scores, block], names=["id", "other", "score", "block"])

    return Blocks(stored.mapInArrow(unpack, "id int, other int, score double, block int"), sizes, count, stored)


def _dealt(rows: DataFrame, key: str, other: str, count: int, score: str) -> DataFrame:
    rows = rows.select(
        F.col(key).cast("int").alias("id"), F.col(other).cast("int").alias("other"), F.col(score).alias("score"),
        _block(key, count).alias("block"),
    )
    return rows.repartitionById(count, "block")


def _rating_chunks(block: int, ids: np.ndarray, others: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    found = _in_bytes(ids.astype(np.int32), others.astype(np.int32), scores.astype(np.float64))
    n = np.diff(np.frombuffer(found[0].buffers()[1], np.int32)) // 4
    columns = [pa.array(np.full(len(n), block, np.int32)), *found, pa.array(n.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "others", "scores", "n"])


def _ratings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(_numbers(batch.column(c), k) for c, k in (("ids", np.int32), ("others", np.int32), ("scores", np.float64)))


def _met(
    blocks: Blocks, fixed: DataFrame, own: DataFrame | None, work: Callable[[], Callable], schema: str, whole: bool = False
) -> DataFrame:
    """What ``work`` makes of every block's ratings and the vectors that they need.

    ``fixed`` and ``own`` are chunks: vectors of the other side and, if the work
    asks for them, of the blocks' own ids. Ratings without a vector are left out. For every
    block ``work()`` gives a function of ratings sorted by id: ids, places among the other
    side's vectors, these vectors, places among the own vectors, these, scores and which of
    the scores are not null. With ``whole`` all ratings of an id come in one call.
    """

    def meet(task: _Task, held: pa.Table) -> Iterator[pa.RecordBatch]:
        for some in held.to_batches(CHUNK_ROWS):
            yield from task.ratings(some.column("id").to_numpy(), some)
        yield from task.ratings(None)

    return _beside(blocks, fixed, own, lambda: _Task(None, work(), whole), meet, schema)


def _beside(
    blocks: Blocks, fixed: DataFrame, own: DataFrame | None, task_of: Callable, meet: Callable, schema: str | StructType
) -> DataFrame:
    """What ``meet`` makes of each block's task, which knows its vectors, and its ratings by id.

    A block is one task, which reads its ratings and then, without a shuffle, all stored
    vectors of ``fixed``, of which it keeps what it needs; ``own`` likewise.
    """
    sizes, whole = blocks.sizes, blocks.chunks is None
    source = blocks.rows if whole else blocks.chunks
    # Ratings are chunks or, with scores of another kind, plain rows; both have all columns.
    empty = {c: F.lit(None).cast("binary") for c in ("ids", "features", "others", "scores")} | {"size": F.lit(None).cast("int")}
    if whole:
        empty |= {c: F.lit(None).cast(blocks.rows.schema[c].dataType) for c in ("id", "other", "score")}

    def alike(side: DataFrame, number: int) -> DataFrame:
        columns = [F.col(c) if c in side.columns else none.alias(c) for c, none in empty.items()]
        block = F.col("block") if "block" in side.columns else F.lit(None).cast("int").alias("block")
        return side.select(F.lit(number).alias("kind"), block, *columns)

    rows, others = alike(source, 2), alike(fixed, 0)
    if own is not None:
        others = others.union(alike(own, 1))
    # Spark unites children of one partition each in one task; a child with none keeps them apart.
    parts = [rows.where("block = -1")]
    parts += [rows.where(f"block = {block}").union(others).coalesce(1) for block in sorted(sizes)]

    def rated(some: pa.RecordBatch) -> pa.RecordBatch:
        columns = some.select(["id", "other", "score"]).columns if whole else _ratings(some)
        return pa.RecordBatch.from_arrays([*columns], names=["id", "other", "score"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, left = task_of(), [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = batch.column("kind").to_numpy()
            cuts = (np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, len(kinds)]):
                some = batch.slice(start, end - start)
                if kinds[start] < 2:
                    ids, size = _numbers(some.column("ids"), np.int32), some.column("size")[0].as_py()
                    flat = _numbers(some.column("features"), np.dtype(f"f{size}"))
                    task.vectors(int(kinds[start]), ids, flat.reshape(len(ids), -1))
                    continue
                if left is None:
                    task.block = some.column("block")[0].as_py()
                    left = sizes[task.block]
                held.append(rated(some))
                left -= held[-1].num_rows
                if not left:
                    held = pa.Table.from_batches(held)
                    task.want(0, held["other"])
                    task.want(1, held["id"])
        if left is None:
            return
        ids = held["id"].to_numpy()
        if (ids[1:] < ids[:-1]).any():
            held = held.take(pa.array(np.argsort(ids, kind="stable")))
        yield from meet(task, held.combine_chunks())

    return functools.reduce(DataFrame.union, parts).mapInArrow(gathered, schema)


class _Task:
    """One block inside a task: its vectors, and the ratings that wait for their id's last."""

    def __init__(self, block: int | None, work: Callable | None, whole: bool):
        self.block, self.work, self.whole = block, work, whole
        self.early: list[list] = [[], []]
        self.wanted: list[np.ndarray | None] = [None, None]
        self.kept: list[np.ndarray | None] = [None, None]
        self.have: list[np.ndarray | None] = [None, None]
        self.known: list[tuple[np.ndarray, np.ndarray]] | None = None
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def vectors(self, kind: int, ids: np.ndarray, rows: np.ndarray | pa.Array) -> None:
        """Vectors in any order; until it is known which are wanted, all wait."""
        if isinstance(rows, pa.Array):
            rows = rows.flatten().to_numpy().reshape(len(ids), -1)
        if self.wanted[kind] is None:
            self.early[kind].append((ids, rows))
        else:
            self._keep(kind, ids, rows)

    def want(self, kind: int, ids: pa.ChunkedArray) -> None:
        """From now on only the vectors of these ids are kept."""
        wanted = np.sort(ids.unique().drop_null().to_numpy())
        self.wanted[kind], self.have[kind] = wanted, np.zeros(len(wanted), bool)
        early, self.early[kind] = self.early[kind], []
        for ids, rows in early:
            self._keep(kind, ids, rows)

    def _keep(self, kind: int, ids: np.ndarray, rows: np.ndarray) -> None:
        wanted = self.wanted[kind]
        if self.kept[kind] is None:
            self.kept[kind] = np.empty((len(wanted), rows.shape[1]), rows.dtype)
        place, found = _found(wanted, ids)
        self.kept[kind][place[found]] = rows[found]
        self.have[kind][place[found]] = True

    def _known(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted ids of a side that have vectors, and these."""
        if self.wanted[kind] is None:
            self.want(kind, pa.chunked_array([pa.array(ids) for ids, _ in self.early[kind]], pa.int32()))
        if self.kept[kind] is None:
            return np.empty(0, np.int32), np.empty((0, 1))
        have = self.have[kind]
        return (self.wanted[kind], self.kept[kind]) if have.all() else (self.wanted[kind][have], self.kept[kind][have])

    def sides(self) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.known is None:
            self.known = [self._known(kind) for kind in (0, 1)]
        return self.known

    def ratings(self, ids: np.ndarray | None, batch: pa.RecordBatch | None = None) -> Iterator[pa.RecordBatch]:
        if batch is not None:
            score = batch.column("score")
            self.waiting.append((
                ids, batch.column("other").to_numpy(),
                score.to_numpy(zero_copy_only=False), score.is_valid().to_numpy(zero_copy_only=False),
            ))
            self.n += batch.num_rows
            if self.n < CHUNK_ROWS:
                return
        if not self.waiting:
            return
        ids, other, score, valid = (np.concatenate(c) for c in zip(*self.waiting))
        # The last id may go on in the next batch.
        end = int(np.searchsorted(ids, ids[-1])) if batch is not None and self.whole else len(ids)
        rest = slice(end, None)
        self.waiting = [(ids[rest], other[rest], score[rest], valid[rest])] if end < len(ids) else []
        self.n = len(ids) - end
        ids, other, score, valid = ids[:end], other[:end], score[:end], valid[:end]
        (fixed_ids, fixed), (own_ids, own) = self.sides()
        place, have = _found(fixed_ids, other)
        mine, also = _found(own_ids, ids) if len(own_ids) else (np.zeros(len(ids), np.int64), np.ones(len(ids), bool))
        keep = have & also
        if keep.any():
            yield from self.work(ids[keep], place[keep], fixed, mine[keep], own, score[keep], valid[keep])


def _found(sorted_ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.searchsorted(sorted_ids, wanted)
    place[place == len(sorted_ids)] = 0
    have = sorted_ids[place] == wanted if len(sorted_ids) else np.zeros(len(wanted), bool)
    return place, have


def solved_rows(x: np.ndarray, r: np.ndarray, reg_param: float) -> np.ndarray:
    """Vectors of ids with the same number of ratings: ``x`` is ids by ratings by rank.

    With fewer ratings than numbers in a vector the penalised equations are solved in the
    ratings' own space, which gives the same vector from a smaller matrix.
    """
    ids, n, rank = x.shape
    across = x.transpose(0, 2, 1)
    if n < rank and reg_param > 0:
        weights = np.linalg.solve(x @ across + reg_param * n * np.eye(n), r[:, :, None])
        return (across @ weights)[:, :, 0]
    right = (across @ r[:, :, None])[:, :, 0]
    return solved(across @ x, right, np.full(ids, n), reg_param)


def solved_runs(ids, place, vectors, score, rank: int, reg_params: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors, one of ``rank`` numbers after the other per penalty."""
    begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    n = np.diff(np.append(begin, len(ids)))
    found = np.empty((len(begin), rank * len(reg_params)))
    for k in np.unique(n):
        same = np.flatnonzero(n == k)
        step = max(1, SLICE_CELLS // int(k * found.shape[1]))
        for a in range(0, len(same), step):
            some = same[a : a + step]
            rows = begin[some][:, None] + np.arange(k)
            x, r = vectors[place[rows]].astype(np.float64), score[rows]
            for j, reg_param in enumerate(reg_params):
                cut = slice(j * rank, (j + 1) * rank)
                found[some, cut] = solved_rows(x[:, :, cut], r, reg_param)
    return ids[begin], found


def _light(blocks: Blocks, fixed: DataFrame, rank: int, reg_params: tuple[float, ...]) -> DataFrame:
    """Chunks of the vectors of ids whose ratings fit into a task, of the fixed ones' numbers."""

    def work():
        def solve(ids, place, vectors, mine, own, score, valid):
            found, rows = solved_runs(ids, place, vectors, score, rank, reg_params)
            yield _vector_chunks(found, rows.astype(vectors.dtype, copy=False))

        return solve

    return _met(blocks, fixed, None, work, VECTOR_CHUNKS, whole=True)


def _heavy(rows: DataFrame, rank: int, reg_param: float) -> DataFrame:
    """``id, features`` of ids with very many ratings, from every task's sums."""
    schema = pa.schema([("id", pa.int32()), ("gram", pa.list_(pa.float64())), ("n", pa.int64())])

    def flushed(sums: Sums) -> pa.RecordBatch:
        ids, gram, right, n = sums.taken()
        flat = np.concatenate([gram.reshape(len(ids), -1), right], axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(list(flat), pa.list_(pa.float64())), pa.array(n)], schema=schema
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(rank)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            vectors = _matrix(batch.column("features"), rank)[order]
            sums.add(ids[order], vectors, batch.column("score").to_numpy()[order])
            if len(sums.held) > HELD:
                yield flushed(sums)
        if sums.held:
            yield flushed(sums)

    def solve(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(rank)
        for batch in batches:
            flat = _matrix(batch.column("gram"), rank * rank + rank)
            for row, n in zip(flat, batch.column("n").to_pylist()):
                sums.add_sums(key[0].as_py(), row[: rank * rank].reshape(rank, rank), row[rank * rank :], n)
        ids, *parts = sums.taken()
        yield _vectors(ids, solved(*parts, reg_param))

    partial = rows.mapInArrow(add, "id int, gram array<double>, n bigint")
    return partial.groupBy("id").applyInArrow(solve, "id int, features array<double>")


def start_vectors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """``id, features``: short random vectors that depend on nothing but id and seed."""

    def part(k: int) -> Column:
        """A number of about normal law from twelve even ones."""
        draws = [F.pmod(F.xxhash64("id", F.lit(seed * 1_000_003 + k), F.lit(j)), F.lit(1 << 30)) for j in range(12)]
        return (sum(draws[1:], draws[0]) / F.lit(float(1 << 30)) - F.lit(6.0)) / F.lit(rank**0.5)

    return ids.select("id", F.array(*[part(k) for k in range(rank)]).alias("features"))


def half_step(
    rated: DataFrame, key: str, fixed: DataFrame, fixed_key: str, rank: int, reg_param, blocks: Blocks, kind: np.dtype
) -> DataFrame:
    """The stored chunks of one side's vectors, given the other's, both of numbers of ``kind``.

    ``rated`` has ``user_id, product_id, score`` and, for each side, whether the row's user
    or product is heavy; ``blocks`` the rows whose ``key`` is not heavy. ``reg_param`` is one
    penalty or several, whose vectors then stand one after the other in ``features``.
    """
    reg_params = reg_param if isinstance(reg_param, tuple) else (reg_param,)
    light = _light(blocks, fixed, rank, reg_params)
    vectors = from_chunks(fixed, fixed_key, kind)
    rows = rated.where(f"heavy_{key}").join(vectors, fixed_key).select(F.col(key).alias("id"), "score", "features")
    cuts = [F.slice("features", j * rank + 1, rank).alias("features") for j in range(len(reg_params))]
    heavy = [_heavy(rows.select("id", "score", cut), rank, x) for cut, x in zip(cuts, reg_params)]
    joined = heavy[0]
    for more in heavy[1:]:
        both = joined.join(more.withColumnRenamed("features", "_more"), "id")
        joined = both.select("id", F.concat("features", "_more").alias("features"))
    joined = joined.select("id", F.col("features").cast(vectors.schema["features"].dataType))
    return read_stored(light.union(in_chunks(joined)), f"factors-{key}")


def heavy_ids(rows: DataFrame, key: str, heavy: int) -> DataFrame | None:
    """``key`` of those with more than ``heavy`` rows, stored; None where there are none.

    Only a bucket with that many rows can hold one, so ids are counted in such buckets only.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("_bucket")
    full = read_stored(rows.groupBy(bucket).agg(F.count("*").alias("_n")).where(F.col("_n") > heavy), f"full-{key}")
    if full.isEmpty():
        return None
    near = rows.select(key, bucket).join(F.broadcast(full.select("_bucket")), "_bucket", "left_semi")
    many = near.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > heavy)
    many = read_stored(many.select(key), f"heavy-{key}")
    return None if many.isEmpty() else many


class Dealt(NamedTuple):
    """A fit's ratings, stored once: those of heavy users and products by the key that is
    heavy, and the others' blocks."""

    rated: DataFrame
    heavy: dict[str, DataFrame]
    by_user: Blocks
    by_item: Blocks


def ratings_to_fit(ratings: DataFrame) -> DataFrame:
    """The stored ``user_id, product_id, score`` that a fit goes by, scores in double precision."""
    good = F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < float("inf"))
    rows = ratings.select("user_id", "product_id", F.col("score").cast("double").alias("score"))
    return read_stored(rows.where(good & F.col("user_id").isNotNull() & F.col("product_id").isNotNull()), "rated")


def deal(rows: DataFrame, load: Load, width: int, heavy: int = HEAVY) -> Dealt:
    """``ratings_to_fit`` dealt to blocks for vectors of ``width`` bytes."""
    flagged, some = rows, {}
    for key in ("user_id", "product_id"):
        some[key] = many = heavy_ids(rows, key, heavy)
        if many is not None:
            flagged = flagged.join(many.withColumn(f"heavy_{key}", F.lit(True)), key, "left")
        else:
            flagged = flagged.withColumn(f"heavy_{key}", F.lit(False))
        flagged = flagged.withColumn(f"heavy_{key}", F.coalesce(f"heavy_{key}", F.lit(False)))
    rated = flagged if set(some.values()) == {None} else read_stored(flagged, "flagged")
    by_user, by_item = (
        blocks_in_chunks(rated.where(f"NOT heavy_{key}"), key, other, one.blocks(cores_of(rows), width))
        for key, other, one in (("user_id", "product_id", load), ("product_id", "user_id", load.turned()))
    )
    # Where none is heavy, nothing is joined: the vectors would be shuffled for no row.
    of = {key: rated.limit(0) if many is None else rated for key, many in some.items()}
    return Dealt(rated, of, by_user, by_item)


def fit_factors(
    ratings: DataFrame | Dealt,
    rank: int = constants.ALS_RANK,
    iterations: int = constants.ALS_ITERATIONS,
    reg_param: float | tuple[float, ...] = constants.ALS_REGULARISATION,
    seed: int = 0,
    heavy: int = HEAVY,
    start: DataFrame | None = None,
) -> Factors:
    """Alternating least squares on ``user_id, product_id, score``; penalty per rating.

    Each round solves the users from the products, then the products from the users.
    Products begin with ``start`` (``product_id, features``) or with short random vectors.
    Rows with a null id or a score that is null or not finite are left out; rows that
    repeat a user and a product all count. Both sides' vectors are stored after each half
    round, so a lost executor repeats one half at most. No ratings give no vectors. With
    several penalties all are fitted in one go, from the same start. Vectors are kept in the
    precision of ``start``; sums are made in double precision. Ratings that are dealt already
    may be fitted more than once.
    """
    times = len(reg_param) if isinstance(reg_param, tuple) else 1
    rows = ratings.rated if isinstance(ratings, Dealt) else ratings_to_fit(ratings)
    if start is None:
        ids = rows.select(F.col("product_id").alias("id")).distinct()
        start = start_vectors(ids, rank, seed).withColumnRenamed("id", "product_id")
    kind = _number_type(start)
    dealt = ratings if isinstance(ratings, Dealt) else deal(rows, load_of(rows), rank * times * kind.itemsize, heavy)
    features = F.flatten(F.array_repeat("features", times))
    items = read_stored(in_chunks(start.select("product_id", features.alias("features"))), "factors-start")
    users = None
    of = dealt.heavy
    for _ in range(iterations):
        users = half_step(of["user_id"], "user_id", items, "product_id", rank, reg_param, dealt.by_user, kind)
        items = half_step(of["product_id"], "product_id", users, "user_id", rank, reg_param, dealt.by_item, kind)
    if users is None:
        return Factors(None, from_chunks(items, "product_id", kind))
    return with_chunks(from_chunks(users, "user_id", kind), from_chunks(items, "product_id", kind), (users, items))


def cores_of(rows: DataFrame) -> int:
    return rows.sparkSession.sparkContext.defaultParallelism


def gradients(ratings: DataFrame, factors: Factors, reg_param: float) -> DataFrame:
    """``product_id, gradient``: the greatest entry of what the fit leaves undone for each
    product: 0 but for rounding right after the products were solved."""
    rows = ratings.select("user_id", "product_id", F.col("score").cast("double").alias("score"))
    rows = rows.where("user_id IS NOT NULL AND product_id IS NOT NULL")
    size = factors.items.select(F.size("features")).first()
    count = load_of(rows).turned().blocks(cores_of(rows), 8 * size[0] if size else 8, own=True)
    blocks = blocks_of(rows, "product_id", "user_id", count)

    def work():
        def undone(ids, place, vectors, mine, own, score, valid):
            begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            x, p = vectors[place].astype(np.float64), own[mine].astype(np.float64)
            error = score - (x * p).sum(axis=1)
            each = np.where(valid[:, None], error[:, None] * x - reg_param * p, 0.0)
            g = np.add.reduceat(each, begin, axis=0)
            n = np.add.reduceat(valid.astype(np.int64), begin)
            yield pa.RecordBatch.from_arrays(
                [*_vectors(ids[begin], g).columns, pa.array(n)], names=["product_id", "g", "n"]
            )

        return undone

    users, items = factors.stored_chunks()
    # A product comes once per chunk that holds some of its ratings: the parts are added up.
    parts = _met(blocks, users, items, work, "product_id int, g array<double>, n bigint")
    each = parts.select("product_id", "n", F.posexplode("g").alias("k", "x"))
    sums = each.groupBy("product_id", "k").agg(F.when(F.sum("n") > 0, F.sum("x")).alias("g"))
    return sums.groupBy("product_id").agg(F.max(F.abs("g")).alias("gradient"))


def squared_errors(pairs: DataFrame, factors: Factors, rank: int, times: int = 1) -> DataFrame:
    """``n`` and ``squares`` of the predictions of ``user_id, product_id, score``, one number
    for each of the ``times`` fits whose vectors stand one after the other."""
    rows = pairs.select("user_id", "product_id", F.col("score").cast("double").alias("score"))
    rows = rows.where("user_id IS NOT NULL AND product_id IS NOT NULL")
    blocks = blocks_of(rows, "user_id", "product_id", load_of(rows).blocks(cores_of(rows), 8 * rank * times, own=True))

    def work():
        def errors(ids, place, vectors, mine, own, score, valid):
            n, squares = np.zeros(times, np.int64), np.zeros(times)
            step = max(1, SLICE_CELLS // (rank * times))
            for a in range(0, len(ids), step):
                cut = slice(a, a + step)
                x = (vectors[place[cut]].astype(np.float64) * own[mine[cut]]).reshape(-1, times, rank).sum(axis=2)
                good = valid[cut, None] & ~np.isnan(x)
                n += good.sum(axis=0)
                squares += np.where(good, (score[cut, None] - x) ** 2, 0.0).sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(times), pa.int32()), pa.array(n), pa.array(squares)], names=["fit", "n", "squares"]
            )

        return errors

    users, items = factors.stored_chunks()
    parts = _met(blocks, items, users, work, "fit int, n bigint, squares double")
    return parts.groupBy("fit").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"))


def predicted(pairs: DataFrame, factors: Factors, rank: int) -> DataFrame:
    """``pairs`` with ``prediction``, the dot product of ``user_id`` and ``product_id``, where
    both have a vector and the product is a number. No vector is shuffled."""
    rows = pairs.select("user_id", "product_id", F.struct("*").alias("row"))
    blocks = blocks_of(rows, "user_id", "product_id", load_of(rows).blocks(cores_of(rows), 8 * rank, own=True), "row")

    def meet(task: _Task, held: pa.Table) -> Iterator[pa.RecordBatch]:
        (fixed_ids, fixed), (own_ids, own) = task.sides()
        for some in held.to_batches(CHUNK_ROWS):
            place, have = _found(fixed_ids, some.column("other").to_numpy())
            mine, also = _found(own_ids, some.column("id").to_numpy())
            keep = have & also
            x = np.einsum("ij,ij->i", own[mine[keep]].astype(np.float64), fixed[place[keep]].astype(np.float64))
            number = ~np.isnan(x)
            pairs = some.column("score").filter(pa.array(keep)).filter(pa.array(number))
            yield pa.RecordBatch.from_arrays([pairs, pa.array(x[number])], names=["row", "prediction"])

    users, items = factors.stored_chunks()
    schema = StructType().add("row", blocks.rows.schema["score"].dataType).add("prediction", DoubleType())
    found = _beside(blocks, items, users, lambda: _Task(None, None, False), meet, schema)
    return found.select("row.*", "prediction")
