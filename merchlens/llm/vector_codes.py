"""Vectors compressed to a code of one byte per part, by codebooks learned with Lloyd's rounds.

Parts live with the codebook entry they are nearest to: rows are partitioned by position,
entry and a salt, so that an entry which a third of all parts share has many owners. In each
round the owners assign their resident parts anew; those that stay are not moved, those whose
entry changed are the only ones in the next shuffle. Owners then add up their residents, and
the sums of an entry's owners give the entry's new place. The driver holds the codebooks
alone. All arithmetic is on whole numbers, so results do not depend on the partitioning.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.tables import small, stored
from merchlens.session import scratch_path

SCALE = 1024
POSITIONS = 4
ENTRIES = 256
ROUNDS = 4
#: Parts that one owner holds on average if all were alike; the salts follow from it.
OWNER_PARTS = 1 << 18
LEAST_SALTS = 32
RESIDENT = "position int, entry int, salt int, row bigint, distance bigint, part array<int>"
KINDS = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
NAMES = ["position", "entry", "salt", "row", "distance", "part"]


def whole_vectors(vectors: DataFrame, positions: int = POSITIONS, scale: int = SCALE) -> tuple[DataFrame, int]:
    """``row, vec_id, label, components`` of the vectors that are kept, and their length.

    Null vectors and those with a null or non-finite component are dropped. A component x
    becomes floor(scale * x). The common length is that of the longest vector, at least one
    component for each position, rounded up to a multiple of ``positions``; shorter vectors
    (empty ones too) are filled with zeros. Numbers whose squared distances would not fit
    into 64 bits (for 64 components those beyond 131,072) are taken as the limit.
    """
    x = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(x, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select("vec_id", "label", x.alias("x")).where(F.col("x").isNotNull() & ~bad)
    longest = kept.agg(F.max(F.size("x"))).first()[0] or 0
    length = max(1, -(-longest // positions)) * positions
    limit = float(math.isqrt((1 << 60) // length))
    whole = F.transform(
        "x", lambda x: F.floor(F.least(F.greatest(x * F.lit(float(scale)), F.lit(-limit)), F.lit(limit))).cast("int")
    )
    fill = F.array_repeat(F.lit(0), F.lit(length) - F.size("x"))
    rows = kept.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label",
        F.concat(whole, fill).alias("components"),
    )
    return stored(rows, "vectors"), length


def nearest(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (the lower of equally near ones) and squared distance.

    Both routes are exact: sums that a double holds exactly are made by matrix products.
    """
    largest = int(max(np.abs(parts).max(initial=0), np.abs(codebook).max(initial=0)))
    kind = np.float64 if 4 * largest * largest * parts.shape[1] < 1 << 52 else np.int64
    entries = codebook.astype(kind)
    norms = (entries * entries).sum(axis=1)
    entry = np.empty(len(parts), np.int64)
    distance = np.empty(len(parts), np.int64)
    for a in range(0, len(parts), 4096):
        own = parts[a : a + 4096].astype(kind)
        if kind is np.float64:
            all_ = norms - 2 * (own @ entries.T)  # short of the part's own square
            best = all_.argmin(axis=1)
            least = all_[np.arange(len(own)), best] + (own * own).sum(axis=1)
        else:
            all_ = np.stack([((own - e) ** 2).sum(axis=1) for e in entries], axis=1)
            best = all_.argmin(axis=1)
            least = all_[np.arange(len(own)), best]
        entry[a : a + 4096], distance[a : a + 4096] = best, least
    return entry, distance


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _batch(columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(columns, KINDS)]
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.reshape(-1).astype(np.int32)))


def first_assignment(rows: DataFrame, codebooks: np.ndarray, salts: int) -> DataFrame:
    """Every vector's parts with their nearest entries; none has an owner yet."""
    positions, _, width = codebooks.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column("row").to_numpy()
            vectors = _matrix(batch.column("components"), positions * width)
            for p in range(positions):
                part = vectors[:, p * width : (p + 1) * width]
                entry, distance = nearest(part, codebooks[p])
                yield _batch([np.full(len(row), p), entry, row % salts, row, distance, _lists(part)])

    return rows.select("row", "components").mapInArrow(assign, RESIDENT)


def reassigned(resident: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """The resident parts with their nearest entries now, and whether these are others."""
    width = codebooks.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            position = batch.column("position").to_numpy()
            before = batch.column("entry").to_numpy()
            parts = _matrix(batch.column("part"), width)
            entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
            for p in np.unique(position):
                own = position == p
                entry[own], distance[own] = nearest(parts[own], codebooks[p])
            out = _batch([position, entry, batch.column("salt"), batch.column("row"), distance, batch.column("part")])
            yield out.append_column("moved", pa.array(entry != before))

    return resident.mapInArrow(assign, RESIDENT + ", moved boolean")


def at_owners(parts: DataFrame) -> DataFrame:
    """The parts shuffled to the owners of their entries, and stored there."""
    return stored(parts.select(*NAMES).repartition("position", "entry", "salt"), "residents")


def migrated(resident: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """The residents after a round: who stays is read in place, who moves is shuffled."""
    spark = resident.sparkSession
    path = scratch_path(spark, "assigned")
    reassigned(resident, codebooks).write.partitionBy("moved").parquet(path)
    after = spark.read.schema(RESIDENT + ", moved boolean").parquet(path)
    staying = after.where("NOT moved").select(*NAMES)
    return staying.union(at_owners(after.where("moved")))


def updated(resident: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Every entry's new place: the floor of the mean of its parts, or where it was.

    Owners add up their residents; at most one row per position, entry and component
    reaches the driver.
    """
    positions, entries, width = codebooks.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((positions * entries, width), np.int64)
        counts = np.zeros(positions * entries, np.int64)
        for batch in batches:
            key = batch.column("position").to_numpy().astype(np.int64) * entries + batch.column("entry").to_numpy()
            order = np.argsort(key, kind="stable")
            if len(order):
                key = key[order]
                begin = np.flatnonzero(np.diff(key, prepend=-1))
                parts = _matrix(batch.column("part"), width)[order].astype(np.int64)
                sums[key[begin]] += np.add.reduceat(parts, begin, axis=0)
                counts[key[begin]] += np.diff(np.append(begin, len(key)))
        used = np.flatnonzero(counts)
        offsets = np.arange(len(used) + 1, dtype=np.int32) * width
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used), pa.array(counts[used]),
                pa.ListArray.from_arrays(offsets, pa.array(sums[used].reshape(-1))),
            ],
            names=["key", "n", "sums"],
        )

    partial = resident.mapInArrow(add, "key bigint, n bigint, sums array<bigint>")
    totals = partial.select("key", "n", F.posexplode("sums")).groupBy("key", "pos").agg(
        F.sum("n").alias("n"), F.sum("col").alias("total")
    )
    out = codebooks.copy()
    for r in totals.collect():
        out[r["key"] // entries, r["key"] % entries, r["pos"]] = r["total"] // r["n"]
    return out


def learn_codebooks(
    rows: DataFrame, length: int, positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[np.ndarray, DataFrame]:
    """The codebooks after ``rounds`` rounds, and all parts assigned to them.

    Codebooks (position, entry, component) start as the parts of the vectors with the
    ``entries`` smallest ids (nulls last; equal ids in order of their components), or of
    all if there are fewer. There must be a vector.
    """
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "components").limit(entries).select("components").collect()
    start = np.array([r["components"] for r in first], np.int64)
    codebooks = start.reshape(len(start), positions, length // positions).transpose(1, 0, 2).copy()
    salts = max(LEAST_SALTS, positions * rows.count() // OWNER_PARTS)
    resident = None
    for _ in range(rounds):
        if resident is None:
            resident = at_owners(first_assignment(rows, codebooks, salts))
        else:
            resident = migrated(resident, codebooks)
        codebooks = updated(resident, codebooks)
    if resident is None:
        return codebooks, first_assignment(rows, codebooks, salts)
    return codebooks, reassigned(resident, codebooks)


def codebook_text(codebooks: np.ndarray) -> str:
    """All entries' components by position, entry and place, divided by commas."""
    return ",".join(map(str, codebooks.reshape(-1).tolist()))


def compressed(
    vectors: DataFrame,
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[np.ndarray | None, DataFrame]:
    """The codebooks, and ``vec_id, label, entries, error`` of every vector that is kept.

    ``vectors`` has ``vec_id, embedding, label``; other columns are ignored. ``entries`` of
    a row are the indexes of its parts' nearest entries, ``error`` their squared distances
    added up. Repeated rows and ids stay apart. Without a vector that is kept, the
    codebooks are None and there are no rows.
    """
    rows, length = whole_vectors(vectors, positions, scale)
    spark = vectors.sparkSession
    named = rows.select("row", "vec_id", "label")
    if rows.limit(1).count() == 0:
        kind = named.schema["label"].dataType.simpleString()
        id_kind = named.schema["vec_id"].dataType.simpleString()
        schema = f"vec_id {id_kind}, label {kind}, entries array<int>, error bigint"
        return None, spark.createDataFrame([], schema)
    codebooks, parts = learn_codebooks(rows, length, positions, entries, rounds)
    # A vector's name and its parts meet by its row number; one shuffle of narrow rows.
    none = F.lit(None)
    every = named.select(
        "row", "vec_id", "label", none.cast("int").alias("position"),
        none.cast("int").alias("entry"), none.cast("bigint").alias("distance"),
    ).unionByName(parts.select("row", "position", "entry", "distance"), allowMissingColumns=True)
    entry_of = [F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(positions)]
    coded = every.groupBy("row").agg(
        F.max("vec_id").alias("vec_id"), F.max("label").alias("label"),
        F.array(*entry_of).alias("entries"), F.sum("distance").alias("error"),
    ).drop("row")
    return codebooks, stored(coded, "codes")


def code_digest(codebooks: np.ndarray | None, coded: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` from ``compressed``."""
    text = "" if codebooks is None else codebook_text(codebooks)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    by_label = stored(by_label.withColumnRenamed("label", "own_label"), "label-errors")
    joined = coded.join(small(by_label, by_label.count()), F.col("label").eqNullSafe(F.col("own_label")))
    digits = F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0"))
    return joined.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"),
    )
