"""Groups of near-equal documents: an exact Jaccard join of word n-gram sets.

Documents with equal sets are one class, and the join works on classes. Shingles are
ordered by rarity, and a class puts forward a prefix of its rarest ones. A class may ask
for ``l`` shared prefix shingles instead of one if it lengthens its prefix by ``l - 1``;
it takes the ``l`` whose candidates are estimated to cost least. Candidates are then
bounded by bit signatures and the rest verified on the whole sets.

A shingle that very many classes put forward gets no pairs at all: its classes are
compared block by block inside tasks, each of which returns a forest of its links only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.tables import KeyFilter, min_label_components, set_aside, small, stored
from merchlens.llm.words import SPACED, Words, distinct_per_text, shingles, stable_order, text_blocks

#: Most shingles whose counts order the prefixes; the rest count as rare. The order only
#: steers how many candidates there are, so any table gives the same links.
COUNTED = 1 << 17
COUNTED_FROM = 8
#: Levels of prefixes; a class asks for at most so many shared shingles.
LEVELS = 4
#: Cost of bounding and verifying a candidate, in visits of a posting.
VERIFY_COST = 16
#: Classes that put a shingle forward, from which they are compared block by block.
HOT = 64
#: Classes and shingles of a block at most (one larger class is a block of its own).
BLOCK_CLASSES = 2048
BLOCK_SHINGLES = 4 << 20
GATHERED = 1 << 20


@dataclass(frozen=True)
class Likeness:
    """Sets of ``width``-word shingles are linked from ``num / den`` Jaccard on."""

    width: int = 5
    num: int = 80
    den: int = 100

    def least_overlap(self, n):
        """Shingles that a set of n must share with any set it is linked to."""
        return -(-self.num * n // self.den)

    def linked(self, both, a, b):
        return self.den * both >= self.num * (a + b - both)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``a`` to ``b`` of a batch, their distinct shingles and how many each has."""
    for a, b, data, offsets in text_blocks(batch.column("text")):
        words = Words(data, offsets, SPACED, True)
        values, counts = distinct_per_text(*shingles(words, width))
        yield a, b, values, counts


def common_shingles(docs: DataFrame, width: int, most: int = COUNTED) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that repeat most, ascending, and how often: at most ``most``.

    All documents are counted: repeats within a task's stretch of documents are summed
    over the tasks. A shingle that never repeats within a stretch is left out as rare.
    """

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            keep = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(values[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))],
                names=["token", "n"],
            )

        parts: list[np.ndarray] = []
        for batch in batches:
            for _, _, values, _ in _sets(batch, width):
                parts.append(values)
                if sum(map(len, parts)) > GATHERED:
                    yield out(parts)
                    parts = []
        if parts:
            yield out(parts)

    counts = docs.select("text").mapInArrow(repeats, "token long, n long")
    counts = counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COUNTED_FROM)
    top = counts.orderBy(F.desc("n"), "token").limit(most).toArrow()
    tokens = top["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy()[order]


def _bits(values: np.ndarray) -> bytes:
    """A set as parities: bit ``i`` is the number of its shingles that end in ``i``, mod 2.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    size = max(64, 1 << int(2 * len(values) - 1).bit_length())
    parity = np.bincount((values & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _different_bits(a: bytes, b: bytes) -> int:
    one, two = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] ^ two[len(two) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def profiles(docs: DataFrame, like: Likeness) -> DataFrame:
    """One stored row per document: ``row, doc_id, n, print, tokens, bits``.

    ``print`` is equal for equal sets (null for empty ones), ``tokens`` the prefix with
    the shingles of all levels, rarest first.
    """
    common, counts = common_shingles(docs, like.width)
    sent = docs.sparkSession.sparkContext.broadcast((common, counts))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = sent.value
        for batch in batches:
            for a, b, values, counts in _sets(batch, like.width):
                text = np.repeat(np.arange(b - a), counts)
                weight = np.zeros(len(values), np.int64)
                if len(common):
                    at = np.searchsorted(common, values)
                    at[at == len(common)] = 0
                    known = common[at] == values
                    weight[known] = often[at[known]]
                order = np.argsort(weight, kind="stable")  # values stay ascending
                order = order[stable_order(text[order], b - a)]
                first = np.cumsum(counts) - counts
                place = np.arange(len(values)) - np.repeat(first, counts)
                length = np.minimum(counts, counts - like.least_overlap(counts) + LEVELS)
                put = place < np.repeat(length, counts)
                edges = np.append(0, np.cumsum(np.minimum(length, counts)))
                cuts = np.append(first, len(values)).tolist()
                sets = [values[cuts[i] : cuts[i + 1]] for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(counts, pa.int32()),
                        pa.array(
                            [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                            pa.binary(),
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(edges, pa.int32()), pa.array(values[order][put].view(np.int64))
                        ),
                        pa.array([_bits(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "print", "tokens", "bits"],
                )

    schema = "doc_id long, n int, print binary, tokens array<long>, bits binary"
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    made = narrow.mapInArrow(profile, schema)
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "profiles")


def live_postings(classes: DataFrame, like: Likeness) -> DataFrame:
    """Prefix shingles that two classes or more put forward: ``token, row, n, level, df``."""
    over = F.col("at") - (F.col("n") - F.expr(_least(like, "n")))  # 0 for the first level
    postings = classes.select("row", "n", F.posexplode("tokens").alias("at", "token")).select(
        "token", "row", "n", F.greatest(over + 1, F.lit(1)).cast("int").alias("level")
    )
    shared = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    return stored(postings.join(shared, "token"), "postings")


def _least(like: Likeness, n: str) -> str:
    return f"(({like.num} * {n} + {like.den - 1}) div {like.den})"


def wanted_matches(cold: DataFrame, like: Likeness) -> DataFrame:
    """``row, wanted``: how many shared shingles each class asks for.

    With ``l`` levels a class visits ``visits`` postings, and at most ``visits / l``
    other classes can share ``l`` shingles with it.
    """
    levels = range(1, LEVELS + 1)
    visits = cold.groupBy("row", "n").agg(
        *[F.sum(F.when(F.col("level") <= k, F.col("df") - 1).otherwise(0)).alias(f"v{k}") for k in levels]
    )
    least = F.expr(_least(like, "n"))
    costs = [
        F.when(least >= k, F.struct((F.col(f"v{k}") * (1 + VERIFY_COST / k)).alias("cost"), F.lit(k).alias("k")))
        for k in levels
    ]
    return visits.select("row", F.array_min(F.array(*costs))["k"].alias("wanted"))


def candidates(cold: DataFrame, like: Likeness) -> DataFrame:
    """Pairs ``a, b`` of classes that share as many prefix shingles as ``a`` asks for.

    ``a`` is the larger of the two (by size, then row), and its levels hold for both.
    """
    asked = cold.join(wanted_matches(cold, like), "row")
    a = asked.select("token", *[F.col(c).alias(f"a_{c}") for c in ("row", "n", "level", "wanted")])
    a = a.where("a_level <= a_wanted")
    b = cold.select("token", *[F.col(c).alias(f"b_{c}") for c in ("row", "n", "level")])
    fits = (
        (F.struct("b_n", "b_row") < F.struct("a_n", "a_row"))
        & (like.den * F.col("b_n") >= like.num * F.col("a_n"))
        & (F.col("b_level") <= F.col("a_wanted"))
    )
    pairs = a.join(b, "token").where(fits)
    pairs = pairs.groupBy(F.col("a_row").alias("a"), F.col("b_row").alias("b"), "a_wanted").agg(
        F.count("*").alias("shared")
    )
    return pairs.where("shared >= a_wanted").select("a", "b")


def bounded(pairs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """``pairs`` whose bit signatures leave a link possible."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a_bits", "b_bits", "a_n", "b_n")]
            keep = []
            for one, two, n, m in zip(*columns):
                both = (n + m - _different_bits(one, two)) // 2
                keep.append(bool(like.linked(both, n, m)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("row").alias(name), F.col("bits").alias(f"{name}_bits"), F.col("n").alias(f"{name}_n")
        )

    whole = small(pairs, pairs.count()).join(side("a"), "a").join(side("b"), "b")
    return whole.select("a", "b", "a_bits", "b_bits", "a_n", "b_n").mapInArrow(bound, "a long, b long")


def whole_sets(docs: DataFrame, classes: DataFrame, rows: DataFrame, like: Likeness) -> DataFrame:
    """Stored ``row, n, shingles`` of the classes in ``rows``, read from the texts again."""
    needed = stored(classes.join(rows, "row", "left_semi").select("row", "doc_id", "print"), "needed")
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    of_docs = KeyFilter(needed, "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(of_docs.passes(batch.column("doc_id"))))
            for _, _, values, counts in _sets(some, like.width):
                cuts = np.append(0, np.cumsum(counts)).tolist()
                own = [values[i:j].tobytes() for i, j in zip(cuts, cuts[1:]) if j > i]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in own], pa.binary()),
                        pa.array([len(s) // 8 for s in own], pa.int32()),
                        pa.array(own, pa.binary()),
                    ],
                    names=["print", "n", "shingles"],
                )

    made = narrow.mapInArrow(sets, "print binary, n int, shingles binary")
    found = made.join(needed.select("row", "print"), "print")
    # Rows that repeat an id may give a set twice.
    return stored(found.select("row", "n", "shingles"), "sets").dropDuplicates(["row"])


def verified(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The linked ones of ``pairs``, by the whole sets."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(bool(like.linked(both, len(a), len(b))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("row").alias(name), F.col("shingles").alias(f"{name}_set"))

    whole = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_set", "b_set")
    return whole.mapInArrow(verify, "a long, b long")


# ---------------------------------------------------------------- hot shingles


def overlaps(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of all intersections, as a product of incidence matrices, slice by slice."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, inverse, counts = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[inverse]
    column, owner = number[inverse[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(column, [first, first + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        out += (part @ part.T).astype(np.int64)  # whole numbers up to ``columns``: exact
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a symmetric table of links joins, fewer than there are rows."""
    left = np.ones(len(linked), bool)
    edges = []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            node = queue.pop()
            new = np.flatnonzero(linked[node] & left)
            left[new] = False
            edges += [(node, k) for k in new.tolist()]
            queue += new.tolist()
    return edges


def _links_within(groups: DataFrame, keys: list[str], like: Likeness) -> DataFrame:
    """Forests of links ``a, b`` within each group of ``row, n, shingles``."""

    def link(group: pa.Table) -> pa.Table:
        rows = group["row"].to_numpy()
        _, first = np.unique(rows, return_index=True)
        shingle = group["shingles"].to_pylist()
        sets = [np.frombuffer(shingle[i], np.uint64) for i in first.tolist()]
        rows, n = rows[first], np.array([len(s) for s in sets], np.int64)
        both = overlaps(sets)
        edges = forest(like.linked(both, n[:, None], n[None, :]))
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"a": rows[pairs[:, 0]], "b": rows[pairs[:, 1]]})

    return groups.groupBy(*keys).applyInArrow(link, "a long, b long")


def hot_links(hot: DataFrame, sets: DataFrame, like: Likeness, block: int = BLOCK_CLASSES) -> DataFrame:
    """Links among the classes of each hot shingle, as forests.

    Hot shingles with the same classes are one. First each block of a shingle's classes
    is compared within itself. What that joins needs no more comparing, so second only
    blocks that hold different components are compared with each other.
    """
    mark = F.xxhash64("row", F.lit(1))
    members = hot.groupBy("token").agg(
        F.count("*").alias("df"),
        F.sum("n").alias("shingles"),
        F.bit_xor(mark).alias("x"),
        F.bit_xor(F.xxhash64("row", F.lit(2))).alias("y"),
    )
    tokens = members.groupBy("df", "shingles", "x", "y").agg(F.min("token").alias("token"))
    blocks_ = F.greatest(
        F.ceil(F.col("df") / block), F.ceil(F.col("shingles") / BLOCK_SHINGLES)
    )
    tokens = tokens.select("token", blocks_.alias("blocks"))
    dealt = hot.select("token", "row").join(tokens, "token")
    dealt = stored(
        dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))), "blocks"
    )
    inside = _links_within(
        dealt.select("token", "block", "row").join(sets, "row"), ["token", "block"], like
    )
    inside = stored(inside, "hot-links")
    wide = dealt.where("blocks > 1")
    if not wide.limit(1).count():
        return inside
    found = min_label_components(inside)
    wide = wide.join(found, F.col("row") == F.col("node"), "left").select(
        "token", "row", F.coalesce("component", "row").alias("component")
    )
    mixed = wide.groupBy("token").agg(F.min("component").alias("l"), F.max("component").alias("h"))
    wide = wide.join(mixed.where("l < h").select("token"), "token", "left_semi")
    sizes = wide.groupBy("token", "component").agg(F.count("*").alias("size"))
    wide = wide.join(sizes, ["token", "component"])
    own = F.col("size") >= block // 4  # a large component has blocks of its own
    wide = wide.withColumn("part", F.when(own, F.col("component")))
    many = wide.groupBy("token", "part").agg(F.ceil(F.count("*") / block).alias("many"))
    wide = wide.join(
        many.withColumnRenamed("token", "t").withColumnRenamed("part", "p"),
        (F.col("token") == F.col("t")) & F.col("part").eqNullSafe(F.col("p")),
    )
    wide = stored(
        wide.select("token", "row", "part", F.pmod(F.xxhash64("row"), F.col("many")).alias("cut")), "wide"
    )
    ends = wide.select("token", "part", "cut").distinct()
    one = ends.select("token", F.struct("part", "cut").alias("one"))
    two = ends.select("token", F.struct("part", "cut").alias("two"))
    meet = one.join(two, "token").where(
        (F.col("one") <= F.col("two"))
        & (F.col("one.part").isNull() | ~F.col("one.part").eqNullSafe(F.col("two.part")))
    )
    side = wide.select("token", F.struct("part", "cut").alias("side"), "row")
    sent = meet.select("token", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("side"))
    across = sent.join(side, ["token", "side"]).select("token", "one", "two", "row").join(sets, "row")
    return inside.union(_links_within(across, ["token", "one", "two"], like))


# ---------------------------------------------------------------- groups


def similar_groups(
    docs: DataFrame, like: Likeness = Likeness(), hot_from: int = HOT, block: int = BLOCK_CLASSES
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are divided by ASCII white space, with A-Z in lower case. A document's set is
    its distinct shingles; with fewer words its whole sequence is one. Documents are
    linked from the given likeness on, and ``component_id`` is the least id reachable
    over links. A null, empty or blank text has no shingles and a component of its own.
    Rows that repeat an id each count. Other columns are ignored; an empty table gives
    an empty table.
    """
    every = profiles(docs, like)
    some = every.where("print IS NOT NULL")
    firsts = some.groupBy("print").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"))
    firsts = stored(firsts, "classes")
    n_classes = firsts.count()
    classes = stored(every.join(small(firsts.select("row"), n_classes), "row", "left_semi"), "class-profiles")
    live = live_postings(classes, like)
    cold, hot = live.where(F.col("df") <= hot_from), live.where(F.col("df") > hot_from)
    pairs = stored(candidates(cold, like), "candidates")
    pairs = stored(bounded(pairs, classes, like), "bounded")
    rows = pairs.select(F.explode(F.array("a", "b")).alias("row")).union(hot.select("row")).distinct()
    sets = whole_sets(docs, classes, rows, like)
    links = verified(pairs, sets, like).union(hot_links(hot, sets, like, block))
    found = min_label_components(links)
    joined = firsts.join(found, F.col("row") == F.col("node"), "left").select(
        "print", "least", F.coalesce("component", "row").alias("group")
    )
    joined = stored(joined, "groups")
    least = joined.groupBy("group").agg(F.min("least").alias("component_id"))
    by_print = joined.join(least, "group").select("print", "component_id")
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"]
    alone = every.where("print IS NULL").withColumn("component_id", F.col("doc_id"))
    return some.join(by_print, "print").select(*columns).union(alone.select(*columns))


def one_per_group(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``docs`` with the document of the least id of each group of :func:`similar_groups`.

    Rows that repeat an id and a text are one document.
    """
    groups = similar_groups(docs, like)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = groups.groupBy("doc_id").agg(F.count_if(first).alias("n"))
    ids = stored(ids.where("n <> 1"), "ids")
    gone = ids.where("n = 0").select(F.col("doc_id").alias("id"))
    own, back = set_aside(docs, "doc_id", "text")
    left = own.join(
        small(gone, gone.count()), F.col("doc_id").eqNullSafe(F.col("id")), "left_anti"
    )
    if ids.where("n > 1").limit(1).count():
        left = left.dropDuplicates(["doc_id", "text"])
    return left.select(*back.values())
