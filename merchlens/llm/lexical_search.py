"""Ranked search over an inverted index of whole texts, by Block-Max MaxScore.

The index is cut by document into segments. A segment holds its documents, a dictionary of
all their terms, and each term's list of documents and frequencies in compressed blocks, with
the highest share of a score that any document of the block can get from the term. No posting
is shuffled, so a term of every document weighs on each segment alike.

A search goes through the segments of a task one after the other and keeps a heap per query.
Lists are taken from the highest bound down. Once the bounds of all lists that are left cannot
lift a new document into the heap, they are non-essential: they only add to documents found so
far, and the maxima of the blocks in which these would be reject most before a block is
decompressed. The tasks' heaps are merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.tables import stored
from merchlens.llm.words import ALPHANUMERIC, Words, text_blocks

#: Bytes of text of one segment; a longer text is a segment of its own.
SEGMENT_BYTES = 12 << 20
#: Postings of one compressed block.
BLOCK = 128
#: (item, term) pairs that one search holds in memory; more items are searched in turn.
SEARCH_TERMS = 1 << 16
TOP = 50
INDEX = """doc_ids array<bigint>, damping binary, terms binary, sizes binary, lasts binary,
    maxima binary, widths binary, postings binary"""
FOUND = "item_id bigint, score bigint, doc_id bigint"
WIDTHS = (1, 2, 4)


class Index(NamedTuple):
    """Stored segments, the number of documents with a term, and of all their terms."""

    segments: DataFrame
    n_docs: int
    n_terms: int


def impact(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
    """What a document's score gets from a term of weight 1, in whole numbers."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * damping)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _damping(counts: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """50 plus 50 times each document's number of terms against the mean, rounded down."""
    if 50 * int(counts.max(initial=0)) * n_docs < 1 << 62:
        return 50 + (50 * counts * n_docs) // max(n_terms, 1)
    return np.array([50 + (50 * n * n_docs) // n_terms for n in counts.tolist()], np.int64)


# ---------------------------------------------------------------- the index


def _postings(data: np.ndarray, offsets: np.ndarray, first_doc: int):
    """(term hash, document, frequency) of some texts by hash, and each text's terms."""
    words = Words(data, offsets, ALPHANUMERIC, lower=True)
    hashes = words.hashes()
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], words.text_of()[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(order)))
    return hashes[at], docs[at] + first_doc, tf, words.counts


def _width_of(largest: np.ndarray) -> np.ndarray:
    """Bytes for numbers up to the given ones, as places in ``WIDTHS``."""
    return (largest >= 1 << 8).astype(np.uint8) + (largest >= 1 << 16)


def _spread(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Write each value in its own number of bytes."""
    for w in WIDTHS:
        own = np.flatnonzero(width == w)
        for k in range(w):
            out[at[own] + k] = (values[own] >> (8 * k)) & 255


def segment_row(hashes: np.ndarray, docs: np.ndarray, tf: np.ndarray, damping: np.ndarray) -> list:
    """Columns of a segment from its postings, given by term and document."""
    n = len(hashes)
    new = np.ones(n, bool)
    new[1:] = hashes[1:] != hashes[:-1]
    lists = np.flatnonzero(new)
    sizes = np.diff(np.append(lists, n))
    within = np.arange(n) - np.repeat(lists, sizes)
    blocks = np.flatnonzero(within % BLOCK == 0)
    ends = np.append(blocks[1:], n)
    gaps = docs.copy()
    gaps[1:] -= np.where(new[1:], 0, docs[:-1])
    if not n:
        empty = b""
        return [damping.astype("<i8").tobytes(), *[empty] * 6]
    count = ends - blocks
    gap_code = _width_of(np.maximum.reduceat(gaps, blocks))
    tf_code = _width_of(np.maximum.reduceat(tf, blocks))
    widths = np.array(WIDTHS)
    gap_width, tf_width = widths[gap_code], widths[tf_code]
    at = np.cumsum(count * (gap_width + tf_width)) - count * (gap_width + tf_width)
    place = np.arange(n) - np.repeat(blocks, count)
    out = np.zeros(int((count * (gap_width + tf_width)).sum()), np.uint8)
    first = np.repeat(at, count)
    each_gap, each_tf = np.repeat(gap_width, count), np.repeat(tf_width, count)
    _spread(out, first + place * each_gap, gaps, each_gap)
    _spread(out, first + np.repeat(count * gap_width, count) + place * each_tf, tf, each_tf)
    return [
        damping.astype("<i8").tobytes(),
        hashes[lists].astype("<u8").tobytes(),
        sizes.astype("<i4").tobytes(),
        docs[ends - 1].astype("<i4").tobytes(),
        np.maximum.reduceat(impact(tf, damping[docs]), blocks).astype("<i4").tobytes(),
        (gap_code * 3 + tf_code).astype(np.uint8).tobytes(),
        out.tobytes(),
    ]


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and all their terms with repeats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text")):
                words = Words(data, offsets, ALPHANUMERIC)
                n_docs += int((words.counts > 0).sum())
                n_terms += int(words.counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms])], names=["d", "t"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "d bigint, t bigint")
    found = rows.agg(F.sum("d"), F.sum("t")).first()
    return found[0] or 0, found[1] or 0


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> Index:
    """The stored index of ``doc_id, text``; it serves any number of searches.

    Terms are runs of ASCII letters, digits and characters outside ASCII, with A-Z in lower
    case; they are told apart by 64-bit hashes. Null and empty texts have none. Repeated
    rows are documents of their own; other columns are ignored.
    """
    n_docs, n_terms = corpus_size(docs)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        parts: list[tuple] = []
        held = 0
        schema = pa.schema([("doc_ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in (
            "damping", "terms", "sizes", "lasts", "maxima", "widths", "postings"))])

        def row() -> pa.RecordBatch:
            hashes, docs_, tf, counts = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(hashes, kind="stable")  # parts are in order of documents
            values = segment_row(hashes[order], docs_[order], tf[order], _damping(counts, n_docs, n_terms))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip([ids, *values], schema.types)], schema=schema
            )

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b, data, offsets in text_blocks(batch.column("text")):
                if parts and held + len(data) > segment_bytes:
                    yield row()
                    ids, parts, held = [], [], 0
                parts.append(_postings(data, offsets, len(ids)))
                ids = ids + doc_ids[a:b]
                held += len(data)
        if parts:
            yield row()

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return Index(stored(narrow.mapInArrow(segments, INDEX), "search-index"), n_docs, n_terms)


class Segment:
    """A row of the index, ready for searches; nothing is decompressed before it is asked for."""

    def __init__(self, row: pa.RecordBatch):
        def numbers(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(row.column(name)[0].as_buffer(), kind)

        ids = row.column("doc_ids")[0].values
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.doc_ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.damping = numbers("damping", "<i8")
        self.terms = numbers("terms", "<u8")
        self.sizes = numbers("sizes", "<i4").astype(np.int64)
        self.lasts = numbers("lasts", "<i4").astype(np.int64)
        self.maxima = numbers("maxima", "<i4").astype(np.int64)
        self.data = numbers("postings", "u1")
        code = numbers("widths", "u1")
        blocks = -(-self.sizes // BLOCK)
        self.first = np.append(0, np.cumsum(blocks))  # block numbers of each list
        self.count = np.full(len(code), BLOCK, np.int64)
        if len(code):
            self.count[self.first[1:] - 1] = self.sizes - (blocks - 1) * BLOCK
        widths = np.array(WIDTHS, np.int64)
        self.gap_width, self.tf_width = widths[code // 3], widths[code % 3]
        length = self.count * (self.gap_width + self.tf_width)
        self.at = np.cumsum(length) - length
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.decompressed = 0

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """Each term's list, -1 where it does not occur."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[place] == terms, place, -1)

    def bound(self, number: int) -> int:
        """The most that a document gets from a list, for a weight of 1."""
        return int(self.maxima[self.first[number] : self.first[number + 1]].max())

    def _read(self, at: np.ndarray, width: np.ndarray) -> np.ndarray:
        out = self.data[at].astype(np.int64)
        for k in (1, 2, 3):
            more = np.flatnonzero(width > k)
            if not len(more):
                break
            out[more] += self.data[at[more] + k].astype(np.int64) << (8 * k)
        return out

    def decompress(self, number: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks (ascending) of a list."""
        self.decompressed += len(blocks)
        count = self.count[blocks]
        ends = np.cumsum(count)
        place = np.arange(int(ends[-1])) - np.repeat(ends - count, count)
        gap_width, tf_width = np.repeat(self.gap_width[blocks], count), np.repeat(self.tf_width[blocks], count)
        at = np.repeat(self.at[blocks], count)
        docs = np.cumsum(self._read(at + place * gap_width, gap_width))
        before = np.where(blocks > self.first[number], self.lasts[blocks - 1], 0)
        shift = before - np.append(0, docs[ends[:-1] - 1])
        docs += np.repeat(shift, count)
        tf = self._read(at + np.repeat(count * self.gap_width[blocks], count) + place * tf_width, tf_width)
        return docs, impact(tf, self.damping[docs])

    def all_of(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a whole list, kept for the next query."""
        if number not in self.whole:
            self.whole[number] = self.decompress(number, np.arange(self.first[number], self.first[number + 1]))
        return self.whole[number]

    def block_of(self, number: int, docs: np.ndarray) -> np.ndarray:
        """The block of a list in which each document would be, -1 behind the last."""
        a, b = self.first[number], self.first[number + 1]
        block = a + np.searchsorted(self.lasts[a:b], docs)
        return np.where(block < b, block, -1)


# ---------------------------------------------------------------- one query in one segment


def _reachable(scores: np.ndarray, k: int, floor: int) -> int:
    """The score that a document needs to get among the best ``k``, at least ``floor``."""
    if len(scores) < k:
        return floor
    return max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))


def search_segment(
    segment: Segment, numbers: np.ndarray, weights: np.ndarray, k: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a segment and their scores: all that may be among the best ``k``.

    ``numbers`` are the query's lists here, ``weights`` their terms' weights. Documents
    under ``floor`` are left out; those just reaching it stay, since ties go by id.
    """
    bounds = np.array([w * segment.bound(n) for n, w in zip(numbers.tolist(), weights.tolist())], np.int64)
    order = np.argsort(-bounds, kind="stable")
    numbers, weights, bounds = numbers[order], weights[order], bounds[order]
    below = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # this list and all after it
    totals = np.zeros(len(segment.damping), np.int64)
    need = max(floor, 1)
    i = 0
    while i < len(numbers) and below[i] >= need:  # essential: may bring new documents
        docs, shares = segment.all_of(int(numbers[i]))
        totals[docs] += weights[i] * shares
        i += 1
        need = _reachable(totals[totals > 0], k, need)
    docs = np.flatnonzero(totals)
    docs = docs[totals[docs] + below[i] >= need]
    scores = totals[docs]
    if i == len(numbers) or not len(docs):
        return docs, scores
    # The rest only adds to these. What the blocks in which they would be allow at most:
    rest = range(i, len(numbers))
    block = np.stack([segment.block_of(int(numbers[j]), docs) for j in rest])
    most = np.where(block >= 0, segment.maxima[block] * weights[i:, None], 0)
    later = np.cumsum(most[::-1], axis=0)[::-1]
    for j in rest:
        keep = scores + later[j - i] >= need
        if not keep.all():
            docs, scores, block, later = docs[keep], scores[keep], block[:, keep], later[:, keep]
        own = np.unique(block[j - i])
        own = own[own >= 0]
        if len(own):
            listed, shares = segment.decompress(int(numbers[j]), own)
            at = np.minimum(np.searchsorted(listed, docs), len(listed) - 1)
            scores = scores + np.where(listed[at] == docs, weights[j] * shares[at], 0)
        need = _reachable(scores, k, need)
    keep = scores >= need
    return docs[keep], scores[keep]


class Heap:
    """The best documents of a query so far: most points first, then the least id."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, no_id = np.concatenate([self.ids, ids]), np.concatenate([self.no_id, no_id])
        best = np.lexsort([no_id, ids, -scores])[: self.k]
        self.scores, self.ids, self.no_id = scores[best], ids[best], no_id[best]


# ---------------------------------------------------------------- searches


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id, term`` (the term's hash) of all items."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id")
            for a, b, data, offsets in text_blocks(batch.column("text")):
                words = Words(data, offsets, ALPHANUMERIC, lower=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).take(pa.array(words.text_of())), pa.array(words.hashes().view(np.int64))],
                    names=["item_id", "term"],
                )

    narrow = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return stored(narrow.mapInArrow(terms, "item_id bigint, term bigint").distinct(), "item-terms")


def _blocks_of(terms: DataFrame, limit: int) -> Iterator[pa.Table]:
    """The items' terms in blocks of about ``limit`` rows, whole items to a block.

    Items are dealt by hash into buckets of about a quarter of the limit, and neighbouring
    buckets joined while they fit; only one item of more terms makes a larger block.
    """
    total = terms.count()
    n = max(1, min(4096, -(-4 * total // limit)))
    bucket = F.pmod(F.xxhash64("item_id"), F.lit(n))
    sizes = dict(terms.groupBy(bucket.alias("b")).count().collect())
    first, held = 0, 0
    for b in range(n + 1):
        own = sizes.get(b, 0)
        if held and (b == n or held + own > limit):
            yield terms.where((bucket >= first) & (bucket < b)).toArrow()
            first, held = b, 0
        held += own


def _frequencies(index: Index, terms: np.ndarray) -> dict[int, int]:
    """Documents that hold each of some terms (hashes, ascending)."""
    sent = index.segments.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for own, sizes in zip(batch.column("terms"), batch.column("sizes")):
                own = np.frombuffer(own.as_buffer(), "<u8")
                if len(own):
                    at = np.minimum(np.searchsorted(own, sent.value), len(own) - 1)
                    hit = own[at] == sent.value
                    totals[hit] += np.frombuffer(sizes.as_buffer(), "<i4")[at[hit]]
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sent.value[used].view(np.int64)), pa.array(totals[used])], names=["term", "df"]
        )

    rows = index.segments.select("terms", "sizes").mapInArrow(count, "term bigint, df bigint")
    return dict(rows.groupBy("term").agg(F.sum("df")).collect())


def best_documents(index: Index, items: DataFrame, k: int = TOP, search_terms: int = SEARCH_TERMS) -> DataFrame:
    """The ``k`` documents with the highest scores for each item: ``item_id, rank, doc_id,
    score``.

    An item's terms count once each, over all rows of one ``item_id`` (null ids are one
    item). A score adds up weight times impact of the item's terms in the document; only
    scores above 0 rank. Equal scores go by ascending ``doc_id``, nulls last. Items without
    terms, or whose terms occur nowhere, have no rows; nor has an empty corpus.
    """
    spark = index.segments.sparkSession
    out = None
    for block in _blocks_of(_item_terms(items), search_terms):
        term_of = block["term"].to_numpy().view(np.uint64)
        terms, term_at = np.unique(term_of, return_inverse=True)
        df = _frequencies(index, terms)
        weights = np.array(
            [term_weight(index.n_docs, df[t]) if t in df else 0 for t in terms.view(np.int64).tolist()], np.int64
        )
        queries: dict[int | None, list[int]] = {}
        for item, t in zip(block["item_id"].to_pylist(), term_at.tolist()):
            if weights[t] > 0:
                queries.setdefault(item, []).append(t)
        plan = [(item, np.array(own)) for item, own in queries.items()]
        sent = spark.sparkContext.broadcast((terms, weights, plan))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            terms, weights, plan = sent.value
            heaps = [Heap(k) for _ in plan]
            for batch in batches:
                for r in range(batch.num_rows):
                    segment = Segment(batch.slice(r, 1))
                    numbers = segment.lists(terms)
                    for (_, own), heap in zip(plan, heaps):
                        own = own[numbers[own] >= 0]
                        if len(own):
                            docs, scores = search_segment(segment, numbers[own], weights[own], k, heap.floor)
                            heap.add(scores, segment.doc_ids[docs], segment.no_id[docs])
            for (item, _), heap in zip(plan, heaps):
                n = len(heap.scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * n, pa.int64()),
                        pa.array(heap.scores),
                        pa.array(heap.ids, mask=heap.no_id),
                    ],
                    names=["item_id", "score", "doc_id"],
                )

        heaps = index.segments.mapInArrow(search, FOUND)
        salted = _first(heaps, k, F.pmod(F.xxhash64("doc_id"), F.lit(16))).drop("rank")
        part = stored(_first(salted, k), "ranked")
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], FOUND + ", rank int")
    return out.select("item_id", "rank", "doc_id", "score")


def _first(found: DataFrame, k: int, *salt: Column) -> DataFrame:
    """The best ``k`` rows of each item (and salt), with ``rank``."""
    order = Window.partitionBy("item_id", *salt).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
