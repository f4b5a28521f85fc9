"""Benchmark passages in training text, found in a distributed positional inverted index.

The index is cut by document: a segment holds whole documents of a few megabytes, its
terms and each term's positions. No posting is shuffled, so a common term weighs on each
segment alike. A search takes the test passages in blocks of bounded size and, in every
segment, intersects the offset-adjusted position lists of a passage from its rarest term
on. The index serves any number of searches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.tables import set_aside, small, stored
from merchlens.llm.words import ALPHANUMERIC, Words, bytes_and_offsets, text_blocks

WIDTH = 13
SEGMENT_BYTES = 2 << 20
#: Bytes of test texts that one search holds in memory; more are searched block by block.
SEARCH_BYTES = 8 << 20
INDEX = """segment string, doc_ids array<bigint>, bounds array<int>, terms binary,
    lists array<int>, postings binary"""
FOUND = """segment string, ordinal int, doc_id bigint, n_words bigint,
    runs array<struct<start:int,end:int>>, item_ids array<bigint>"""
NEAR = "segment string, ordinal int, doc_id bigint, item_id bigint, start int, end int"


def _segment(data: np.ndarray, offsets: np.ndarray) -> dict:
    """Terms of some texts, in order of their hashes, and their positions, as steps."""
    words = Words(data, offsets, ALPHANUMERIC, lower=True)
    hashes = words.hashes()
    order = np.argsort(hashes, kind="stable").astype(np.int32)
    ranked = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    lists = np.flatnonzero(new).astype(np.int32)
    steps = order.copy()
    steps[1:] -= order[:-1]
    steps[lists] = order[lists]
    whole = words.data.tobytes()
    first = order[lists]
    terms = [
        whole[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist())
    ]
    return {
        "bounds": words.bounds.astype(np.int32),
        "terms": b"\n".join(terms),
        "lists": np.append(lists, np.int32(len(order))),
        "postings": steps.tobytes(),
    }


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The stored index of ``doc_id, text``: one row per segment of whole documents.

    Words are runs of ASCII letters, digits and characters outside ASCII, with A-Z in
    lower case. Null and empty texts are documents without words; repeated rows are
    documents of their own; other columns are ignored.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        number = 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for a, b, data, offsets in text_blocks(batch.column("text"), segment_bytes):
                part = _segment(data, offsets)
                name = f"{TaskContext.get().partitionId()}-{number}"
                number += 1
                schema = schema or pa.schema(
                    [
                        ("segment", pa.string()),
                        ("doc_ids", pa.list_(pa.int64())),
                        ("bounds", pa.list_(pa.int32())),
                        ("terms", pa.binary()),
                        ("lists", pa.list_(pa.int32())),
                        ("postings", pa.binary()),
                    ]
                )
                row = [name, ids[a:b], part["bounds"], part["terms"], part["lists"], part["postings"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value], kind.type) for value, kind in zip(row, schema)], schema=schema
                )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return stored(narrow.mapInArrow(segments, INDEX), "postings")


class Segment:
    """A row of the index, ready for searches."""

    def __init__(self, row: dict):
        self.name = row["segment"]
        self.doc_ids = row["doc_ids"]
        self.bounds = np.asarray(row["bounds"], np.int64)
        self.lists = np.asarray(row["lists"], np.int64)
        steps = np.frombuffer(row["postings"], np.int32).astype(np.int64)
        if len(steps):
            sums = np.cumsum(steps)
            firsts = self.lists[:-1]
            before = sums[firsts] - steps[firsts]
            self.positions = sums - np.repeat(before, np.diff(self.lists))
            self.terms = {t: i for i, t in enumerate(row["terms"].split(b"\n"))}
        else:
            self.positions, self.terms = steps, {}
        numbers = np.repeat(np.arange(len(self.lists) - 1), np.diff(self.lists))
        self.keys = (numbers << 32) + self.positions

    def numbers(self, terms: list[bytes]) -> np.ndarray:
        """Each term's number in this segment, -1 where it does not occur."""
        get = self.terms.get
        return np.fromiter((get(t, -1) for t in terms), np.int64, len(terms))

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        counts = np.append(np.diff(self.lists), 0)
        return counts[numbers]

    def holds(self, numbers: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether the term stands at the position, for each pair."""
        keys = (numbers << 32) + positions
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return self.keys[at] == keys

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, "right") - 1


class Passages:
    """Windows of a block of test items: rows of term numbers, padded with -1.

    ``items`` and ``item_at`` list the items of each window; equal windows are one.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], width: int):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        for k, (_, words) in enumerate(items):
            numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
            for a in range(max(1, len(numbers) - width + 1) if numbers else 0):
                windows.setdefault(tuple(numbers[a : a + width]), set()).add(k)
        self.terms = list(vocabulary)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.windows = np.full((len(windows), width), -1, np.int64)
        for r, w in enumerate(windows):
            self.windows[r, : len(w)] = w
        self.item_at = np.cumsum([0, *map(len, windows.values())])
        self.items = np.array([k for s in windows.values() for k in sorted(s)], np.int64)


def _phrases(segment: Segment, passages: Passages) -> tuple[np.ndarray, np.ndarray]:
    """Window numbers and first positions of all exact occurrences in a segment.

    The lists are intersected from a window's rarest term on; a window with an absent
    term costs nothing more.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(passages.windows) or not len(segment.positions):
        return none
    numbers = np.append(segment.numbers(passages.terms), -2)  # padding takes the last
    grid = numbers[passages.windows]
    live = np.flatnonzero(~(grid == -1).any(axis=1))
    if not len(live):
        return none
    grid = grid[live]
    sizes = np.where(grid == -2, np.iinfo(np.int64).max, segment.sizes(np.maximum(grid, -1)))
    order = np.argsort(sizes, axis=1, kind="stable")
    rows = np.arange(len(live))
    rarest = grid[rows, order[:, 0]]
    n = segment.sizes(rarest)
    row = np.repeat(rows, n)
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = segment.positions[segment.lists[rarest][row] + within] - order[row, 0]
    for k in range(1, grid.shape[1]):
        place = order[row, k]
        term = grid[row, place]
        keep = (term == -2) | segment.holds(term, start + place)
        row, start = row[keep], start[keep]
    last = start + passages.lengths[live[row]] - 1
    inside = (start >= 0) & (segment.doc_of(start) == segment.doc_of(last))
    return live[row[inside]], start[inside]


def _runs(hit: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
    """Covered stretches of each document, in its own word numbers."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        d = int(np.searchsorted(bounds, a, "right")) - 1
        while a < b:  # a stretch may go on into the next document
            end = min(b, int(bounds[d + 1]))
            if end > a:
                out[d].append({"start": a - int(bounds[d]), "end": end - int(bounds[d])})
            a, d = end, d + 1
    return out


def _blocks_of(items: DataFrame, search_bytes: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The test items as lists of words, in blocks of about ``search_bytes``."""
    narrow = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // search_bytes) or 1
    part = F.pmod(F.xxhash64("item_id"), F.lit(n))
    for k in range(n):
        own = narrow.where(part == k) if n > 1 else narrow
        block = own.toArrow()
        data, offsets = bytes_and_offsets(block["text"].combine_chunks())
        words = Words(data, offsets, ALPHANUMERIC, lower=True)
        whole = words.data.tobytes()
        spans = list(zip(words.starts.tolist(), words.ends.tolist()))
        ids = block["item_id"].to_pylist()
        yield [
            (ids[i], [whole[a:b] for a, b in spans[words.bounds[i] : words.bounds[i + 1]]])
            for i in range(len(ids))
        ]


def phrase_matches(
    index: DataFrame, items: DataFrame, width: int = WIDTH, search_bytes: int = SEARCH_BYTES
) -> DataFrame:
    """What exact windows of the test items cover in each indexed document.

    A window is ``width`` consecutive words of an item, or all words of a shorter item.
    One row per indexed document, also those without a match: ``segment, ordinal, doc_id,
    n_words, runs`` (covered stretches, in word numbers, ends exclusive) and ``item_ids``
    (those with an occurring window, in no order). Windows never span two documents.
    Items without words match nothing; repeated items are one.
    """
    spark = index.sparkSession
    parts = []
    for block in _blocks_of(items, search_bytes):
        sent = spark.sparkContext.broadcast(Passages(block, width))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            passages = sent.value
            for batch in batches:
                for i in range(batch.num_rows):
                    segment = Segment(batch.slice(i, 1).to_pylist()[0])
                    yield _found(segment, passages)

        parts.append(index.mapInArrow(search, FOUND))
    if len(parts) == 1:
        return parts[0]
    return _merged(parts)


def _found(segment: Segment, passages: Passages) -> pa.RecordBatch:
    window, start = _phrases(segment, passages)
    n = len(segment.positions)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + passages.lengths[window], -1)
    runs = _runs(np.cumsum(edges)[:-1] > 0, segment.bounds)
    items: list[set[int]] = [set() for _ in segment.doc_ids]
    for w, d in zip(window.tolist(), segment.doc_of(start).tolist()):
        for k in passages.items[passages.item_at[w] : passages.item_at[w + 1]].tolist():
            items[d].add(passages.ids[k])
    docs = len(segment.doc_ids)
    run = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([segment.name] * docs, pa.string()),
            pa.array(range(docs), pa.int32()),
            pa.array(segment.doc_ids, pa.int64()),
            pa.array(np.diff(segment.bounds), pa.int64()),
            pa.array(runs, pa.list_(run)),
            pa.array([list(s) for s in items], pa.list_(pa.int64())),
        ],
        names=["segment", "ordinal", "doc_id", "n_words", "runs", "item_ids"],
    )


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Results of several blocks as one row per document, with stretches united."""
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    one = every.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
    )
    united = F.expr("""
        aggregate(runs, cast(array() AS array<struct<start:int,end:int>>), (acc, r) ->
            CASE WHEN size(acc) > 0 AND element_at(acc, -1).end >= r.start
                 THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct(
                     'start', element_at(acc, -1).start,
                     'end', greatest(element_at(acc, -1).end, r.end))))
                 ELSE concat(acc, array(r)) END)""")
    return one.withColumn("runs", united)


def proximity_matches(
    index: DataFrame, items: DataFrame, within: int, search_bytes: int = SEARCH_BYTES
) -> DataFrame:
    """Places where all words of an item stand within ``within`` words, in any order.

    ``segment, ordinal, doc_id, item_id, start, end``: the shortest stretch around each
    occurrence of the item's rarest term in the segment, once each.
    """
    spark = index.sparkSession
    out = None
    for block in _blocks_of(items, search_bytes):
        sent = spark.sparkContext.broadcast([(i, sorted(set(w))) for i, w in block if w])

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    segment = Segment(batch.slice(i, 1).to_pylist()[0])
                    rows = [
                        (segment.name, d, segment.doc_ids[d], item, a, b)
                        for item, terms in sent.value
                        for d, a, b in _near(segment, terms, within)
                    ]
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                        names=["segment", "ordinal", "doc_id", "item_id", "start", "end"],
                    )

        part = index.mapInArrow(search, NEAR)
        out = part if out is None else out.union(part)
    return out


def _near(segment: Segment, terms: list[bytes], within: int) -> set[tuple[int, int, int]]:
    numbers = segment.numbers(terms)
    if (numbers < 0).any():
        return set()
    lists = [segment.positions[segment.lists[t] : segment.lists[t + 1]] for t in numbers]
    lists.sort(key=len)
    anchors = lists[0]
    for other in lists[1:]:  # some occurrence not too far away
        a = np.searchsorted(other, anchors - within + 1)
        anchors = anchors[a < np.searchsorted(other, anchors + within - 1, "right")]
    found = set()
    for p in anchors.tolist():
        d = int(segment.doc_of(np.array([p]))[0])
        low = max(p - within + 1, int(segment.bounds[d]))
        high = min(p + within, int(segment.bounds[d + 1]))
        near = [(p, 0)]
        for k, other in enumerate(lists[1:], 1):
            a, b = np.searchsorted(other, [low, high])
            near += [(q, k) for q in other[a:b].tolist()]
        near.sort()
        last: dict[int, int] = {}
        best = None
        for q, k in near:
            last[k] = q
            if len(last) == len(lists):
                a = min(last.values())
                if a <= p <= q and q - a < within and (best is None or q - a < best[1] - best[0]):
                    best = (a, q)
        if best:
            first = int(segment.bounds[d])
            found.add((d, best[0] - first, best[1] + 1 - first))
    return found


def judged(found: DataFrame) -> DataFrame:
    """``found`` with ``n_hit`` and ``contaminated``: at least a twentieth is covered."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def decontaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents whose id is that of a contaminated one.

    Clean documents and those with a null id stay as they are, repeated rows included.
    """
    found = judged(phrase_matches(build_index(docs), items, width))
    bad = stored(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    own, back = set_aside(docs, "doc_id", "text")
    return own.join(small(bad, bad.count()), "doc_id", "left_anti").select(*back.values())
