"""Lines that an earlier line of the corpus already says: an exact set-similarity join.

A line is the set of its word shingles. Of lines with equal sets all but the earliest go
at once. For the rest shingles are ordered by rarity, a line puts forward a prefix, and
two lines that meet at a shingle are candidates if their sizes and the shingle's
positions leave the likeness possible. Candidates are verified on the whole sets, and the
later line of each match is removed.

Lines are only asked whether an earlier match exists, so where very many meet at one
shingle no pairs are made: blocks of them are compared inside tasks, and only lines still
without a match meet the other blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.ngram_join import Likeness, common_shingles, overlaps
from merchlens.llm.tables import KeyFilter, set_aside, small, stored
from merchlens.llm.words import SPACED, Words, distinct_per_text, mix, shingles, stable_order, text_blocks

HOT = 64
BLOCK_LINES = 2048
#: A line's place in the corpus.
PLACE = ("doc_id", "hash", "line")


def _lines(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row and number of each line with ``width`` words or more, its set, and the size."""
    for a, _, part, own in text_blocks(batch.column("text")):
        if not len(part):
            continue
        breaks = np.flatnonzero(part == 10)
        starts = np.union1d(own[:-1], breaks + 1)
        starts = starts[starts < len(part)]
        doc = np.searchsorted(own, starts, "right") - 1
        number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, own[doc])
        words = Words(part, np.append(starts, len(part)), SPACED, lower=True)
        values, counts = shingles(words, width)
        long = words.counts >= width
        values = values[np.repeat(long, counts)]
        values, counts = distinct_per_text(values, counts[long])
        yield doc[long] + a, number[long], values, counts


def _prints(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set; equal sets have equal sums."""
    out = []
    for salt in (1, 2):
        sums = np.append(np.uint64(0), np.cumsum(mix(mix(values + np.uint64(salt)))))
        ends = np.cumsum(counts)
        out.append((sums[ends] - sums[ends - counts]).view(np.int64))
    return out


def _with_hash(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("hash"), text.alias("text"))


def line_profiles(docs: DataFrame, like: Likeness) -> DataFrame:
    """One stored row per line: ``row``, its place, size ``n``, prints ``p, q``, ``tokens``."""
    sent = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, like.width))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often = sent.value
        for batch in batches:
            for row, number, values, counts in _lines(batch, like.width):
                line = np.repeat(np.arange(len(counts)), counts)
                weight = np.zeros(len(values), np.int64)
                if len(common):
                    at = np.searchsorted(common, values)
                    at[at == len(common)] = 0
                    known = common[at] == values
                    weight[known] = often[at[known]]
                order = np.argsort(weight, kind="stable")
                order = order[stable_order(line[order], len(counts))]
                first = np.cumsum(counts) - counts
                place = np.arange(len(values)) - np.repeat(first, counts)
                length = counts - like.least_overlap(counts) + 1
                put = place < np.repeat(length, counts)
                p, q = _prints(values, counts)
                tokens = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(length)), pa.int32()),
                    pa.array(values[order][put].view(np.int64)),
                )
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("hash").take(rows),
                        pa.array(number, pa.int32()),
                        pa.array(counts, pa.int32()),
                        pa.array(p),
                        pa.array(q),
                        tokens,
                    ],
                    names=[*PLACE, "n", "p", "q", "tokens"],
                )

    schema = "doc_id long, hash long, line int, n int, p long, q long, tokens array<long>"
    made = _with_hash(docs).mapInArrow(profile, schema)
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "line-profiles")


def _place() -> Column:
    return F.struct(*PLACE)


def _line_sets(docs: DataFrame, needed: DataFrame, like: Likeness) -> DataFrame:
    """Stored ``row, place, shingles`` of the ``needed`` lines, from the texts.

    Tasks are sent the numbers of the documents and the prints of the lines, so only sets
    that are needed leave them.
    """
    of_docs, of_lines = KeyFilter(needed, "doc_id"), KeyFilter(needed, "p")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(of_docs.passes(batch.column("doc_id"))))
            for _, _, values, counts in _lines(some, like.width):
                cuts = np.append(0, np.cumsum(counts))
                p, q = _prints(values, counts)
                keep = np.flatnonzero(of_lines.passes(pa.array(p)))
                own = [values[cuts[i] : cuts[i + 1]].tobytes() for i in keep.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[keep]), pa.array(q[keep]), pa.array(own, pa.binary())], names=["p", "q", "shingles"]
                )

    made = _with_hash(docs).mapInArrow(sets, "p long, q long, shingles binary")
    named = needed.select("p", "q", "row", _place().alias("place"))
    found = made.join(named, ["p", "q"])
    # Lines with equal sets, and rows that repeat, give a set several times.
    return stored(found.select("row", "place", "shingles"), "line-sets").dropDuplicates(["row"])


def _candidates(live: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of lines ``a, b`` that pass the length and positional filters at a shingle."""
    a = live.select("token", *[F.col(c).alias(f"a_{c}") for c in ("row", "n", "at")])
    b = live.select("token", *[F.col(c).alias(f"b_{c}") for c in ("row", "n", "at")])
    least = F.expr(f"({like.num} * (a_n + b_n) + {like.num + like.den - 1}) div {like.num + like.den}")
    rest = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    fits = (
        (F.col("b_row") < F.col("a_row"))
        & (like.den * F.least("a_n", "b_n") >= like.num * F.greatest("a_n", "b_n"))
        & (rest >= least)
    )
    # Two sets that reach the overlap meet first at a shingle that passes.
    pairs = a.join(b, "token").where(fits)
    return pairs.select(F.col("a_row").alias("a"), F.col("b_row").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """``row`` of the later line of each pair that matches."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(bool(like.linked(both, len(a), len(b))))
            yield batch.select(["row"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("row").alias(name), F.col("place").alias(f"{name}_place"), F.col("shingles").alias(f"{name}_set")
        )

    whole = pairs.join(side("a"), "a").join(side("b"), "b")
    later = F.when(F.col("a_place") > F.col("b_place"), F.col("a")).when(
        F.col("a_place") < F.col("b_place"), F.col("b")
    )
    whole = whole.select(later.alias("row"), "a_set", "b_set").where("row IS NOT NULL")
    return whole.mapInArrow(verify, "row long").distinct()


def _matched_in(groups: DataFrame, keys: list[str], like: Likeness) -> DataFrame:
    """``row`` of the lines that ask and have an earlier match in their group."""

    def match(group: pa.Table) -> pa.Table:
        rows = group["row"].to_numpy()
        asks = group["asks"].to_numpy(zero_copy_only=False)
        order = np.lexsort((~asks, rows))
        one = order[np.append(True, rows[order][1:] != rows[order][:-1])]
        shingle, place = group["shingles"].to_pylist(), group["place"].to_pylist()
        sets = [np.frombuffer(shingle[i], np.uint64) for i in one.tolist()]
        places = [tuple((v is not None, v or 0) for v in place[i].values()) for i in one.tolist()]
        number = {p: k for k, p in enumerate(sorted(set(places)))}
        rank = np.array([number[p] for p in places])
        n = np.array([len(s) for s in sets], np.int64)
        linked = like.linked(overlaps(sets), n[:, None], n[None, :]) & (rank[None, :] < rank[:, None])
        return pa.table({"row": rows[one][linked.any(axis=1) & asks[one]]})

    groups = groups.select(*keys, "row", "place", "shingles", "asks")
    return groups.groupBy(*keys).applyInArrow(match, "row long")


def _hot_matches(hot: DataFrame, sets: DataFrame, like: Likeness, block: int) -> DataFrame:
    """Lines with an earlier match among those they meet at hot shingles."""
    members = hot.groupBy("token").agg(
        F.count("*").alias("df"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("x"),
        F.bit_xor(F.xxhash64("row", F.lit(2))).alias("y"),
    )
    # Shingles at which the same lines meet are one.
    tokens = members.groupBy("df", "x", "y").agg(F.min("token").alias("token"))
    tokens = tokens.select("token", F.ceil(F.col("df") / block).alias("blocks"))
    dealt = hot.select("token", "row").join(tokens, "token")
    dealt = stored(dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))), "line-blocks")
    asked = dealt.join(sets, "row").withColumn("asks", F.lit(True))
    inside = stored(_matched_in(asked, ["token", "block"], like).distinct(), "line-matches")
    wide = dealt.where("blocks > 1")
    if not wide.limit(1).count():
        return inside
    left = wide.join(inside, "row", "left_anti")
    counts = left.groupBy("token").agg(F.ceil(F.count("*") / block).alias("cuts"))
    left = left.join(counts, "token").withColumn("cut", F.pmod(F.xxhash64("row", F.lit(3)), F.col("cuts")))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asking = left.select("token", "cut", every("blocks").alias("block"), "row", F.lit(True).alias("asks"))
    answering = wide.join(counts, "token").select(
        "token", every("cuts").alias("cut"), "block", "row", F.lit(False).alias("asks")
    )
    across = asking.union(answering).join(sets, "row")
    return inside.union(_matched_in(across, ["token", "cut", "block"], like))


def later_matches(
    docs: DataFrame, like: Likeness = Likeness(), hot_from: int = HOT, block: int = BLOCK_LINES
) -> DataFrame:
    """``doc_id, hash, removed``: the numbers of the lines of a document that go.

    Lines are parted by line feeds and numbered from 0; their words are divided by ASCII
    white space, with A-Z in lower case. A line goes if an earlier line of the corpus, by
    ``doc_id``, then text hash, then number, has a set of shingles as alike as ``like``
    asks, whether or not the earlier line goes itself. Lines with fewer words than a
    shingle have no set and stay, so null and empty texts lose nothing.
    """
    lines = line_profiles(docs, like).withColumn("place", _place())
    again = lines.groupBy("p", "q").agg(F.count("*").alias("copies"), F.min("place").alias("first"))
    again = stored(again.where("copies > 1").drop("copies"), "repeated-lines")
    own = lines.join(small(again, again.count()), ["p", "q"], "left")
    copy = F.col("first").isNotNull() & (F.col("place") != F.col("first"))
    postings = own.where(~copy).select("row", "n", F.posexplode("tokens").alias("at", "token"))
    shared = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    live = stored(postings.join(shared, "token"), "line-postings")
    cold, hot = live.where(F.col("df") <= hot_from), live.where(F.col("df") > hot_from)
    pairs = stored(_candidates(cold, like), "line-candidates")
    rows = pairs.select(F.explode(F.array("a", "b")).alias("row")).union(hot.select("row")).distinct()
    rows = stored(rows, "line-rows")
    needed = lines.join(small(rows, rows.count()), "row", "left_semi")
    sets = _line_sets(docs, stored(needed.select("row", *PLACE, "p", "q"), "line-needed"), like)
    matched = _verified(pairs, sets, like).union(_hot_matches(hot, sets, like, block)).distinct()
    matched = stored(matched.withColumn("goes", F.lit(True)), "line-verdicts")
    judged = own.join(small(matched, matched.count()), "row", "left").where(F.col("goes") | copy)
    # A document's own lines; rows that repeat an id and a text are one document.
    gone = judged.select(*PLACE).distinct().groupBy("doc_id", "hash")
    return stored(gone.agg(F.array_sort(F.collect_list("line")).alias("removed")), "removed-lines")


def deduplicated(docs: DataFrame, like: Likeness = Likeness(), **sizes) -> DataFrame:
    """``docs`` without the lines of :func:`later_matches`.

    The other lines, blank ones too, stay as they are and in order. A document that
    loses a line and has no word left goes itself. Rows that repeat an id and a text are
    one document, of which one row stays if it has a line with a set. ``n_chars``, where
    there is such a column, follows the text.
    """
    gone = later_matches(docs, like, **sizes)
    count = gone.count()
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), "removed")
    gone = gone.withColumnRenamed("removed", "__removed")
    own, back = set_aside(docs, "doc_id", "text", "n_chars")
    own = own.withColumn("__text_hash", F.xxhash64(F.col("text").cast("string")))
    joined = own.join(
        small(gone, count),
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")),
        "left",
    )
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains("__removed", i))
    touched = F.col("__removed").isNotNull()
    joined = joined.withColumn(
        "__new", F.when(touched, F.concat_ws("\n", kept)).otherwise(F.col("text"))
    )
    joined = joined.where(~touched | F.col("__new").rlike(r"[^\x20\x09-\x0D]"))
    values = {"text": F.col("__new")}
    if "n_chars" in docs.columns:
        length = F.length("__new").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(touched, length).otherwise(F.col("n_chars"))
    out = joined.select(*[values.get(c, column).alias(c) for c, column in back.items()])
    again = own.groupBy("doc_id", "__text_hash").agg(F.count("*").alias("n")).where("n > 1")
    return out.dropDuplicates(["doc_id", "text"]) if again.limit(1).count() else out
