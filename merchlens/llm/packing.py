"""Token ids of documents, packed into as few fixed-length sequences as possible.

Lengths are packed, not documents: a configuration linear program over the histogram of
piece lengths (at most one entry per length, whatever the corpus) is solved by
multiplicative weights, whose oracle prices configurations by a knapsack dynamic program.
Amounts are rounded down and the rest placed best-fit, again length by length. Every
piece then looks up its place by its length and its rank within that length.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.tables import set_aside, stored
from merchlens.llm.words import process_cache, span_hashes, text_blocks

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id bigint, piece int, start bigint, length int, ids binary"
#: Words whose ids a Python worker keeps from task to task.
KEPT_WORDS = 1_000_000
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)


# ---------------------------------------------------------------- token ids


def char_class(code: int) -> int:
    """White space, letter, number or other, as byte-level BPE splits text.

    What this Python's tables do not know yet, the tokenizer's may.
    """
    kind = unicodedata.category(chr(code))
    if kind == "Cn":
        return UNKNOWN
    if kind[0] == "L":
        return LETTER
    if kind[0] == "N":
        return NUMBER
    space = 9 <= code <= 13 or code in (0x20, 0x85, 0xA0) or kind in ("Zs", "Zl", "Zp")
    return SPACE if space else OTHER


def split_points(codes: np.ndarray, kinds: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """First characters of the words that byte-level BPE encodes one by one.

    ``texts`` holds the first character of each text and the total length. A space joins
    the letters, numbers or other characters after it; of a longer run of white space
    only the last character may do so or stands alone; ``'s 't 're 've 'm 'll 'd`` are
    words if nothing but a letter, number or line end comes before.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    begins = np.ones(n, bool)
    begins[1:] = kinds[1:] != kinds[:-1]
    begins[texts[texts < n]] = True
    first = np.flatnonzero(begins)
    after = np.append(first[1:], n)
    space = kinds[first] == SPACE
    ends_text = np.zeros(n + 1, bool)
    ends_text[texts] = True
    marks = begins.copy()
    # White space with something behind it in the same text: part off the last character.
    run = space & ~ends_text[after]
    last = after[run] - 1
    marks[last] = True
    joined = last[codes[last] == 0x20]
    marks[joined + 1] = False
    # An apostrophe alone, not joined to a space, before certain letters.
    alone = first[(kinds[first] == OTHER) & (after - first == 1) & (codes[first] == 0x27)]
    alone = alone[marks[alone] & ~ends_text[alone + 1]]
    if len(alone):
        one = codes[np.minimum(alone + 1, n - 1)]
        second = np.minimum(alone + 2, n - 1)
        two = np.where((alone + 2 < n) & ~ends_text[second], codes[second], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        pairs = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
        size = np.where(pairs, 2, size)
        alone, size = alone[size > 0], size[size > 0]
        marks[alone + 1] = False
        rest = alone + 1 + size
        inside = rest < n
        rest = rest[inside]
        marks[rest[(kinds[rest] == LETTER) & ~ends_text[rest]]] = True
    return np.flatnonzero(marks)


def byte_letters() -> np.ndarray:
    """The printable character that byte-level BPE writes for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = np.zeros(256, np.uint32)
    letters[printable] = printable
    others = np.setdiff1d(np.arange(256), printable)
    letters[others] = 256 + np.arange(len(others))
    return letters


def among(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in the ascending array ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


class Encoder:
    """Ids of many texts at once: every distinct word is encoded once per process.

    What is known of words lies in arrays sorted by the words' hashes. Where more than
    ``KEPT_WORDS`` are known, the half seen in the fewest blocks is forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        kept = process_cache("_merchlens_tokens")
        if kept.get("path") != path:
            kept.clear()
            tokenizer = Tokenizer.from_file(path)
            specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            # Words that are cut and spelled out already need the merges alone.
            merges = Tokenizer(tokenizer.model)
            merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            kept.update(path=path, tokenizer=tokenizer, merges=merges, specials=specials)
            kept.update(kinds=np.full(0x110000, 255, np.uint8), letters=byte_letters())
            kept.update(end=tokenizer.token_to_id(chr(kept["letters"][10])))
            kept.update(hashes=np.zeros(0, np.uint64), seen=np.zeros(0, np.uint16))
            kept.update(at=np.zeros(0, np.int64), size=np.zeros(0, np.int64), ids=np.zeros(0, np.uint32))
        self.kept, self.tokenizer = kept, kept["tokenizer"]

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        table = self.kept["kinds"]
        kinds = table[codes]
        if (kinds == 255).any():
            for code in np.unique(codes[kinds == 255]).tolist():
                table[code] = char_class(code)
            kinds = table[codes]
        return kinds

    def _word_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids of single words in a row, and the number of each word's ids."""
        letters, end = self.kept["letters"], self.kept["end"]
        flat, sizes = [], []
        for k in range(0, len(starts), 4000):  # an encoding holds far more than its ids
            a, b = starts[k : k + 4000], ends[k : k + 4000]
            n = b - a
            first = np.cumsum(n + 3) - n - 3
            text = np.full(int((n + 3).sum()), 0x20, np.uint32)
            text[first + n + 1] = letters[10]  # a line end after every word
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            own = data[np.repeat(a, n) + place]
            text[np.repeat(first, n) + place] = letters[own]
            one = self.kept["merges"].encode_batch_fast([text.tobytes().decode("utf-32-le")], add_special_tokens=False)
            ids = np.array(one[0].ids, np.uint32)
            stops = np.flatnonzero(ids == end)
            if len(stops) != len(n):  # some words hold line ends themselves: one by one
                words = [text[f : f + m].tobytes().decode("utf-32-le") for f, m in zip(first.tolist(), n.tolist())]
                found = [e.ids for e in self.kept["merges"].encode_batch_fast(words, add_special_tokens=False)]
                flat.append(np.array([i for ids in found for i in ids], np.uint32))
                sizes.append(np.array([len(ids) for ids in found], np.int64))
            else:
                flat.append(ids[ids != end])
                sizes.append(np.diff(stops, prepend=-1) - 1)
        none = [np.zeros(0, np.int64)]
        return np.concatenate(flat or none).astype(np.uint32), np.concatenate(sizes or none)

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Take up words not known so far, in order of their hashes."""
        kept = self.kept
        at = len(kept["ids"]) + np.cumsum(size) - size
        place = np.searchsorted(kept["hashes"], hashes)
        for name, values in (("hashes", hashes), ("at", at), ("size", size), ("seen", np.zeros(len(size), np.uint16))):
            kept[name] = np.insert(kept[name], place, values)
        kept["ids"] = np.concatenate([kept["ids"], ids])

    def _forget(self) -> None:
        kept = self.kept
        n = len(kept["hashes"])
        if n > KEPT_WORDS or len(kept["ids"]) > 8 * KEPT_WORDS:
            stay = np.sort(np.argsort(kept["seen"], kind="stable")[n // 2 :])
            at, size = kept["at"][stay], kept["size"][stay]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            kept.update(ids=kept["ids"][np.repeat(at, size) + place], at=first, size=size)
            kept.update(hashes=kept["hashes"][stay], seen=kept["seen"][stay] // 2)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the number of ids of each text."""
        self._forget()
        lead = (data & 0xC0) != 0x80
        at = np.append(np.flatnonzero(lead), len(data))  # byte of each character
        texts = np.searchsorted(at, offsets)
        whole = data.tobytes()
        codes = np.frombuffer(whole.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        kinds = self._kinds(codes)
        marks = split_points(codes, kinds, texts)
        starts = at[marks]
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        distinct, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        kept = self.kept
        new = ~among(kept["hashes"], distinct)
        if new.any():
            ids, size = self._word_ids(data, starts[one[new]], ends[one[new]])
            self._learn(distinct[new], ids, size)
        own = np.searchsorted(kept["hashes"], distinct)
        kept["seen"][own] += kept["seen"][own] < 65535
        number = own[inverse]
        size = kept["size"][number]
        first = np.cumsum(size) - size
        ids = kept["ids"][np.repeat(kept["at"][number] - first, size) + np.arange(int(size.sum()))]
        word = np.searchsorted(marks, texts)
        counts = np.diff(np.append(first, len(ids))[word])
        unknown = np.flatnonzero(kinds == UNKNOWN)
        odd = set(np.searchsorted(texts, unknown, "right") - 1) if len(unknown) else set()
        return self._directly(whole, offsets, ids, counts, odd)

    def _directly(self, whole, offsets, ids, counts, odd: set[int]) -> tuple[np.ndarray, np.ndarray]:
        """Texts with unknown characters, or that spell out a special token, go whole
        through the tokenizer."""
        specials = [s.encode() for s in self.kept["specials"]]
        if any(s in whole for s in specials):
            for i in range(len(counts)):
                if any(s in whole[offsets[i] : offsets[i + 1]] for s in specials):
                    odd.add(i)
        if not odd:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in sorted(odd):
            text = whole[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")
            own = self.tokenizer.encode(text, add_special_tokens=False)
            parts[i] = np.array(own.ids, np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts])


def _pieces(ids: np.ndarray, counts: np.ndarray, capacity: int, end_id: int) -> list[np.ndarray]:
    """Text number, piece, start, length of all pieces, and their ids with the end id."""
    n = len(counts)
    text = np.repeat(np.arange(n), counts)
    out = np.full(len(ids) + n, end_id, np.uint32)
    out[np.arange(len(ids)) + text] = ids
    total = counts + 1
    k = -(-total // capacity)
    doc = np.repeat(np.arange(n), k)
    piece = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
    short = np.repeat(total - (k - 1) * capacity, k)  # the first piece takes what is over
    start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
    length = np.where(piece == 0, short, capacity)
    return [doc, piece, start, length, out]


def encode_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids`` (little-endian uint32).

    A document is its text's ids and the end id; null and empty texts are the end id
    alone. Only longer documents are cut, into whole sequences; the first piece takes
    what is over. Repeated rows give repeated pieces; other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, _, data, offsets in text_blocks(batch.column("text")):
                ids, counts = encoder.encode(data, offsets)
                doc, piece, start, length, out = _pieces(ids, counts, capacity, end_id)
                edges = np.append(0, np.cumsum(length)) * 4
                column = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc),
                    [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(doc + a)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int32()),
                        column.cast(pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(encode, PIECES)


# ---------------------------------------------------------------- the linear program


def configuration_values(
    values: np.ndarray, lengths: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack with repetition: the most that each capacity is worth, and the length (its
    place in ``lengths``) put in there first, -1 where one token is left free."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        n = fitting[c]
        best[c] = best[c - 1]
        if n:
            worth = best[c - lengths[:n]] + values[:n]
            k = worth.argmax()
            if worth[k] > best[c]:
                best[c], pick[c] = worth[k], k
    return best, pick


def _configuration(pick: np.ndarray, lengths: np.ndarray, capacity: int) -> Counter:
    """How often each place of ``lengths`` is in the best configuration of a capacity."""
    out: Counter = Counter()
    while capacity > 0:
        k = int(pick[capacity])
        if k >= 0:
            out[k] += 1
        capacity -= int(lengths[k]) if k >= 0 else 1
    return out


def purchases(
    histogram: dict[int, int],
    capacity: int,
    rounds: int | None = None,
    rate: float = 0.05,
    slice_: float = 0.05,
    near: float = 0.3,
    favour: float = 0.3,
    rest: float = 0.001,
    idle: int = 3,
) -> Iterator[tuple[float, list[tuple[dict[int, int], int]]]]:
    """Round by round, what share of the tokens is left and the configurations bought.

    Multiplicative weights on the dual of the configuration program: a length starts at
    the price of its tokens, more by up to ``favour`` for long ones, so that short ones
    stay to fill the last gaps. The price is multiplied by the length's share that is
    left, against that of all tokens, to the power ``rate``. Each round prices all
    configurations at once by the knapsack program. From the longest length on, it buys
    for each the best configuration that holds it, if that fills the sequence and is
    ``near`` the best of all, as often as moves at most ``slice_`` of any of its lengths.
    Amounts are rounded down to whole numbers as they are bought. Whenever ``idle`` rounds
    found no full configuration, twice as many free tokens are allowed in one.

    Rounds end when at most ``rest`` of the tokens is left or nothing more is found.
    ``rounds``, by default four per slice and length, bounds them.
    """
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[int(n)] for n in lengths], np.int64)
    left = need.copy()
    most = np.maximum(1, (slice_ * need).astype(np.int64))
    tokens = int((need * lengths).sum())
    if rounds is None:
        rounds = 100 + int(4 / slice_) * len(lengths)
    quiet = free = 0
    for _ in range(rounds):
        share = float((left * lengths).sum()) / tokens
        if quiet >= idle:
            quiet, free = 0, max(1, 2 * free)
        if share <= rest or free > capacity:
            break
        open_ = np.flatnonzero(left)
        some, have, step = lengths[open_], left[open_], most[open_]
        behind = have / need[open_] / share
        price = some * (1 + favour * some / capacity) * behind**rate
        best, pick = configuration_values(price, some, capacity)
        enough = best[capacity - some] + price >= (1 - near) * best[capacity]
        moved = np.zeros(len(some), np.int64)
        bought = []
        for i in np.flatnonzero(enough)[::-1].tolist():
            if moved[i]:
                continue
            config = _configuration(pick, some, capacity - int(some[i]))
            config[i] += 1
            if sum(int(some[j]) * k for j, k in config.items()) < capacity - free:
                continue
            times = min(int(min(have[j], step[j]) - moved[j]) // k for j, k in config.items())
            if times < 1 and free:  # once, with what there is
                config = Counter({j: min(k, int(have[j] - moved[j])) for j, k in config.items()})
                times = int(sum(int(some[j]) * k for j, k in config.items()) >= capacity - free)
            if times > 0:
                for j, k in config.items():
                    moved[j] += k * times
                bought.append(({int(some[j]): k for j, k in config.items() if k}, times))
        left[open_] -= moved
        quiet = 0 if bought else quiet + 1
        yield float((left * lengths).sum()) / tokens, bought


def fractional_packing(
    histogram: dict[int, int], capacity: int, rounds: int | None = None
) -> list[tuple[dict[int, int], int]]:
    """All configurations that the program buys, and how often to use each."""
    return [c for _, bought in purchases(histogram, capacity, rounds) for c in bought]


def packing_plan(
    histogram: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None
) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (lengths in order of place) and whole numbers of sequences.

    Together they hold each length exactly as often as the histogram says. Best fit
    places what the program leaves. Since the last rounds may use up what best fit needs
    to fill gaps, the program is cut off after the round from which on the whole takes the
    fewest sequences; among equals, after the last. Best fit alone is taken only where it
    takes fewer than every cut.
    """
    left = {n: k for n, k in histogram.items() if k > 0}
    full = left.pop(capacity, 0)
    plan: list[tuple[tuple[int, ...], int]] = [((capacity,), full)] if full else []
    if not left:
        return plan
    program: dict[tuple[int, ...], int] = {}
    cuts = [_completed(program, left, capacity)]
    bar = 0.9
    for share, bought in purchases(left, capacity, rounds):
        for config, times in bought:
            key = _flat(config)
            program[key] = program.get(key, 0) + times
        if share <= bar:
            cuts.append(_completed(program, left, capacity))
            bar = share * 0.8
    cuts.append(_completed(program, left, capacity))
    _, program, rest = min(reversed(cuts), key=lambda cut: cut[0])
    return plan + sorted(program.items(), key=lambda c: (-c[1], c[0])) + rest


def _completed(program: dict, histogram: dict[int, int], capacity: int) -> tuple[int, dict, list]:
    """Sequences in all, the program's configurations, and best fit of what they leave."""
    left = dict(histogram)
    for config, times in program.items():
        for n in config:
            left[n] -= times
    rest = _best_fit({n: k for n, k in left.items() if k > 0}, capacity)
    return sum(program.values()) + sum(times for _, times in rest), dict(program), rest


def _flat(config: dict[int, int]) -> tuple[int, ...]:
    return tuple(n for n in sorted(config, reverse=True) for _ in range(config[n]))


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the fullest sequence that has room, for whole groups at once."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(config: tuple[int, ...], times: int) -> None:
        room = capacity - sum(config)
        if times:
            if not groups.get(room):
                rooms.insert(bisect_left(rooms, room), room)
            groups.setdefault(room, []).append((config, times))

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                config, times = groups[room].pop()
                if not groups[room]:
                    rooms.pop(i)
                many = min(room // length, count)
                used = min(times, count // many)
                put(config + (length,) * many, used)
                put(config, times - used)
                count -= many * used
            else:
                many = min(capacity // length, count)
                put((length,) * many, count // many)
                count -= many * (count // many)
    return [g for room in groups.values() for g in room]


# ---------------------------------------------------------------- places


def ranked(pieces: DataFrame, rows: int, per_part: int = 50_000) -> DataFrame:
    """``pieces`` with ``rank``: gapless from 0 within each length.

    A length is numbered in parts, salted by the piece's key, so a length that a third
    of all pieces share is sorted in many tasks.
    """
    parts = min(4096, max(1, -(-rows // per_part)))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("piece_key"), F.lit(parts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    own = Window.partitionBy("length", "salt").orderBy("piece_key")
    numbered = salted.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(firsts, ["length", "salt"]).withColumn(
        "rank", F.col("first") + F.col("own")
    ).drop("salt", "own", "first")


def place_table(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Ranges of ranks by length: the first sequence of the range, and the place in it."""
    rows, next_rank, sequence = [], {}, 0
    for config, times in plan:
        offset = 0
        for length in config:
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, offset))
            next_rank[length] = rank + times
            offset += length
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), columns))


def packed(pieces: DataFrame, capacity: int = CAPACITY, rounds: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` has ``length`` from 1 to ``capacity`` and any other columns; those named
    like the new ones are replaced. Every piece lies in one sequence, pieces of a
    sequence follow each other without a gap, and no sequence is longer than
    ``capacity``. No pieces give no sequences. What the driver holds is one number per
    length and the plan made from it.
    """
    own, back = set_aside(pieces.drop("sequence_id", "offset"), "length")
    keyed = stored(own.withColumn("piece_key", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in keyed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return keyed.select(
            *back.values(), F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).alias("offset")
        )
    table = place_table(packing_plan(histogram, capacity, rounds))
    spark = pieces.sparkSession
    sent = spark.sparkContext.broadcast(table)
    rows = ranked(keyed, sum(histogram.values())).drop("piece_key")
    schema = rows.drop("rank").schema.add("sequence_id", "long").add("offset", "integer")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        keys = (own["length"] << 48) + own["rank"]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy().astype(np.int64) << 48) + rank, "right") - 1
            rest = batch.drop_columns(["rank"])
            sequence = own["sequence"][at] + rank - own["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(sequence, pa.int64()), pa.array(own["offset"][at], pa.int32())],
                names=[*rest.schema.names, "sequence_id", "offset"],
            )

    return rows.mapInArrow(place, schema).select(*back.values(), "sequence_id", "offset")
