"""Token ids of a corpus in files of Huffman-coded blocks, in the order of the documents.

A token store is a folder of three tables. ``code`` has one row: the length in bits of each
id's word, which fixes a canonical code. ``blocks`` holds the words of whole documents, bit
behind bit, and the bit offsets (checkpoints) at which every ``step``-th id begins, so a block
is decoded alone and all its stretches side by side. ``index`` says how many ids come before
each part, so any document's place in the whole is known without reading what is before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.llm.packing import Encoder
from merchlens.llm.tables import stored
from merchlens.llm.words import text_blocks

END_ID = 0
#: Longest word of the code; the decoding table has two to this power entries.
MAX_BITS = 20
#: Ids between two checkpoints.
STEP = 256
#: Bytes of text that one task sorts and encodes.
PART_BYTES = 48 << 20
PLAIN = "part int, seq int, before bigint, doc_ids array<bigint>, sizes array<bigint>, ids binary"
CODED = """part int, seq int, before bigint, doc_ids array<bigint>, sizes array<bigint>,
    checkpoints binary, payload binary"""
READ = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


# ---------------------------------------------------------------- the code


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each id's word in the best prefix code of words of at most ``limit`` bits.

    Package-merge: ``limit`` times the ids' counts are merged with pairs of the round
    before; an id's length is the number of rounds whose cheapest items include it. Ids
    that do not occur get 0, a single id gets 1. ``limit`` is raised where there are more
    ids than words.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, (n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    coins = np.asarray(counts, np.int64)[order]
    rounds: list[np.ndarray] = []
    items = np.zeros(0, np.int64)
    for _ in range(limit):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([coins, pairs])
        place = np.argsort(both, kind="stable")
        rounds.append(place < n)
        items = both[place]
    taken = 2 * n - 2
    for is_coin in reversed(rounds):
        own = int(is_coin[:taken].sum())
        lengths[order[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


def canonical_code(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids in the order of their words, each id's word, and the longest word's length.

    Words are numbered by length, then id.
    """
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    longest = int(lengths.max(initial=0))
    bits = lengths[order].astype(np.int64)
    spans = np.int64(1) << (longest - bits)
    words = np.zeros(len(lengths), np.uint64)
    words[order] = (np.cumsum(spans) - spans) >> (longest - bits)
    return order, words, longest


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every run of as many bits as the longest word has: the id it begins with times
    32, plus that word's length; and the number of bits."""
    order, _, longest = canonical_code(lengths)
    spans = np.int64(1) << (longest - lengths[order].astype(np.int64))
    entries = (order.astype(np.uint32) << np.uint32(5)) + lengths[order]
    table = np.zeros(1 << longest, np.uint32)
    filled = np.repeat(entries, spans)
    table[: len(filled)] = filled
    return table, longest


def encode_block(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray, step: int = STEP):
    """The ids' words bit behind bit, and the bit offsets of every ``step``-th id."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    begin = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total // 64 + 1, np.uint64)
    if len(ids):
        own = words[ids]
        cell = begin >> 6
        free = 64 - (begin & 63) - bits  # below 0 where a word goes on in the next cell
        over = np.flatnonzero(free < 0)
        first = np.where(free < 0, own >> np.maximum(-free, 0).astype(np.uint64), own << np.maximum(free, 0).astype(np.uint64))
        new = np.flatnonzero(np.diff(cell, prepend=-1))
        out[cell[new]] = np.bitwise_or.reduceat(first, new)
        out[cell[over] + 1] |= own[over] << (64 + free[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: -(-total // 8)], begin[::step]


def decode_block(
    payload: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, longest: int, step: int = STEP
) -> np.ndarray:
    """The ``n`` ids of a block: all stretches between checkpoints advance together."""
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    windows = (data[:-3] << np.uint32(24)) | (data[1:-2] << np.uint32(16)) | (data[2:-1] << np.uint32(8)) | data[3:]
    at = checkpoints.astype(np.int64)
    end = 8 * len(payload)
    rest = np.uint32(32 - longest)
    rows = min(step, n)
    out = np.empty((rows, len(at)), np.uint32)
    for k in range(rows):
        entry = table[(windows[at >> 3] << (at & 7).astype(np.uint32)) >> rest]
        out[k] = entry >> np.uint32(5)
        at = np.minimum(at + (entry & np.uint32(31)), end)  # the last stretch ends early
    return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- writing


def _one(schema: pa.Schema, row: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([value], kind) for value, kind in zip(row, schema.types)], schema=schema
    )


def plain_blocks(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The documents' ids in ascending order of ``doc_id``, some documents to a row; stored.

    A document is its text's ids and ``end_id``; null and empty texts are ``end_id`` alone.
    Null ids come first; documents of one id follow each other by a hash of their texts,
    and equal rows stay apart. Parts are ranges of documents, not of ids, so rows of one id
    may lie in several. Other columns are ignored. ``docs`` is read twice and must give its
    rows in the same order, as files and stored tables do.
    """
    from tokenizers import Tokenizer

    wide = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) > 1 << 16
    kind = np.uint32 if wide else np.uint16
    schema = pa.schema(
        [
            ("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b, data, offsets in text_blocks(batch.column("text")):
                ids, counts = encoder.encode(data, offsets)
                out = np.full(len(ids) + b - a, end_id, kind)
                out[np.arange(len(ids)) + np.repeat(np.arange(b - a), counts)] = ids
                yield _one(schema, [part, seq, before, doc_ids[a:b], counts + 1, out.tobytes()])
                seq, before = seq + 1, before + len(out)

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    total = narrow.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    keyed = narrow.withColumn("same", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    keys = ["doc_id", "same", "row"]
    ranged = keyed.repartitionByRange(max(1, -(-total // part_bytes)), *keys).sortWithinPartitions(*keys)
    return stored(ranged.select("doc_id", "text").mapInArrow(encode, PLAIN), "ids", compression="zstd")


def _ids(binary: pa.Scalar, n: int) -> np.ndarray:
    """Ids from the bytes of ``n`` of them, two or four to each."""
    data = binary.as_buffer()
    return np.frombuffer(data, np.uint32 if len(data) == 4 * n else np.uint16)


def id_counts(blocks: DataFrame) -> dict[int, int]:
    """How often each id occurs; at most one entry per word of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(0, np.int64)
        for batch in batches:
            for sizes, binary in zip(batch.column("sizes"), batch.column("ids")):
                ids = _ids(binary, sum(sizes.as_py()))
                own = np.bincount(ids, minlength=len(totals))
                own[: len(totals)] += totals
                totals = own
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["id", "n"])

    rows = blocks.select("sizes", "ids").mapInArrow(count, "id bigint, n bigint")
    return {r["id"]: r["n"] for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    max_bits: int = MAX_BITS,
    step: int = STEP,
) -> None:
    """Write a token store of ``doc_id, text`` to a new folder; see ``plain_blocks``.

    No documents give a store without blocks. The ids are made once and stored; a lost
    executor repeats single parts or blocks. The driver holds one count per id.
    """
    plain = plain_blocks(docs, tokenizer_path, end_id)
    totals = id_counts(plain)
    counts = np.zeros(max(totals, default=-1) + 1, np.int64)
    counts[list(totals)] = list(totals.values())
    lengths = code_lengths(counts, max_bits)
    code = [(bytearray(lengths.tobytes()), step)]
    docs.sparkSession.createDataFrame(code, "lengths binary, step int").coalesce(1).write.parquet(f"{path}/code")
    schema = pa.schema(
        [
            ("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
            ("checkpoints", pa.binary()), ("payload", pa.binary()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, words, _ = canonical_code(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq, before, doc_ids, sizes = (batch.column(k)[i].as_py() for k in range(5))
                payload, marks = encode_block(_ids(batch.column("ids")[i], sum(sizes)), words, lengths, step)
                yield _one(schema, [part, seq, before, doc_ids, sizes, marks.astype("<i8").tobytes(), payload])

    blocks = plain.mapInArrow(encode, CODED)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    written = docs.sparkSession.read.schema(CODED).parquet(f"{path}/blocks")
    sizes = written.select(
        "part", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda acc, n: acc + n).alias("n")
    ).groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    first = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    sizes.select("part", first).coalesce(1).write.parquet(f"{path}/index")


# ---------------------------------------------------------------- reading


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: every document of a token store.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian unsigned
    32-bit numbers, the end id included. Blocks are decoded one by one in any order.
    """
    code = spark.read.parquet(f"{path}/code").first()
    lengths, step = np.frombuffer(bytes(code["lengths"]), np.uint8), code["step"]
    index = spark.read.schema("part int, first bigint").parquet(f"{path}/index")
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks").join(index, "part")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, longest = decoding_table(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
                marks = np.frombuffer(batch.column("checkpoints")[i].as_buffer(), "<i8")
                payload = batch.column("payload")[i].as_py()
                ids = decode_block(payload, marks, int(sizes.sum()), table, longest, step)
                first = batch.column("first")[i].as_py() + batch.column("before")[i].as_py()
                edges = np.append(0, np.cumsum(sizes))
                column = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(sizes),
                    [None, pa.py_buffer((4 * edges).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("doc_ids")[i].as_py(), pa.int64()),
                        pa.array(first + edges[:-1]),
                        pa.array(sizes),
                        column.cast(pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(decode, READ)
