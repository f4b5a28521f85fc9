"""Ranked search, vector codes and token files against plain loops, on small hard cases."""

import hashlib
import itertools
import math
import re
import struct
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import lexical_search, queries, token_files, vector_codes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


# ---------------------------------------------------------------- ranked search


def ranked(docs, items, k):
    """{(item_id, rank): (doc_id, score)} by scoring every document for every item."""
    terms = [(d, Counter(TERM.findall(brute.lower(t)))) for d, t in docs]
    n_docs = sum(1 for _, c in terms if c)
    total = sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall(brute.lower(text)))
    out = {}
    for item, own in wanted.items():
        found = []
        for d, c in terms:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            score = 0
            for t in own:
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d, score))
        found.sort()
        for rank, (*_, d, score) in enumerate(found[:k], 1):
            out[item, rank] = (d, score)
    return out


def got_ranks(df):
    rows = df.collect()
    out = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def items(corpus_rows):
    texts = [" ".join((t or "").split()[3:40]) for _, t in corpus_rows[:30]]
    odd = ["", None, "nowhere at all zzz9", "one", "É", "THE the tHe of", "w17 w18 w19 of"]
    rows = list(enumerate(texts + odd)) + [(2, "of which more"), (None, "the one"), (None, "in that")]
    return rows


@pytest.mark.parametrize("k, segment_bytes", [(50, 1 << 20), (3, 4000), (1, 500)])
def test_ranked_search(spark, corpus_docs, corpus_rows, items, k, segment_bytes):
    index = lexical_search.build_index(corpus_docs, segment_bytes)
    table = spark.createDataFrame(items, ITEMS).withColumn("score", F.lit("clash")).repartition(3)
    assert got_ranks(lexical_search.best_documents(index, table, k)) == ranked(corpus_rows, items, k)


def test_searches_in_blocks_repeated_rows_and_null_ids(spark, corpus_rows, items):
    rows = corpus_rows + corpus_rows[:20] + [(None, corpus_rows[1][1]), (None, "one two"), (-4, "one")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    index = lexical_search.build_index(docs, 6000)
    table = spark.createDataFrame(items, ITEMS)
    want = ranked(rows, items, 7)
    assert got_ranks(lexical_search.best_documents(index, table, 7)) == want
    assert got_ranks(lexical_search.best_documents(index, table, 7, search_terms=40)) == want


def test_search_without_documents_or_items(spark, corpus_docs):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "the one")], ITEMS)
    assert lexical_search.best_documents(lexical_search.build_index(none), some).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " .,")], DOCS)
    assert lexical_search.best_documents(lexical_search.build_index(blank), some).count() == 0
    index = lexical_search.build_index(corpus_docs)
    found = lexical_search.best_documents(index, spark.createDataFrame([], ITEMS))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def one_segment(n_docs, lists):
    """A segment of documents of equal length from {term: [(document, frequency)]}."""
    import pyarrow as pa

    triples = sorted((t, d, f) for t, own in lists.items() for d, f in own)
    hashes, docs, tf = (np.array(c) for c in zip(*triples))
    row = lexical_search.segment_row(hashes.astype(np.uint64), docs, tf, np.full(n_docs, 100))
    names = ["damping", "terms", "sizes", "lasts", "maxima", "widths", "postings"]
    columns = {"doc_ids": [list(range(n_docs))]} | {c: [v] for c, v in zip(names, row)}
    kinds = [pa.list_(pa.int64())] + [pa.binary()] * 7
    return lexical_search.Segment(
        pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds)], names=list(columns))
    )


def test_blocks_hold_numbers_of_all_sizes():
    rng = np.random.default_rng(0)
    docs = np.sort(rng.choice(200_000, 900, replace=False)).tolist()
    tf = [int(x) for x in rng.choice([1, 2, 255, 256, 65_535, 65_536, 10**6], 900)]
    segment = one_segment(200_000, {7: list(zip(docs, tf)), 9: [(199_999, 3)], 3: [(0, 1)]})
    for term, want in ((7, list(zip(docs, tf))), (9, [(199_999, 3)]), (3, [(0, 1)])):
        number = int(segment.lists(np.array([term], np.uint64))[0])
        got_docs, shares = segment.all_of(number)
        assert got_docs.tolist() == [d for d, _ in want]
        assert shares.tolist() == [(10**9 * f) // (1000 * f + 2000) for _, f in want]
        middle = np.arange(segment.first[number], segment.first[number + 1])[1::2]
        if len(middle):
            some, _ = segment.decompress(number, middle)
            assert some.tolist() == [d for i, (d, _) in enumerate(want) if (i // 128) % 2]
    assert segment.lists(np.array([8], np.uint64)).tolist() == [-1]


def test_block_maxima_spare_decompression():
    """Lists that cannot lift a document are read only where candidates lie."""
    rare = [(d, 50) for d in range(100, 160)]
    common = [(d, 1) for d in range(20_000)]
    segment = one_segment(20_000, {1: rare, 2: common})
    numbers = segment.lists(np.array([1, 2], np.uint64))
    docs, scores = lexical_search.search_segment(segment, numbers, np.array([5000, 10]), 50, 0)
    assert set(docs.tolist()) >= set(range(100, 150))
    assert segment.decompressed <= 3 < -(-20_000 // 128)
    assert scores.max() == 5000 * ((10**9 * 50) // (50_000 + 2000)) + 10 * (10**9 // 3000)


# ---------------------------------------------------------------- vector codes


def product_codes(rows, entries=256, rounds=4, positions=4):
    """(codes by row, errors by row, codebooks) by plain loops over whole numbers."""
    kept = [
        (i, v, [math.floor(1024 * x) for x in e], lab)
        for i, (v, e, lab) in enumerate(rows)
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    if not kept:
        return [], None
    longest = max(1, -(-max(len(x) for _, _, x, _ in kept) // positions)) * positions
    kept = [(i, v, x + [0] * (longest - len(x)), lab) for i, v, x, lab in kept]
    width = longest // positions
    first = sorted(kept, key=lambda r: (r[1] is None, r[1] or 0, r[2]))[:entries]
    out = [["", 0] for _ in kept]
    books = []
    for p in range(positions):
        parts = [x[p * width : (p + 1) * width] for _, _, x, _ in kept]
        book = [x[p * width : (p + 1) * width] for _, _, x, _ in first]

        def nearest(part, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(part, c)), k) for k, c in enumerate(book))

        for _ in range(rounds):
            mine = [nearest(x, book)[1] for x in parts]
            for k in range(len(book)):
                own = [x for x, m in zip(parts, mine) if m == k]
                if own:
                    book[k] = [sum(c) // len(own) for c in zip(*own)]
        for r, x in enumerate(parts):
            d, k = nearest(x, book)
            out[r][0] += f"{k:02x}"
            out[r][1] += d
        books.append(book)
    labels = Counter()
    for (code, error), (_, _, _, lab) in zip(out, kept):
        labels[lab] += error
    text = ",".join(str(n) for book in books for c in book for n in c)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [(v, c, e, labels[lab], digest) for (c, e), (_, v, _, lab) in zip(out, kept)], books


VECTORS = "vec_id long, embedding array<float>, label int, entry string, row long, part int"


def vector_table(spark, rows):
    full = [(v, e, lab, "clash", 5, 1) for v, e, lab in rows]
    return spark.createDataFrame(full, VECTORS).repartition(5)


def digest_rows(spark, rows, **kw):
    codebooks, coded = vector_codes.compressed(vector_table(spark, rows), **kw)
    found = vector_codes.code_digest(codebooks, coded)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def float_rows(n, size, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        e = [float(np.float32(x)) for x in rng.normal(size=size) / 3]
        rows.append((int(rng.integers(-5000, 5000)), e, int(rng.integers(0, 4))))
    return rows


def test_codes_match_plain_loops(spark):
    rows = float_rows(400, 12, 1)
    rows += [(9000 + i, rows[0][1], 7) for i in range(200)]  # a third are copies of one
    rows += [(1, None, 1), (2, [0.5, None] + [0.0] * 10, 1), (3, [float("nan")] * 12, 1), (4, [float("inf")] * 12, 2)]
    rows += [(None, rows[1][1], None), (None, rows[2][1], None), rows[5], rows[5]]
    want, _ = product_codes(rows)
    assert digest_rows(spark, rows) == sorted(want, key=repr)
    want, _ = product_codes(rows, entries=9, rounds=6)
    assert digest_rows(spark, rows, entries=9, rounds=6) == sorted(want, key=repr)


def test_codes_of_few_odd_and_no_vectors(spark):
    rows = [(3, [0.1, 0.2, 0.3, 0.4, 0.5], 1), (3, [0.1, 0.2], None), (2, [], 0), (7, [100000.0, -100000.0], 0)]
    want, books = product_codes(rows)
    assert digest_rows(spark, rows) == sorted(want, key=repr)
    assert len(books[0]) == 4
    assert digest_rows(spark, [(1, None, 2), (2, [float("nan")], None)]) == []
    assert digest_rows(spark, [(5, [], 1)]) == sorted(product_codes([(5, [], 1)])[0], key=repr)
    rounds0, _ = product_codes(float_rows(60, 8, 4), entries=10, rounds=0)
    assert digest_rows(spark, float_rows(60, 8, 4), entries=10, rounds=0) == sorted(rounds0, key=repr)


def test_extreme_components_are_held(spark):
    top = 3.0e38
    rows = [(1, [top, -top, 0.0, 0.0], 1), (2, [0.0] * 4, 1), (3, [top, 0.0, 0.0, 1.0], 2)]
    got = digest_rows(spark, rows, rounds=1, entries=2)
    assert len(got) == 3 and all(0 <= r[2] < 1 << 62 for r in got)


def test_both_kinds_of_arithmetic_agree():
    rng = np.random.default_rng(2)
    parts = rng.integers(-50, 50, (500, 6))
    codebook = np.concatenate([parts[:40], parts[:40]])
    small = vector_codes.nearest(parts, codebook)
    large = vector_codes.nearest(parts * (1 << 23), codebook * (1 << 23))
    assert (small[0] == large[0]).all() and (small[1] << 46 == large[1]).all()
    assert (small[0] < 40).all()


def test_only_parts_that_change_entry_are_shuffled(spark):
    rows, length = vector_codes.whole_vectors(vector_table(spark, float_rows(300, 8, 3)))
    start = np.array([r["components"] for r in rows.orderBy("vec_id").limit(16).collect()], np.int64)
    codebooks = start.reshape(16, 4, 2).transpose(1, 0, 2).copy()
    resident = vector_codes.at_owners(vector_codes.first_assignment(rows, codebooks, 32))
    assert resident.count() == 1200
    moved = vector_codes.updated(resident, codebooks)
    changed = vector_codes.reassigned(resident, moved).where("moved").count()
    assert 0 < changed < 600
    same = vector_codes.reassigned(resident, codebooks)
    assert same.where("moved").count() == 0
    after = vector_codes.migrated(resident, moved)
    assert after.count() == 1200
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # who moved was written at the new owners


# ---------------------------------------------------------------- token files


def least_bits(counts, limit):
    """Bits of the best code of words of at most ``limit`` bits, by trying all lengths."""
    best = math.inf
    for lengths in itertools.product(range(1, limit + 1), repeat=len(counts)):
        if sum(2.0**-n for n in lengths) <= 1:
            best = min(best, sum(n * c for n, c in zip(lengths, counts)))
    return best


@pytest.mark.parametrize("limit", [3, 4, 5])
def test_lengths_are_the_best(limit):
    rng = np.random.default_rng(limit)
    for _ in range(12):
        counts = np.maximum(1, rng.lognormal(2, 2, rng.integers(2, 6)).astype(int))
        lengths = token_files.code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(2.0 ** -int(n) for n in lengths) <= 1
        assert int((lengths * counts).sum()) == least_bits(counts.tolist(), limit)


def test_limit_holds_for_steep_counts():
    counts = np.array([2**k for k in range(40)] + [0, 0])
    for limit in (6, 12, 20):
        lengths = token_files.code_lengths(counts, limit)
        assert lengths[:40].max() == limit and lengths[40:].sum() == 0
        assert sum(2.0 ** -int(n) for n in lengths[:40]) == 1
    assert token_files.code_lengths(np.ones(33, int), 3).max() == 6  # raised: 3 bits cannot tell 33


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 50_000)
    counts = np.bincount(ids, minlength=50_257) + (rng.random(50_257) < 0.2)
    lengths = token_files.code_lengths(counts)
    _, words, longest = token_files.canonical_code(lengths)
    used = np.flatnonzero(lengths)
    spelled = [format(int(words[i]), f"0{lengths[i]}b") for i in used]
    ordered = sorted(spelled)
    assert all(not b.startswith(a) for a, b in zip(ordered, ordered[1:]))
    payload, marks = token_files.encode_block(ids, words, lengths, 64)
    assert len(marks) == -(-n // 64)
    bits = "".join(format(int(words[i]), f"0{lengths[i]}b") for i in ids.tolist())
    assert payload == int(bits + "0" * (-len(bits) % 8) or "0", 2).to_bytes(-(-len(bits) // 8), "big")
    if n:
        table, longest = token_files.decoding_table(lengths)
        assert (token_files.decode_block(payload, marks, n, table, longest, 64) == ids).all()


def test_one_id_alone():
    lengths = token_files.code_lengths(np.array([0, 0, 9]))
    _, words, _ = token_files.canonical_code(lengths)
    payload, marks = token_files.encode_block(np.full(9, 2), words, lengths, 4)
    table, longest = token_files.decoding_table(lengths)
    assert token_files.decode_block(payload, marks, 9, table, longest, 4).tolist() == [2] * 9


@pytest.fixture(scope="module")
def plain_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def token_rows(rows, tokenizer):
    """(doc_id, start, n, crc32) in ascending order of ids, nulls first."""
    out, start = [], 0
    coded = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows]
    for d, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


@pytest.mark.parametrize("part_bytes", [1 << 26, 3000])
def test_token_files(spark, tmp_path, corpus_docs, corpus_rows, plain_tokenizer, monkeypatch, part_bytes):
    monkeypatch.setattr(token_files.plain_blocks, "__defaults__", (0, part_bytes))
    path = str(tmp_path / "store")
    clash = corpus_docs.withColumn("ids", F.lit("clash")).withColumn("part", F.lit(1))
    token_files.write_token_files(clash, path, plain_tokenizer[0])
    found = token_files.read_token_files(spark, path)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids"]
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found.collect()]
    assert sorted(got) == token_rows(corpus_rows, plain_tokenizer[1])


def test_token_files_of_repeated_and_null_ids(spark, tmp_path, plain_tokenizer):
    rows = [(None, "a null"), (4, "same"), (4, "same"), (4, "other words"), (-2, None), (9, ""), (None, None)]
    path = str(tmp_path / "store")
    token_files.write_token_files(spark.createDataFrame(rows, DOCS).coalesce(1), path, plain_tokenizer[0])
    got = token_files.read_token_files(spark, path).collect()
    spans = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in got)
    assert [s for s, _, _ in spans] == [sum(n for _, n, _ in spans[:k]) for k in range(len(spans))]
    assert [d for _, _, d in spans] == [None, None, -2, 4, 4, 4, 9]
    crcs = Counter((r["doc_id"], zlib.crc32(r["ids"])) for r in got)
    assert crcs == Counter((d, c) for d, _, _, c in token_rows(rows, plain_tokenizer[1]))


def test_token_files_of_nothing(spark, tmp_path, plain_tokenizer):
    path = str(tmp_path / "store")
    token_files.write_token_files(spark.createDataFrame([], DOCS), path, plain_tokenizer[0])
    assert token_files.read_token_files(spark, path).count() == 0


def test_registered():
    names = ["op11_lexical_search", "op12_vector_codes", "op13_token_files"]
    assert set(names) <= set(queries.QUERIES) and set(names[:2]) <= set(queries.ORACLES)
