"""The operators on documents against plain loops, on a small corpus of hard cases."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import decontaminate, line_dedup, ngram_join, packing, pii, quality_rules, sharding

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def repeated(spark, corpus_rows):
    """Every row twice, and one id with two texts."""
    rows = [r for r in corpus_rows if r[0] < 40] * 2 + [(3, "quite another text of a few more words here")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


# ---------------------------------------------------------------- quality rules


def test_statistics(corpus_docs, corpus_rows):
    found = quality_rules.statistics(corpus_docs.withColumn("n_words", F.lit("clash")))
    got = {r["doc_id"]: tuple(r[c] for c in quality_rules.STATISTICS) for r in found.collect()}
    assert got == {d: brute.statistics(t) for d, t in corpus_rows}
    assert {"n", "token", "lang"} <= set(found.columns)


def test_repeated_windows(spark):
    texts = ["a b c d e " * 9, "a b c d e f a b c d e f g", "x\nx\nx y\nx y", "q " * 12, "a b c d e f g h i j k"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r["doc_id"]: tuple(r[c] for c in quality_rules.STATISTICS) for r in quality_rules.statistics(df).collect()}
    assert got == {d: brute.statistics(t) for d, t in enumerate(texts)}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for d in range(900):
        words = [f"w{rng.integers(5000)}" for _ in range(rng.integers(20, 80))]
        kind = d % 5
        if kind == 0:  # junk of symbols
            words = [w + "***" if rng.random() < 0.5 else w for w in words]
        elif kind == 1:  # junk of digits
            words = [str(rng.integers(10**6)) for _ in words]
        elif kind == 2 and d % 2:  # clean, with a symbol
            words[0] += "*"
        rows.append((d, " ".join(words)))
        labels.append((d, int(kind > 1), 0))
    labels += [(None, 1, 0), (5, None, 0), (7, 3, 0), (2, 1, 1)]
    return (
        spark.createDataFrame(rows, SCHEMA),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_rules_part_junk_from_clean(labelled):
    docs, labels = labelled
    judged = quality_rules.judged(docs, labels)
    got = {r["doc_id"]: (r["kept"], r["rule"]) for r in judged.collect()}
    wrong = [d for d, (kept, _) in got.items() if kept != (d % 5 > 1)]
    assert len(got) == 900 and len(wrong) <= 9
    assert {rule for _, rule in got.values()} >= {None, 1}
    assert quality_rules.accepted(docs, labels).columns == docs.columns


def test_rules_generalise(labelled):
    docs, labels = labelled
    seen = labels.where("doc_id < 600")
    unseen = quality_rules.judged(docs, seen).where("doc_id >= 600").select("doc_id", "kept").collect()
    right = sum(r["kept"] == (r["doc_id"] % 5 > 1) for r in unseen)
    assert right >= 0.97 * len(unseen)


def test_no_labels_no_rules(spark, labelled, empty):
    docs, labels = labelled
    for few in (labels.where("false"), labels.where("quality = 1")):
        assert quality_rules.judged(docs.limit(20), few).where("kept").count() == 20
    assert quality_rules.judged(empty, labels).count() == 0
    assert quality_rules.decision([]) is not None


# ---------------------------------------------------------------- sharding


def test_shards(corpus_docs, corpus_rows):
    found = sharding.shards(
        corpus_docs.withColumn("shard", F.lit("clash")), 7, bucket_bytes=4000, bucket_rows=20
    ).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(corpus_rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1
    order = [r["doc_id"] for r in sorted(found, key=lambda r: (r["slot"], r["shard"]))]
    assert order != sorted(order)


def test_shards_repeat_with_a_seed(corpus_docs):
    stored = corpus_docs.coalesce(1)
    one = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(stored, 5, 1).collect()}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(stored, 5, 1).collect()}
    other = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(stored, 5, 2).collect()}
    assert one == again != other


def test_shards_of_equal_rows(spark, empty, tmp_path):
    rows = spark.createDataFrame([(1, "same")] * 200, SCHEMA).repartition(3)
    shuffled = sharding.shuffled(rows, bucket_rows=20).collect()
    assert sorted(r["position"] for r in shuffled) == list(range(200))
    assert max(Counter(r["bucket"] for r in shuffled).values()) < 60
    assert sharding.shards(empty).count() == 0
    sharding.write_shards(sharding.shards(rows, 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4


def test_fisher_yates_is_a_permutation():
    for n in (0, 1, 2, 50):
        assert sorted(sharding.fisher_yates(n, 3).tolist()) == list(range(n))
    firsts = Counter(int(sharding.fisher_yates(4, seed)[0]) for seed in range(800))
    assert min(firsts.values()) > 150


# ---------------------------------------------------------------- n-gram join


@pytest.mark.parametrize(
    ("width", "num", "hot", "block"),
    [(4, 85, 64, 2048), (5, 80, 64, 2048), (4, 85, 2, 2048), (4, 85, 2, 8), (4, 60, 4, 5)],
)
def test_groups(corpus_docs, corpus_rows, width, num, hot, block):
    like = ngram_join.Likeness(width, num, 100)
    found = ngram_join.similar_groups(corpus_docs, like, hot_from=hot, block=block)
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute.groups(corpus_rows, width, num, 100))


def test_groups_of_repeated_rows(repeated, empty):
    rows, docs = repeated
    like = ngram_join.Likeness()
    found = Counter(tuple(r) for r in ngram_join.similar_groups(docs, like).collect())
    assert found == Counter(brute.groups(rows, 5, 80, 100))
    assert ngram_join.similar_groups(empty).count() == 0
    kept = [tuple(r) for r in ngram_join.one_per_group(docs, like).collect()]
    want = {(d, t) for (d, t), (_, _, c) in zip(rows, brute.groups(rows, 5, 80, 100)) if d == c}
    assert len(kept) == len(set(kept)) and {k for k in kept if k[0] != 3} == {w for w in want if w[0] != 3}


def test_overlaps_and_forest():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(30)]
    both = ngram_join.overlaps(sets, columns=7)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert both[i, j] == len(np.intersect1d(a, b))
    linked = both > 12
    edges = ngram_join.forest(linked)
    assert len(edges) < len(sets)
    root = list(range(30))
    for a, b in edges:
        root = [root[a] if r == root[b] else r for r in root]
    for i, j in zip(*np.nonzero(linked)):
        assert root[i] == root[j]


def test_bits_bound_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**62, rng.integers(1, 200))).astype(np.uint64)
        b = np.union1d(a[rng.random(len(a)) < 0.8], rng.integers(0, 2**62, rng.integers(1, 60)).astype(np.uint64))
        different = len(np.setxor1d(a, b))
        assert ngram_join._different_bits(ngram_join._bits(a), ngram_join._bits(b)) <= different


# ---------------------------------------------------------------- line dedup


@pytest.mark.parametrize(("hot", "block", "num"), [(64, 2048, 80), (2, 2048, 80), (2, 4, 80), (3, 6, 60)])
def test_lines(corpus_docs, corpus_rows, hot, block, num):
    like = ngram_join.Likeness(5, num, 100)
    found = line_dedup.deduplicated(corpus_docs, like, hot_from=hot, block=block).collect()
    want = brute.without_later_lines(corpus_rows, 5, num, 100)
    assert {r["doc_id"]: r["text"] for r in found} == want
    texts = dict(corpus_rows)
    assert all(r["n_chars"] == len(r["text"] or "") for r in found if r["text"] != texts[r["doc_id"]])
    assert set(found[0].asDict()) == set(corpus_docs.columns)


def test_lines_of_repeated_rows(repeated, empty):
    rows, docs = repeated
    found = [tuple(r) for r in line_dedup.deduplicated(docs.where("doc_id <> 3")).collect()]
    want = brute.without_later_lines(sorted({r for r in rows if r[0] != 3}, key=lambda r: r[0]), 5, 80, 100)
    assert dict(found) == want and len(found) == len(want)
    assert line_dedup.deduplicated(empty).count() == 0


# ---------------------------------------------------------------- decontamination


@pytest.fixture(scope="module")
def items(corpus_rows):
    texts = [t for _, t in corpus_rows if t and len(t.split()) > 40]
    out = [(k, " ".join(texts[k].split()[5 : 5 + n])) for k, n in enumerate((13, 14, 25, 5, 1, 40, 12))]
    return out + [(90, None), (91, ""), (92, "no such words anywhere"), (2, out[2][1]), (93, out[2][1])]


@pytest.mark.parametrize("search_bytes", [8 << 20, 40])
def test_contamination(spark, corpus_docs, corpus_rows, items, search_bytes):
    index = decontaminate.build_index(corpus_docs, segment_bytes=3000)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.judged(decontaminate.phrase_matches(index, tests, search_bytes=search_bytes))
    rows = found.collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(set(r["item_ids"])))) for r in rows)
    want = sorted(brute.contamination(corpus_rows, items))
    assert got == want
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {d for d, n, h, _ in want if h and 20 * h >= n}
    bad = {d for d, n, h, _ in want if h and 20 * h >= n}
    kept = decontaminate.decontaminated(corpus_docs, tests)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in corpus_rows} - bad
    assert kept.columns == corpus_docs.columns


def test_contamination_of_nothing(spark, corpus_docs, empty, items):
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.decontaminated(empty, tests).count() == 0
    assert decontaminate.decontaminated(corpus_docs, tests.where("false")).count() == corpus_docs.count()


def test_proximity(spark):
    texts = ["alpha x beta y gamma", "gamma beta alpha", "alpha x x x x x beta gamma", None, "alpha beta"]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).coalesce(1)
    tests = spark.createDataFrame([(7, "Alpha beta gamma"), (8, "beta"), (9, "")], "item_id long, text string")
    index = decontaminate.build_index(docs)
    found = decontaminate.proximity_matches(index, tests, within=5).collect()
    got = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in found}
    assert got == {(0, 7, 0, 5), (1, 7, 0, 3), (0, 8, 2, 3), (1, 8, 1, 2), (2, 8, 6, 7), (4, 8, 1, 2)}


# ---------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    return path, tokenizers.Tokenizer.from_file(path)


def test_pieces(spark, corpus_docs, corpus_rows, tokenizer):
    path, plain = tokenizer
    odd = "It's they'll we'd 'tis ''s a's!'s  two   spaces\n\n\ttab 12ab ٣٤ 日本 \U0001f600 <|endoftext|> \U000105c0 end "
    rows = corpus_rows + [(10_000 + k, odd[k:]) for k in range(0, len(odd), 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = defaultdict(list)
    for r in packing.encode_pieces(docs, path, capacity=64).collect():
        ids = struct.unpack(f"<{r['length']}I", r["ids"])
        found[r["doc_id"]].append((r["piece"], r["start"], ids))
    for d, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        pieces = sorted(found[d])
        assert [p for p, _, _ in pieces] == list(range(-(-len(ids) // 64)))
        assert [i for _, _, part in pieces for i in part] == ids
        assert [s for _, s, _ in pieces] == [sum(len(x) for _, _, x in pieces[:k]) for k in range(len(pieces))]
        assert all(len(x) == 64 for _, _, x in pieces[1:])


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_plan_holds_the_histogram(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 5000))
    lengths = np.clip(rng.lognormal(4, 1, n).astype(int), 1, 256)
    histogram = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True))}
    plan = packing.packing_plan(histogram, 256)
    held = Counter()
    for config, times in plan:
        assert sum(config) <= 256 and times > 0
        for length in config:
            held[length] += times
    assert dict(held) == histogram
    least = -(-int(lengths.sum()) // 256)
    assert sum(t for _, t in plan) <= 1.03 * least + 2
    assert packing.packing_plan({}) == []


def test_program_places_pieces_of_all_lengths():
    rng = np.random.default_rng(3)
    drawn = np.minimum(rng.lognormal(6.2, 0.7, 60_000).astype(int) + 1, 5000) % 1024
    some = {int(k): int(c) for k, c in zip(*np.unique(drawn[drawn > 0], return_counts=True))}
    for histogram, over in (({n: 40 for n in range(1, 1024)}, 1.02), (some, 1.005)):
        tokens = sum(n * k for n, k in histogram.items())
        left = dict(histogram)
        for config, times in packing.fractional_packing(histogram, 1024):
            for n, k in config.items():
                left[n] -= k * int(times)
        assert min(left.values()) >= 0
        assert sum(n * k for n, k in left.items()) <= 0.001 * tokens
        plan = packing.packing_plan(histogram, 1024)
        assert sum(t for _, t in plan) <= over * -(-tokens // 1024)


def exact_packing(lengths, capacity):
    """The fewest sequences, by trying every place for each piece, longest first."""
    pieces, best = sorted(lengths, reverse=True), len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(pieces):
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= pieces[k]:
                i = rooms.index(room)
                place(k + 1, rooms[:i] + [room - pieces[k]] + rooms[i + 1 :])
        place(k + 1, rooms + [capacity - pieces[k]])

    place(0, [])
    return best


def test_small_plans_are_the_fewest():
    rng = np.random.default_rng(8)
    over = 0
    for _ in range(60):
        lengths = rng.integers(1, 33, rng.integers(1, 9)).tolist()
        plan = packing.packing_plan(dict(Counter(lengths)), 32)
        over += sum(t for _, t in plan) - exact_packing(lengths, 32)
    assert over <= 1


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_program_takes_no_more_than_best_fit(spark, tokenizer, size):
    import os

    path = f"/root/testdata/{size}/documents.parquet"
    if not os.path.isfile(path):
        pytest.skip("no driver tables")
    pieces = packing.encode_pieces(spark.read.parquet(path), tokenizer[0])
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    part = {n: k for n, k in histogram.items() if n < 1024}
    tokens = sum(n * k for n, k in part.items())
    alone = sum(t for _, t in packing._best_fit(part, 1024))
    count = sum(t for _, t in packing.packing_plan(part, 1024))
    bought = packing.fractional_packing(part, 1024)
    placed = sum(n * k * t for config, t in bought for n, k in config.items())
    assert count <= alone
    assert count <= -(-tokens // 1024) + 2
    assert placed >= {"sf0.001": 0.3, "sf0.01": 0.5, "sf0.1": 0.95}[size] * tokens


def test_packed(spark, corpus_docs, tokenizer):
    pieces = packing.encode_pieces(corpus_docs, tokenizer[0], capacity=128).drop("ids")
    rows = packing.packed(pieces.withColumn("offset", F.lit("clash")), capacity=128).collect()
    assert len(rows) == pieces.count()
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 128
    assert len(by) <= 1.05 * -(-sum(r["length"] for r in rows) // 128) + 1
    assert packing.packed(pieces.where("false")).count() == 0


def test_one_length_for_all(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "3 AS length")
    placed = packing.ranked(rows.withColumn("piece_key", F.col("doc_id")), 3000, per_part=100)
    assert sorted(r["rank"] for r in placed.collect()) == list(range(3000))


# ---------------------------------------------------------------- personal data

CARDS = "4753376719988201 4753 3767 1998 8201 4753-3767-1998-8202 378282246310005"
PII_TEXTS = [
    None,
    "",
    "mail a.b+c@x-y.example.com, a@b.cc_d@e.ff, a@b, @c.d, x@y.z.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255 0000255.1.1.1 1.2.3",
    CARDS,
    "+1 (736) 555-2678 +49-30-1234567890123456 +1 2 +12345678901",
    "É日\U0001f600 mail q@w.de 9.9.9.9 +1 (736) 555-2678",
    "9" * 5000 + " a" * 10 + "." * 3000 + "@x.y",
    " ".join(f"{k}.1.1.1 u{k}@h.io" for k in range(1500)),
    "Account DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not DE88370400440532013000.",
    "My social security number is 123-45-6789. Order 123-45-6780. Tax 000-12-3456.",
]


def test_personal_data(spark):
    docs = spark.createDataFrame(list(enumerate(PII_TEXTS)), SCHEMA)
    found = pii.personal_data(docs.withColumn("personal_data", F.lit(1)))
    rows = {r["doc_id"]: r for r in pii.digest(found).collect()}
    spans = {r["doc_id"]: r["personal_data"] for r in found.collect()}
    for d, text in enumerate(PII_TEXTS):
        want = brute.personal_data(text)
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in spans[d] if s["rank"] < 4] == want
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert rows[d]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        counts = Counter(k for *_, k in want)
        assert [rows[d][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            counts[k] for k in ("email", "ip", "card", "phone")
        ]
    text = PII_TEXTS[9]
    own = [text[s["start"] : s["end"]] for s in spans[9] if s["kind"] == "iban"]
    assert own == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert [PII_TEXTS[10][s["start"] : s["end"]] for s in spans[10] if s["kind"] == "ssn"] == ["123-45-6789"]


def test_masked(spark):
    docs = spark.createDataFrame([(1, "to q@w.de or 9.9.9.9!"), (2, None), (3, "clean")], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in pii.masked(pii.personal_data(docs)).collect()}
    assert got == {1: "to [email] or [ip]!", 2: "", 3: "clean"}


def test_personal_data_of_nothing(empty):
    assert pii.digest(pii.personal_data(empty)).count() == 0


def test_crc_of_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "some words")], SCHEMA)
    row = packing.encode_pieces(docs, tokenizer[0]).withColumn("crc", F.crc32("ids")).first()
    assert row["crc"] == zlib.crc32(row["ids"])


# ---------------------------------------------------------------- verdicts and filters


def test_verdicts_are_whole_numbers():
    """Sets just at and just below the border, where single precision errs."""
    like = ngram_join.Likeness(5, 85, 100)
    rng = np.random.default_rng(1)
    a = np.append(rng.integers(170_000, 2_000_000, 4000), 1_779_381)
    b = np.append((a[:-1] * rng.uniform(0.86, 1, 4000)).astype(int), 1_554_132)
    border = -(-85 * (a + b) // 185)
    for both in (border - 1, border, border + 1):
        want = [100 * int(x) >= 85 * (int(n) + int(m) - int(x)) for x, n, m in zip(both, a, b)]
        assert like.linked(both, a, b).tolist() == want
    sets = [np.arange(k, k + 5000, dtype=np.uint64) for k in (0, 10, 4999, 9000)]
    found = ngram_join.overlaps(sets, columns=512)
    assert found.dtype == np.int64
    for i, s in enumerate(sets):
        for j, t in enumerate(sets):
            own = len(np.intersect1d(s, t))
            assert i == j or found[i, j] == own


def test_key_filter(spark):
    import pyarrow as pa

    from merchlens.llm.tables import KeyFilter, row_bytes, small

    keys = spark.createDataFrame([(5,), (7,), (5,), (None,), (-3,)], "k long")
    column = pa.array([5, 6, None, -3, 0, 7], pa.int64())
    assert KeyFilter(keys, "k").passes(column).tolist() == [True, False, True, True, False, True]
    named = KeyFilter(keys.where("k IS NOT NULL"), "k")
    assert named.passes(column).tolist() == [True, False, False, True, False, True]
    assert not KeyFilter(keys.where("false"), "k").passes(column).any()
    assert KeyFilter(keys, "k", most=2).passes(column).all()
    assert row_bytes(keys.schema) < row_bytes(keys.withColumn("a", F.array("k")).schema)
    assert "Broadcast" not in str(small(keys, 1 << 40)._jdf.queryExecution().analyzed())
