"""The pipeline stage by stage, against plain loops on the driver's smallest tables."""

import os
from collections import defaultdict

import brute
import pytest

import corpus_pipeline
from merchlens.llm.tables import corpus, stored

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage; the first entry is the documents."""
    docs = corpus(spark, SF_DIR, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), name.replace(" ", "-")))
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_names_and_columns(stages):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality_drops_what_the_base_rule_fails(stages):
    kept = dict(texts(stages[1]))
    failed = {d for d, t in texts(stages[0]) if brute.statistics(t)[5]}
    assert failed and not failed & set(kept)
    assert len(kept) >= 0.8 * (stages[0].count() - len(failed))


def test_lines(stages):
    assert dict(texts(stages[2])) == brute.without_later_lines(texts(stages[1]), 5, 80, 100)


def test_one_of_each_group(stages):
    groups = brute.groups(texts(stages[2]), 5, 80, 100)
    assert [d for d, _ in texts(stages[3])] == sorted({c for _, _, c in groups})


def test_decontaminated(stages, spark):
    items = [tuple(r) for r in corpus(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    found = brute.contamination(texts(stages[3]), items)
    clean = [d for d, n, hit, _ in found if not (hit and 20 * hit >= n)]
    assert [d for d, _ in texts(stages[4])] == clean


def test_packed(stages):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    plain = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = stages[5].collect()
    total, places = defaultdict(int), defaultdict(list)
    for r in rows:
        total[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    want = {d: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in texts(stages[4])}
    assert dict(total) == want
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024


def test_run_is_the_last_stage(stages, spark):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(tuple(r[c] for c in key) for r in got.collect()) == sorted(
        tuple(r[c] for c in key) for r in stages[5].collect()
    )
