"""Every operator on a table whose other columns are named like columns of its own."""

import pytest
from pyspark.sql import functions as F

from merchlens.llm import (
    chat_quotes,
    decontaminate,
    html_extract,
    lexical_search,
    line_dedup,
    ngram_join,
    packing,
    pii,
    quality_rules,
    sharding,
    token_files,
    vector_codes,
    warc_revisit,
)
from merchlens.llm.tables import quoted

NAMES = [
    "first", "bucket", "place", "position", "n", "g", "rule", "n_words", "kept", "fold", "bad", "id", "hash",
    "removed", "line", "row", "print", "tokens", "component_id", "salt", "rank", "own", "piece_key", "a.b",
    "with space", "back`tick", "entry", "label", "score", "part", "seq", "ids", "start", "size", "text_hash",
    "personal_data_", "quality", "toxic", "item_id", "segment", "runs", "level", "message", "found", "at",
]


def hostile(df):
    for i, name in enumerate(n for n in NAMES if n not in df.columns):
        df = df.withColumn(name, F.concat(F.lit(f"{i}-"), F.col(df.columns[0]).cast("string")))
    return df


def others(df, key):
    """{key: [the other columns' values]} as they went in."""
    rows = df.select(key, *[F.col(quoted(n)).alias(f"c{i}") for i, n in enumerate(NAMES) if n in df.columns])
    return {r[0]: tuple(r)[1:] for r in rows.collect()}


@pytest.fixture(scope="module")
def docs(spark, corpus_rows):
    return hostile(spark.createDataFrame([r for r in corpus_rows if r[0] < 60], "doc_id long, text string")).cache()


KEEPERS = {
    "op1": lambda d, labels, items: quality_rules.accepted(d, labels),
    "op3": lambda d, labels, items: sharding.shards(d, 5, bucket_rows=20),
    "op4": lambda d, labels, items: ngram_join.one_per_group(d),
    "op7": lambda d, labels, items: decontaminate.decontaminated(d, items),
    "op9": lambda d, labels, items: line_dedup.deduplicated(d),
    "op10": lambda d, labels, items: pii.personal_data(d),
}


@pytest.mark.parametrize("name", KEEPERS)
def test_other_columns_come_back(spark, docs, name):
    labels = spark.createDataFrame([(d, d % 2, 0) for d in range(60)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    found = KEEPERS[name](docs, labels, items)
    assert found.columns[: len(docs.columns)] == docs.columns
    want, got = others(docs, "doc_id"), others(found, "doc_id")
    assert got and all(want[d] == values for d, values in got.items())


def test_packing_keeps_other_columns(spark, docs):
    pieces = docs.drop("text").withColumn("length", (F.col("doc_id") % 50 + 1).cast("int"))
    found = packing.packed(pieces, 64)
    assert found.columns == [*pieces.columns, "sequence_id", "offset"]
    assert others(found, "doc_id") == others(pieces, "doc_id")


def test_operators_with_columns_of_their_own(spark, docs, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    n = docs.count()
    assert ngram_join.similar_groups(docs).count() == n
    assert packing.encode_pieces(docs, path).select("doc_id").distinct().count() == n
    assert quality_rules.statistics(docs).count() == n
    index = lexical_search.build_index(docs)
    items = hostile(spark.createDataFrame([(1, "the of")], "item_id long, text string"))
    assert lexical_search.best_documents(index, items).count()
    assert decontaminate.phrase_matches(decontaminate.build_index(docs), items).count() == n
    token_files.write_token_files(docs, str(tmp_path / "t"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == n
    vectors = spark.createDataFrame([(k, [1.0, float(k), 0.5, 2.0], k % 2) for k in range(9)], "vec_id long, embedding array<double>, label int")
    assert vector_codes.code_digest(*vector_codes.compressed(hostile(vectors))).count() == 9


def test_pages_and_chats(spark):
    pages = hostile(spark.createDataFrame([(k, f"http://a/{k}", "<p>one two three</p>") for k in range(4)], "page_id long, url string, html string"))
    found = html_extract.main_texts(pages)
    assert others(found, "page_id") == others(pages, "page_id")
    assert warc_revisit.resolve_revisits(hostile(warc_revisit.records_from_pages(pages))).count() == 2
    chats = spark.createDataFrame([(1, k, "user", "> hi\nyes") for k in range(3)], "conv_id long, turn long, role string, text string")
    assert chat_quotes.linked_messages(hostile(chats)).count() == 3
