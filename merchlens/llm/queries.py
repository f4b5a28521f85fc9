"""Registered queries of the operators: each runs its operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
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
from merchlens.llm.oracles import ORACLES as SQL
from merchlens.llm.tables import corpus, text_or_empty
from merchlens.session import scratch_path

N_SHARDS = 40


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judged(docs, corpus(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.STATISTICS, "rule", "kept")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.main_texts(corpus(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's messages hold no quotes, so every third is made to quote an earlier one."""
    quoting = chat_quotes.with_quotes(corpus(spark, sf_dir, "conversations"))
    placed = chat_quotes.placed(chat_quotes.linked_messages(quoting))
    return placed.drop("message", "reply_message")


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_revisit.records_from_pages(corpus(spark, sf_dir, "pages"))
    headers = F.array_sort(F.map_entries("headers"))
    pairs = F.transform(headers, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return warc_revisit.resolve_revisits(records).withColumn(
        "headers", F.when(F.col("headers").isNotNull(), F.array_join(pairs, ";"))
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = ngram_join.Likeness(width=4, num=85, den=100)
    return ngram_join.similar_groups(corpus(spark, sf_dir, "documents"), like)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(corpus(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shards(corpus(spark, sf_dir, "documents"), N_SHARDS)
    text = text_or_empty()
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(corpus(spark, sf_dir, "documents"))
    found = decontaminate.judged(
        decontaminate.phrase_matches(index, corpus(spark, sf_dir, "benchmark"))
    )
    # Null ids have no text form and count in neither column.
    items = F.sort_array(F.array_compact(F.array_distinct(F.transform("item_ids", lambda i: i.cast("string")))))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_packing(
    spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None
) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.encode_pieces(corpus(spark, sf_dir, "documents"), tokenizer_path)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.packed(pieces)
    return packed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.personal_data(docs))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(corpus(spark, sf_dir, "documents"))
    return lexical_search.best_documents(index, corpus(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codebooks, coded = vector_codes.compressed(corpus(spark, sf_dir, "embeddings"))
    return vector_codes.code_digest(codebooks, coded)


def op13_token_files(
    spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None
) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(corpus(spark, sf_dir, "documents"), path, tokenizer_path)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_extraction": op2_html_extraction,
    "op3_sharding": op3_sharding,
    "op4_ngram_join": op4_ngram_join,
    "op5_chat_quotes": op5_chat_quotes,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_pii": op10_pii,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_files": op13_token_files,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = dict(SQL)
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
