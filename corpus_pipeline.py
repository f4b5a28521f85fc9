"""From raw documents to packed sequences of tokens, in five stages.

Each stage takes the rows that its predecessor kept and is written before the next one
reads it, so a lost executor or a restarted driver repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules
from merchlens.llm.tables import corpus, stored

#: Sets of five-word shingles are alike from a Jaccard similarity of 0.8 on.
ALIKE = ngram_join.Likeness(width=5, num=80, den=100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the rules learned from ``labels``."""
    return quality_rules.accepted(docs, corpus(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line says; those left without words go."""
    return line_dedup.deduplicated(docs, ALIKE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies."""
    return ngram_join.one_per_group(docs, ALIKE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are passages of ``benchmark``."""
    return decontaminate.decontaminated(docs, corpus(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences of 1024."""
    import public_tokenizers

    pieces = packing.encode_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]

#: Learned rules cannot be stated in SQL; tests compare the stages with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    docs = corpus(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
