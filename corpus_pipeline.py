"""Corpus pipeline: quality rules, line dedup, n-gram Jaccard join, source mixing, packing.

Stages run one behind the other, each on what the one before has written: a stage removes the tables that the one before
had stored for itself.

Every stage takes null in any column, empty and very long texts, ties, repeated rows, an empty table (which gives an empty
one) and further columns of any name; what each does with them is stated below and in the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeweave.llm import jaccard, line_dedup, mixing, packing, quality
from citeweave.llm.common import stage_scratch, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their language's perplexity band go.

    So do null and empty texts, which have no words. Very long texts are judged whole, repeated rows alike; a null
    language has a band of its own.
    """
    with stage_scratch(spark, "quality rules"):
        return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line chunks that an earlier document has are cut out of texts; documents stay.

    Rows of one doc_id count as one document. Null texts and rows without doc_id stay as they are; a text that is all
    repeats becomes empty.
    """
    with stage_scratch(spark, "line dedup", before="quality rules"):
        return line_dedup.clean_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of shingle sets (five words) with a similarity of 0.8 or more stays.

    It is the one of the least doc_id, with its repeated rows. Null and empty texts link with nothing and stay, as do rows
    without doc_id.
    """
    with stage_scratch(spark, "n-gram Jaccard join", before="line dedup"):
        return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them, every one at least once, stored in the mixture's order.

    A null source is one of its own; null and empty texts count as one token. A source misses its budget by less than one
    of its blocks, and a very long text is in one block.
    """
    with stage_scratch(spark, "mixing", before="n-gram Jaccard join"):
        return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens; the passes of a document lie in different ones where others are left.

    Null and empty texts hold the end id alone; very long texts fill sequences of their own but for their tails.
    """
    import public_tokenizers

    with stage_scratch(spark, "packing", before="mixing"):
        return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Perplexity models, tries and packing have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each writes its result as Parquet, which the next one reads. An empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = store(docs)
    return docs
