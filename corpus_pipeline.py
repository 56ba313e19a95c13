"""From raw documents to packed training sequences: filter, deduplicate, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from tidewarden.llm.common import kept, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences learnt for their language and source."""
    return quality_rules.filtered(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; a document left without a word goes."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of every group of similar ones; one of rows that repeat an id."""
    return ngram_join.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; those it does not take go. Null and repeated ids are rows like others."""
    taken = mixing.mixed_copies(docs, F.array("source"), with_text=True)[0].where("copies > 0")
    return taken.select("document", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path(packing.TOKENIZER), with_ids=False)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
