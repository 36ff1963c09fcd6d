"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it kept. All but the last return the columns of
``documents``; the last returns packed pieces with their token ids. Nothing leaves a stage but by its own
rule: a document without a confident language, one of a near-duplicate group, a holder of a benchmark
item; lines go, but their documents stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editengine.llm import common, decontam, langid, linededup, neardup, packing
from editengine.session import prepare, shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; the identifier learns from their own ``lang``."""
    return langid.accept(docs, langid.fit(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    store = linededup.LineStore(spark, shared_dir(spark, "lines"))
    store.insert(docs)
    kept = store.apply(docs)
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose links share four fifths of their five-word shingles: that with the smallest id."""
    return neardup.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed, with their ids. Workers that serve all stages remember fewer words."""
    return packing.pack(docs, memo=200_000)


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

# A trained classifier, hashes of shingles and tokenizers have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each stage's result is written and read again."""
    prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
