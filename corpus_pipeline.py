"""From documents to packed training sequences, in five stages.

Each stage gets what the one before kept and returns the columns of ``documents``; the last
returns the packed pieces. Null texts count as empty: the quality rules reject them. Rows of
equal id and text are one document from the near-duplicate stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.decontaminate import decontaminated
from tidemill.llm.neardup import one_of_each
from tidemill.llm.packing import packed_documents
from tidemill.llm.privacy import sanitised
from tidemill.llm.repetition import clean
from tidemill.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return one_of_each(docs, size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too much of the benchmark in them."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that disclose it replaced; ``n_chars`` follows the text."""
    return sanitised(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packed_documents(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("privacy", privacy), ("packing", packing)]

#: SQL can't express the tokenizer of the last stage; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
