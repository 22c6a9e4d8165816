"""The corpus pipeline: quality classifier, near-duplicate removal, personal data, packing.

Each stage takes the session, the documents that its predecessor kept, and the folder of the tables. All but the last return
the columns of the documents they got, under their names and in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, packing, pii, quality
from tidemark.llm.queries import tokenizer_path
from tidemark.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches ``quality.KEEP_FROM``."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(docs, docs["text"], model) >= quality.KEEP_FROM)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8), the one with the smallest id.

    Rows that share an id are one document: of those with the group's smallest id one stays. Rows without an id all stay.
    """
    gone = minhash.near_duplicates(docs, width=5, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*[docs[c] for c in docs.columns])
    named = left.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return named.unionByName(left.where(F.col("doc_id").isNull()))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind; ``n_chars`` follows the new text."""
    cleaned = docs.withColumn("text", pii.redacted(F.col("text"), pii.train(docs)))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, with their ids."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", keep_good), ("near_duplicates", keep_first), ("personal_data", mask_personal_data), ("packing", pack)]

#: SQL cannot express the classifiers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
