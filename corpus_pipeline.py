"""From raw documents to packed training sequences, one stage after the other.

Each stage takes what its predecessor kept; all but the last return the columns of ``documents``. A row with a null id
is a document of its own. Rows that repeat an id are one document from the near-duplicate stage on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.llm import language_id, near_dedup, packing, pii, quality_rules
from chatterlens.llm.queries import byte_tokenizer
from chatterlens.llm.storage import stored


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def sheltered(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column that is none of a document's under a name that no operator uses, and the way back."""
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c not in DOCUMENT}
    return docs.withColumnsRenamed(own), [F.col(own.get(c, c)).alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a recognised language."""
    docs, back = sheltered(docs)
    model = language_id.train(docs, F.lit(True))
    return language_id.predict(docs, model, strict=True).where(language_id.accepted()).select(*back)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that fail a rule, and hosts that fail too often."""
    docs, back = sheltered(docs)
    return quality_rules.judge(docs).where(quality_rules.accepted()).select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near duplicates (five-word shingles, similarity 0.8).

    Of rows that repeat an id the one with the smallest text stays, then the smallest language, source and length.
    """
    docs, back = sheltered(docs)
    kept = near_dedup.near_duplicates(docs, shingle=5, percent=80).where("kept AND doc_id IS NOT NULL")
    kept = kept.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows"))
    joined = docs.join(kept, F.col("doc_id") == F.col("_id"), "left").where("doc_id IS NULL OR _id IS NOT NULL")
    repeated = F.coalesce(F.col("_rows") > 1, F.lit(False))
    once = joined.where(~repeated).select(*docs.columns)
    whole, order = F.struct(*docs.columns), F.struct(*[c for c in DOCUMENT[1:] if c in docs.columns])
    again = joined.where(repeated).groupBy("_id").agg(F.min_by(whole, order).alias("_whole")).select("_whole.*")
    return once.unionByName(again).select(*back)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and the terms that reveal it."""
    docs, back = sheltered(docs)
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return pii.sanitise(docs).withColumn("n_chars", changed).select(*back)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack into sequences of 2,048 tokens."""
    return packing.pack(docs, byte_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", check_quality),
    ("near_dedup", drop_near_duplicates),
    ("pii", remove_personal_data),
    ("packing", pack_sequences),
]

#: Tokenising and learned models have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
