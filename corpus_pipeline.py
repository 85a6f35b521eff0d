"""A training corpus from ``documents``: quality rules, near-duplicates,
repeated strings, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet in the shared folder and reads it
again. All but the last return the columns of ``documents``; ``n_chars`` follows the
text. No stage can be said in SQL, so there is no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import mcd, minhash_tensor, packing, sanitise, suffix_dedup
from panelkit.llm.common import bounded_batches, materialize, table
from panelkit.llm.queries import tokenizer_path


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    bounded_batches(spark)
    return mcd.quality_rules(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash_tensor.near_duplicates(docs).where("kept").select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes or more that occur earlier."""
    return _counted(suffix_dedup.without_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and terms that disclose it."""
    return _counted(sanitise.sanitise(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    got = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), special=True)
    return got.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


STAGES = [("quality rules", quality), ("minhash near-dedup", near_duplicates), ("suffix-array dedup", repeated_strings),
          ("pii", personal_data), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
