"""From raw documents to token digests: five stages, each one operator over all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents. Tables without rows, null and empty texts,
null ids, repeated rows and further columns are handled as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshlark.llm import bpe, decontam, linededup, neardup, quality
from meshlark.llm._work import fresh, materialise, small_side

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go from all documents but one each; n_chars follows the text."""
    out = linededup.dedup_lines(docs, counts=None)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    found = neardup.near_duplicates(docs)
    i, h = fresh(docs, "gone_id", "gone_hash")
    gone, _ = materialise(found.where(~F.col("kept")).select(F.col("doc_id").alias(i), F.col("text_hash").alias(h)), "near-duplicates")
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(small_side(gone, gone.count()), F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (own == F.col(h)), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, by 128 bits of their text: ids may be null or repeated."""
    h, gone_h = fresh(docs, "own_hash", "gone_hash")
    own = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    found = decontam.decontaminate(docs.select("text", own.alias(h)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=h)
    gone, _ = materialise(found.where("contaminated").select(F.col("doc_id").alias(gone_h)).distinct(), "contaminated")
    return docs.join(small_side(gone, gone.count()), own == F.col(gone_h), "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, encoded and decoded: doc_id, n_tokens and the digests of its ids and bytes."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: SQL has no byte-level BPE.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
