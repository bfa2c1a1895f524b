"""A corpus from raw documents to packed sequences, one operator a stage.

Each stage takes the documents its predecessor kept, ``(spark, docs, data_dir)``, and returns those it keeps with the
columns of ``documents``; the last returns packed pieces. Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.llm import common, decontamination, jaccard_join, packing, quality, toxicity
from silverbrook.session import fresh_path


def drop_toxic(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Documents without any grade of toxicity, by the ordinal regression."""
    plain = docs.select([F.col(c) for c in docs.columns])
    scored = toxicity.toxicity_scores(plain, common.table(spark, data_dir, "labels"), text_stays=True)
    flag = common.free_name(docs, "predicted")
    return scored.where(F.col(flag) == 0).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Documents the quality classifier takes for good ones."""
    scored = quality.quality_scores(docs, common.table(spark, data_dir, "labels"), text_stays=True)
    flag = common.free_name(docs, "predicted")
    return scored.where(F.col(flag) == 1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five-word shingles, similarity 0.8.

    Documents go for their texts, never for an id they share; see ``without_near_duplicates``.
    """
    return jaccard_join.without_near_duplicates(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words repeats the benchmark, as they are."""
    judged = decontamination.contamination(docs, common.table(spark, data_dir, "benchmark"))
    hit, n = common.free_name(docs, "n_hit"), common.free_name(docs, "n_words")
    clean = (F.col(hit) == 0) | (decontamination.SHARE * F.col(hit) < F.col(n))
    return judged.where(clean).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids."""
    pieces = packing.pack_documents(docs)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A learned classifier and a tokenizer are no SQL; tests hold the stages against plain re-computations.
ORACLE_SQL = None


def run(spark: SparkSession, data_dir: str) -> DataFrame:
    """All stages over the documents of ``data_dir``."""
    docs = common.table(spark, data_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, data_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
