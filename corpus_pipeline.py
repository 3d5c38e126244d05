"""The pipeline from raw documents to packed sequences, stage by stage.

Every stage takes the documents that the one before it kept, with their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import chosen_path, packing, pii, quality, substrings
from quadrille.llm.common import GATHERED_TEXTS, gathered, stored, text_id


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.judge_quality(docs, carry=docs.columns)
    return judged.where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id.

    Of repeated rows one stays, and of several texts with the least id the one with the
    least hash.  Rows that share an id but are not linked are judged by themselves.
    """
    found = chosen_path.near_documents(docs)
    # the rows of a group that are kept have one id; texts without words have no group
    alone = F.when(F.col("row_group").isNull(), F.struct("row_id", "row_mark"))
    kept = (
        found.where("kept")
        .groupBy("row_group", alone.alias("alone"))
        .agg(F.min("row_id").alias("_row"), F.min("row_mark").alias("_digest"))
        .select("_row", "_digest")
    )
    rows = docs.select(
        F.struct("*").alias("_all"),
        text_id("doc_id", "text").alias("_row"),
        F.xxhash64("text").alias("_digest"),
    )
    single = rows.join(kept, ["_row", "_digest"], "left_semi").dropDuplicates(["_row", "_digest"])
    return _few(docs, single.select("_all.*"))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that are in earlier ones."""
    others = [c for c in docs.columns if c != "text"]
    found = substrings.drop_repeated_passages(docs, carry=others, keep_text=True)
    found = found.select("row.*", F.col("kept_text").alias("text"))
    return _few(docs, _with_text(docs, found))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced."""
    return _with_text(docs, pii.redact_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return _few(docs, packed)


def _few(docs: DataFrame, made: DataFrame) -> DataFrame:
    """What a stage made of ``docs``, in as many files as that many texts fill."""
    return gathered(made, docs.count(), GATHERED_TEXTS)


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the number of characters of the new texts."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


STAGES = [
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("passages", drop_passages),
    ("personal_data", redact),
    ("packing", pack),
]

#: SQL can express neither the classifiers nor the tokenizer of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    for _, stage in STAGES[-1:]:
        docs = stage(spark, docs, sf_dir)
    return docs
