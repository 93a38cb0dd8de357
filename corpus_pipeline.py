"""A corpus pipeline: toxic documents go, one of each group of near-duplicates stays, documents with benchmark passages
go, the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir), and all but the last return the columns of docs. Rows with a null doc_id are
kept by the stages that decide by doc_id; rows that repeat a doc_id are one document and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framesift.llm.common import table, written
from framesift.llm.decontam import leaks
from framesift.llm.minhash import near_duplicates
from framesift.llm.packing import packed, pieces
from framesift.llm.toxicity import not_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores under the threshold, by a model learned from those of docs that labels names."""
    return not_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of one document of each group of near-duplicates, that with the smallest doc_id."""
    copies = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of documents that hold no passage of benchmark."""
    leaky = leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaky, "doc_id", "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of docs in sequences: one row a piece."""
    import public_tokenizers

    return packed(written(pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), "pieces"))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None  # learned scores and a tokenizer are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each on what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
