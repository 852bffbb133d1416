"""Corpus pipeline over documents: quality classifier, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, whatever
other columns there are. A null doc_id is nobody's copy and is never rejected by id, so such rows stay; an empty table gives
an empty table in every stage. What a stage does with null, empty and very long texts and with repeated rows is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import classifier, decontaminate, near, packing, substring
from sluice.llm import common as C

#: Most tokens, segments and loss-bearing tokens in a pack of documents.
PACK_LIMITS = (8192, 32, 8192)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.

    Null and empty texts are scored by their shape alone; a repeated doc_id goes with all its rows if one is rejected; texts
    are read whole, however long.
    """
    return classifier.accepted(docs, C.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least doc_id.

    Null, empty and wordless texts are groups of their own; rows of one doc_id are one document and stay or go together.
    """
    return near.drop_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines and passages that occurred before, by the order of doc_id; one of nothing else goes.

    Null and empty texts stay as they are; rows of one doc_id don't clean each other.
    """
    return substring.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; of a repeated doc_id all rows go if one holds an item.
    """
    return decontaminate.decontaminated(docs, C.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs of the documents that are left, each row in one pack.

    Null and empty texts have no tokens but keep their place; a document over the limits is a pack of its own.
    """
    return packing.document_packs(docs, PACK_LIMITS)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("decontamination", decontamination), ("packing", pack)]
#: SQL has neither the classifier nor the sampling: the stages are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again."""
    docs = C.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = C.cut(docs) if i + 1 < len(STAGES) else docs
    return docs
