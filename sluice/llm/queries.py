"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, decontaminate, lmscore, near, orderminhash, packing, pfor, sharding, substring, urlfilter
from . import common as C


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.conversation_packs(C.table(spark, sf_dir, "conversations"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.cleaned(C.table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select("doc_id", "text", spans.alias("removed"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(C.table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages")
    return urlfilter.filtered(pages, pages.select("url", urlfilter.blocked(F.col("url")).alias("label")))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.groups(C.table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.fingerprints(C.table(spark, sf_dir, "documents"))


def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.token_blocks(C.table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scored(C.table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_decontamination, op3_substring_dedup, op4_quality, op5_sharding, op6_url_filter, op7_near_dedup, op8_order_minhash, op9_token_blocks, op10_lm_score)
}
SQL: dict[str, str] = {"op3_substring_dedup": substring.SQL, "op5_sharding": sharding.SQL}
