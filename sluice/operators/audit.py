"""Blind audits: a sample spread evenly over strata, and its score once people have judged it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.hashing import digest
from ..functions.text import identifier

VERDICTS = ("accept", "reject", "review")
#: Share of the human rejections that the gates are meant to catch.
RECALL = 0.9


def sample(judged: DataFrame, size: int = 300, seed: int = 42) -> DataFrame:
    """``size`` rows of judged(id, task, difficulty, selected_for_llm, …) with audit_id, taken from the strata in turns.

    A stratum gives its rows by a seeded digest; no more than ``size`` of a stratum can be needed, and the window's limit
    keeps to that in each partition before anything is shuffled.
    """
    strata = ["task", "difficulty", "selected_for_llm"]
    own = Window.partitionBy(*strata).orderBy("__k", "id")
    turns = judged.withColumn("__k", digest(seed, F.col("id"))).withColumn("__turn", F.row_number().over(own)).where(F.col("__turn") <= size)
    taken = turns.orderBy("__turn", *strata).limit(size)
    place = F.row_number().over(Window.orderBy("__turn", *strata))  # over ``size`` rows
    return taken.withColumn("audit_id", identifier("audit-", place, 4)).drop("__k", "__turn")


def review(sampled: DataFrame) -> DataFrame:
    """What the reviewers see: nothing of the verdict."""
    shown = ["audit_id", "task", "difficulty", "instruction", "input", "output", "evidence", "source_title"]
    return sampled.select(*shown, F.lit(None).cast("string").alias("human_verdict"), F.array().cast("array<string>").alias("human_issues"))


def key(sampled: DataFrame) -> DataFrame:
    return sampled.select("audit_id", F.col("id").alias("candidate_id"), F.col("verdict").alias("system_verdict"), "selected_for_llm", "evaluator", F.col("issues").alias("system_issues"))


def check_complete(reviewed: DataFrame) -> None:
    if n := reviewed.where(~F.coalesce(F.col("human_verdict").isin(*VERDICTS), F.lit(False))).count():
        raise ValueError(f"the audit is incomplete: {n} rows have no valid human_verdict")


def score(reviewed: DataFrame, keys: DataFrame) -> DataFrame:
    """One row: sample_size, human_accept_rate, human_rejected, caught_human_rejections, reject_recall, llm_route_rate and whether the recall is met."""
    both = reviewed.join(keys, "audit_id")
    rejected = F.col("human_verdict") != "accept"
    s = both.agg(
        F.count("*").alias("sample_size"), F.count_if(~rejected).alias("a"), F.count_if(rejected).alias("human_rejected"),
        F.count_if(rejected & (F.col("system_verdict") != "accept")).alias("caught_human_rejections"), F.count_if("selected_for_llm").alias("r"),
    )
    rate = lambda x, n, empty: F.coalesce(F.try_divide(F.col(x), F.nullif(F.col(n), F.lit(0))), F.lit(empty))
    recall = rate("caught_human_rejections", "human_rejected", 1.0)
    return s.select(
        "sample_size", rate("a", "sample_size", 0.0).alias("human_accept_rate"), "human_rejected", "caught_human_rejections",
        recall.alias("reject_recall"), rate("r", "sample_size", 0.0).alias("llm_route_rate"), (recall >= RECALL).alias("meets_reject_recall_target"),
    )
