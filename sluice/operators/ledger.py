"""The run's ledger: append-only tables in rounds, their latest state, and its figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import friendly_reason

ATTEMPT_STATUSES = ("generated", "accept", "reject", "review", "error", "superseded")


@dataclass
class Ledger:
    """Tables under ``path``: slots (written once), attempts and evaluations (a folder a round), events and metadata."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/{name}")
        except AnalysisException:
            return None

    def append(self, name: str, df: DataFrame, round_: int) -> DataFrame:
        """Write a round's rows; doing it again replaces them, so a round that was cut off can be repeated."""
        where = f"{self.path}/{name}/round={round_}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def slots(self) -> DataFrame:
        """Slots with attempt_count, status ("accepted" or "pending") and accepted_id."""
        return slot_states(self.table("slots"), self.attempts())

    def attempts(self) -> DataFrame | None:
        """Attempts with the verdict of their evaluation, where there is one, in place of the status."""
        made = self.table("attempts")
        return None if made is None else judged_attempts(made, self.table("evaluations"))


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row by ``order`` of each key: a partial aggregate, without a sort."""
    rest = [c for c in df.columns if c not in key]
    out = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return out.select(*key, *(F.col(f"__r.{c}") for c in rest)).select(df.columns)


def judged_attempts(attempts: DataFrame, evaluations: DataFrame | None) -> DataFrame:
    last = latest(attempts, ["id"], ["round"]) if "round" in attempts.columns else attempts
    if evaluations is None:
        return last.withColumns({"issues": F.array().cast("array<string>"), "selected_for_llm": F.lit(False)})
    own = evaluations.select("id", "verdict", "issues", "selected_for_llm")
    both = last.join(own, "id", "left")
    return both.withColumns({"status": F.coalesce("verdict", "status"), "issues": F.coalesce("issues", F.array().cast("array<string>")), "selected_for_llm": F.coalesce("selected_for_llm", F.lit(False))}).drop("verdict")


def slot_states(slots: DataFrame, attempts: DataFrame | None) -> DataFrame:
    """slots(id, …) with attempt_count, status and accepted_id by attempts(slot_id, attempt, status, id)."""
    if attempts is None:
        return slots.withColumns({"attempt_count": F.lit(0), "status": F.lit("pending"), "accepted_id": F.lit(None).cast("string")})
    by = attempts.groupBy(F.col("slot_id").alias("id")).agg(F.max("attempt").alias("attempt_count"), F.min(F.when(F.col("status") == "accept", F.col("id"))).alias("accepted_id"))
    out = slots.join(by, "id", "left")
    return out.withColumns({"attempt_count": F.coalesce("attempt_count", F.lit(0)), "status": F.when(F.col("accepted_id").isNotNull(), "accepted").otherwise("pending")})


def pending(slots: DataFrame, max_attempts: int, limit: int) -> DataFrame:
    """The first ``limit`` slots by ordinal that may be tried again, with the number of the next attempt."""
    open_ = slots.where((F.col("status") != "accepted") & (F.col("attempt_count") < max_attempts))
    return open_.orderBy("ordinal").limit(limit).withColumn("attempt", F.col("attempt_count") + 1)


def counts(slots: DataFrame, attempts: DataFrame, max_attempts: int) -> DataFrame:
    """One row of the ledger's counters."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    open_ = F.col("status") != "accepted"
    a = slots.agg(F.count("*").alias("target"), is_("accepted").alias("accepted"), F.count_if(open_).alias("pending"), F.count_if(open_ & (F.col("attempt_count") >= max_attempts)).alias("exhausted"))
    b = attempts.agg(
        F.count("*").alias("attempted"), is_("reject").alias("rejected"), is_("review").alias("reviewed"), is_("error").alias("errors"), is_("generated").alias("generated"),
        is_("superseded").alias("speculative"), F.count_if("selected_for_llm").alias("llm_judged"),
        F.coalesce(F.sum(F.col("input_tokens").cast("long")), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum(F.col("output_tokens").cast("long")), F.lit(0)).alias("output_tokens"),
    )
    both = a.crossJoin(b)
    rate = F.when(F.col("attempted") > 0, F.col("accepted") / F.col("attempted")).otherwise(0.0)
    return both.withColumn("acceptance_rate", rate)


def deficits(slots: DataFrame) -> DataFrame:
    """name ("task:difficulty") and n of slots that aren't accepted."""
    return slots.where("status <> 'accepted'").groupBy("task", "difficulty").agg(F.count("*").alias("n")).select(F.concat_ws(":", "task", "difficulty").alias("name"), "n")


def attempted_documents(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("document_id").agg(F.count("*").alias("n"))


def accepted_documents(attempts: DataFrame) -> DataFrame:
    return attempts.where("status = 'accept'").groupBy("document_id").agg(F.count("*").alias("n"))


def recent(attempts: DataFrame, which: str = "attempts", limit: int = 20) -> DataFrame:
    """The last ``limit`` attempts, errors, rejections or successes by (created_at, id), with a plain reason."""
    tests = {
        "attempts": F.lit(True),
        "errors": (F.col("status") == "error") | F.col("error").isNotNull(),
        "rejections": F.col("status").isin("reject", "error") | (F.col("error").isNotNull() & (F.col("status") != "accept")),
        "successes": F.col("status") == "accept",
    }
    out = attempts.where(tests[which]).orderBy(F.desc("created_at"), F.desc("id")).limit(limit)
    return out.withColumn("reason", friendly_reason(F.col("error"), F.col("issues"), F.col("status")))


def next_shard(shards: DataFrame) -> DataFrame:
    """format, split and next_index by checkpoint shards(format, split, shard_index)."""
    return shards.groupBy("format", "split").agg((F.coalesce(F.max("shard_index"), F.lit(-1)) + 1).alias("next_index"))


def unsaved(accepted: DataFrame, formats: list[str], saved: DataFrame, split: str = "train") -> DataFrame:
    """(id, format, split) of accepted(id) that checkpoint items(candidate_id, format, split) don't have."""
    every = accepted.select("id", F.explode(F.array(*map(F.lit, formats))).alias("format"), F.lit(split).alias("split"))
    return every.join(saved.select(F.col("candidate_id").alias("id"), "format", "split"), ["id", "format", "split"], "left_anti")


def issue_counts(attempts: DataFrame) -> DataFrame:
    return attempts.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def issue_pairs(attempts: DataFrame) -> DataFrame:
    """How many attempts have exactly these two issues or more, by pair in order of name."""
    own = attempts.select(F.array_sort(F.array_distinct("issues")).alias("i"))
    pairs = F.flatten(F.transform("i", lambda a, k: F.transform(F.slice("i", k + 2, F.size("i")), lambda b: F.concat_ws("+", a, b))))
    return own.where("size(i) > 1").select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def accepted_by_attempt(attempts: DataFrame) -> DataFrame:
    return attempts.where("status = 'accept'").groupBy("attempt").agg(F.count("*").alias("n"))


def latest_metadata(metadata: DataFrame) -> DataFrame:
    """The last value of each key of metadata(key, value, seq)."""
    return latest(metadata, ["key"], ["seq"])
