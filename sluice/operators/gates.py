"""Deterministic gates: field checks, evidence checks, first-wins de-duplication, verdicts. All but text folding are Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.durable import written

CRITICAL = (
    "instruction_too_short", "duplicate_candidate", "source_reference_in_candidate", "missing_grounding",
    "invalid_section", "evidence_quote_mismatch", "invalid_evidence_offsets", "empty_instruction_or_output",
)
SHORT, WEAK = 12, 20


def _when(test: Column, issue: str) -> Column:
    return F.when(F.coalesce(test, F.lit(True)), F.lit(issue))


def with_folds(candidates: DataFrame) -> DataFrame:
    """candidates with folded instruction, input and output, and the fingerprint of the three."""
    out = candidates.withColumns({f"f_{c}": T.folded(F.coalesce(c, F.lit(""))) for c in ("instruction", "input", "output")})
    return out.withColumn("fingerprint", T.fingerprint(F.col("f_instruction"), F.col("f_input"), F.col("f_output")))


def field_issues(folded: DataFrame) -> Column:
    """Array of the issues of the three texts of rows from :func:`with_folds`; null texts count as empty."""
    empty = T.blank(F.col("instruction")) | T.blank(F.col("output"))
    short = F.length(F.coalesce("instruction", F.lit(""))) < SHORT
    told = T.has_reference(F.col("f_instruction"), F.col("f_input"), F.col("f_output"))
    return F.array_compact(F.array(_when(empty, "empty_instruction_or_output"), _when(short, "instruction_too_short"), _when(told, "source_reference_in_candidate")))


def evidence_checks(evidence: Column, sections: Column) -> Column:
    """Array of struct(issue, snippet), one for each piece of evidence: what is wrong with it, and its text unless it is unusable."""
    named = lambda e: F.try_element_at(F.filter(sections, lambda s: s["id"] == e["section_id"]), F.lit(-1))["text"]
    joined = F.transform(evidence, lambda e: F.struct(e["start"].alias("s"), e["end"].alias("e"), e["quote"].alias("q"), named(e).alias("t")))

    def judged(x: Column) -> Column:
        part = F.substring(x["t"], x["s"] + 1, x["e"] - x["s"])
        issue = (
            F.when(x["t"].isNull(), "invalid_section")
            .when((x["e"] > F.length(x["t"])) | (x["s"] >= x["e"]), "invalid_evidence_offsets")
            .when((F.coalesce(x["q"], F.lit("")) != "") & (T.strip(x["q"]) != T.strip(part)), "evidence_quote_mismatch")
        )
        weak = F.when(F.length(T.strip(part)) < WEAK, "weak_grounding")
        return F.struct(F.coalesce(issue, weak).alias("issue"), F.when(issue.isNull(), part).alias("snippet"))

    return F.transform(joined, judged)


def evidence_issues(evidence: Column, sections: Column) -> tuple[Column, Column]:
    """(array of issues, is there a usable snippet). Null evidence counts as none."""
    checks = F.coalesce(evidence_checks(evidence, sections), F.array().cast("array<struct<issue:string,snippet:string>>"))
    usable = F.exists(checks, lambda c: c["snippet"].isNotNull())
    found = F.array_compact(F.transform(checks, lambda c: c["issue"]))
    return F.when(usable, found).otherwise(F.array_append(found, F.lit("missing_grounding"))), usable


def checked(candidates: DataFrame, docs: DataFrame) -> DataFrame:
    """candidates(…, document_id) with fingerprint, field issues, evidence issues and grounded, by docs(id, sections).

    Evidence is held against all chunks of the candidate's document. A document that isn't there has no sections.
    """
    folded = with_folds(candidates)
    fields = field_issues(folded)
    out = folded.withColumn("field_issues", fields).drop("f_instruction", "f_input", "f_output")
    own = docs.select(F.col("id").alias("document_id"), F.col("sections").alias("__s"))
    both = out.join(own, "document_id", "left")
    issues, usable = evidence_issues(F.col("evidence"), F.col("__s"))
    return both.withColumns({"evidence_issues": issues, "grounded": usable}).drop("__s")


def verdicts(rows: DataFrame, duplicate: Column) -> DataFrame:
    """rows from :func:`checked` with issues (each once, in the order of the gates), verdict, overall_score and scores."""
    again = F.when(duplicate, F.array(F.lit("duplicate_candidate"))).otherwise(F.array().cast("array<string>"))
    issues = F.array_distinct(F.concat("field_issues", again, "evidence_issues"))
    out = rows.withColumn("issues", issues)
    bad = F.arrays_overlap("issues", F.array(*map(F.lit, CRITICAL)))
    return out.withColumns(
        {
            "verdict": F.when(bad, "reject").otherwise("accept"),
            "overall_score": F.when(bad, 0.0).otherwise(5.0),
            "scores": F.create_map(F.lit("grounding"), F.when(F.col("grounded"), 5.0).otherwise(0.0)),
            "evaluator": F.lit("deterministic"),
            "selected_for_llm": F.lit(False),
        }
    ).drop("field_issues", "evidence_issues")


def _sound() -> Column:
    return ~F.arrays_overlap(F.concat("field_issues", "evidence_issues"), F.array(*map(F.lit, CRITICAL)))


def first_wins(rows: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """rows from :func:`checked` with ``duplicate``: is the fingerprint accepted already (prior(fingerprint)) or by an earlier sound row.

    Earlier is by (ordinal, attempt). The least place of a fingerprint is a partial aggregate, so a fingerprint that all
    rows share costs a row a partition, not one task that holds them all.
    """
    at = F.struct("ordinal", "attempt")
    first = rows.where(_sound()).groupBy("fingerprint").agg(F.min(at).alias("__first"))
    out = rows.join(first, "fingerprint", "left").withColumn("duplicate", F.coalesce(at > F.col("__first"), F.lit(False))).drop("__first")
    if prior is None:
        return out
    known = prior.select("fingerprint").distinct().withColumn("__known", F.lit(True))
    return out.join(known, "fingerprint", "left").withColumn("duplicate", F.col("duplicate") | F.coalesce("__known", F.lit(False))).drop("__known")


def winners(rows: DataFrame) -> DataFrame:
    """Of rows(slot_id, fingerprint, __at) in the order of __at, those whose slot and fingerprint no winner before them has.

    A row that comes first for its slot and for its fingerprint wins whatever the others do. A round takes all such rows
    and drops what shares a slot or fingerprint with them, so a batch takes as many rounds as its longest chain of rows that
    wait for each other, and none gathers rows in one task.
    """
    left, out = written(rows), None
    while not left.isEmpty():
        slot = left.groupBy("slot_id").agg(F.min("__at").alias("__s"))
        print_ = left.groupBy("fingerprint").agg(F.min("__at").alias("__f"))
        won = written(left.join(slot, "slot_id").join(print_, "fingerprint").where((F.col("__at") == F.col("__s")) & (F.col("__at") == F.col("__f"))).select(*rows.columns))
        out = won if out is None else out.union(won)
        left = written(left.join(won.select("slot_id"), "slot_id", "left_anti").join(won.select("fingerprint"), "fingerprint", "left_anti"))
    return left if out is None else out


def evaluate(candidates: DataFrame, docs: DataFrame, accepted_slots: DataFrame | None = None, prior: DataFrame | None = None) -> DataFrame:
    """A batch's evaluations: candidates of slots that are accepted (before, or earlier in the batch) get verdict "superseded".

    A superseded candidate isn't checked and claims no fingerprint. A batch of one candidate a slot, as the scheduler makes
    them, needs one pass; in one with several, what wins depends on what won before, see :func:`winners`.
    """
    batch = written(checked(candidates, docs))
    late = batch.limit(0)
    if accepted_slots is not None:
        ids = accepted_slots.select("slot_id").distinct()
        late, batch = batch.join(ids, "slot_id", "left_semi"), batch.join(ids, "slot_id", "left_anti")
    if batch.groupBy("slot_id").count().where("count > 1").isEmpty():
        judged = verdicts(first_wins(batch, prior), F.col("duplicate")).drop("duplicate")
    else:
        known = batch.limit(0).select("fingerprint") if prior is None else prior.select("fingerprint").distinct()
        marked = batch.join(known.withColumn("__known", F.lit(True)), "fingerprint", "left").withColumn("__at", F.struct("ordinal", "attempt", "id"))
        marked = written(marked.withColumn("__known", F.coalesce("__known", F.lit(False))))
        won = winners(marked.where(_sound() & ~F.col("__known")).select("slot_id", "fingerprint", "__at"))
        by_slot = won.select("slot_id", F.col("__at").alias("__slot"))
        by_print = won.select("fingerprint", F.col("__at").alias("__print"))
        seen = marked.join(by_slot, "slot_id", "left").join(by_print, "fingerprint", "left")
        seen = seen.withColumn("__gone", F.coalesce(F.col("__slot") < F.col("__at"), F.lit(False))).withColumn("duplicate", F.col("__known") | F.coalesce(F.col("__print") < F.col("__at"), F.lit(False)))
        seen = seen.drop("__slot", "__print", "__at", "__known")
        late = late.unionByName(seen.where("__gone").drop("__gone", "duplicate"))
        judged = verdicts(seen.where("not __gone").drop("__gone"), F.col("duplicate")).drop("duplicate")
    gone = verdicts(late, F.lit(False)).withColumns({"verdict": F.lit("superseded"), "issues": F.array().cast("array<string>"), "overall_score": F.lit(None).cast("double")})
    return judged.unionByName(gone)
