"""A run from corpus to exports: plan, rounds of generation and gates over the ledger, report, exports."""

from __future__ import annotations

import json
import math
import os
import re
import time
import uuid
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durable import written
from ..functions.hashing import remainder
from ..operators import chunking, eligibility, exporting, gates, generation, ledger, measures, planning
from ..sources import readers, sinks
from . import registry
from .config import Project, build, dump


def run_id(name: str, config_hash: str, now: datetime | None = None) -> str:
    """Time, name and start of the configuration's hash."""
    slug = re.sub(r"[\W_]", "-", name.lower()).strip("-")
    return f"{(now or datetime.now(UTC)).strftime('%Y%m%dT%H%M%SZ')}-{slug}-{config_hash[:8]}"


def corpus(spark: SparkSession, project: Project) -> tuple[DataFrame, DataFrame]:
    """(all documents, eligible documents in chunks) of a project's source."""
    rows = registry.find("sources", project.source.plugin)(spark, project.source.params)
    docs = readers.documents(readers.with_index(rows), project.source.field_map, project.source.plugin)
    ns = [c for c in ("ns", "namespace") if c in docs.schema["metadata"].dataType.fieldNames()]
    take = eligibility.eligible(F.col("text"), F.col("title"), F.col(f"metadata.{ns[0]}") if ns else None, project.source.profile)
    return docs, docs.where(take & eligibility.matches(project.source.filters, eligibility.resolver(docs)))


@contextmanager
def locked(path: str):
    """One driver at a time works on a run; the lock of a driver that is gone is taken over."""
    os.makedirs(path, exist_ok=True)
    file = f"{path}/run.lock"
    try:
        with open(file) as f:
            owner = int(f.read() or 0)
        os.kill(owner, 0)
        if owner != os.getpid():
            raise RuntimeError(f"process {owner} works on this run")
    except (FileNotFoundError, ProcessLookupError, ValueError):
        pass
    with open(file, "w") as f:
        f.write(str(os.getpid()))
    try:
        yield
    finally:
        os.unlink(file)


def make_plan(spark: SparkSession, project: Project, path: str) -> dict:
    """Write snapshot, index, slots and plan.json under a new folder ``path``."""
    if os.path.exists(f"{path}/plan.json"):
        raise planning.PlanError(f"{path} has a plan already")
    docs, take = corpus(spark, project)
    g, t = project.generation, project.target
    planning.assert_unique(docs)
    chunks = written(chunking.chunked(take, g.chunk_size, g.chunk_overlap))
    index = written(chunking.corpus_index(chunks, project.selection.strata, ready=True))
    slots, role = planning.plan(
        index, seed=project.selection.seed, target=t.examples, tasks=planning.quotas(t.examples, project.tasks.counts, project.tasks.weights),
        difficulties=planning.quotas(t.examples, project.difficulties.counts, project.difficulties.weights), count=project.selection.count,
        fraction=project.selection.fraction, minimum=t.minimum, maximum=t.maximum, reserve_fraction=t.reserve_fraction,
    )
    planning.assert_found(role, chunks)
    sinks.snapshot(chunks.join(role.select("id", "role"), "id"), f"{path}/documents")
    index.write.mode("overwrite").parquet(f"{path}/index")
    ledger.Ledger(spark, f"{path}/ledger").append("slots", slots, 0)
    facts = {"version": 2, "run_id": run_id(project.name, project.hash), "config_hash": project.hash, "seed": project.selection.seed, "estimates": planning.estimates(index, role, slots).first().asDict()}
    sinks.save_json(f"{path}/config.json", dump(project))
    sinks.save_json(f"{path}/plan.json", facts)
    return facts


def load_project(path: str) -> Project:
    with open(f"{path}/config.json", encoding="utf-8") as f:
        return build(Project, json.load(f))


def reassigned(jobs: DataFrame, docs: DataFrame, loads: DataFrame | None, *, seed: int, same: int, maximum: int) -> DataFrame:
    """jobs with the document of each attempt: after ``same`` attempts a reserve document with room, the slot's own if there is none.

    A search starts at a seeded place of the reserve, in the order of the source, and goes on until it finds room, and each
    find takes up room for the next, so the retries of a batch, which the scheduler bounds, are decided in order; all other
    jobs stay as they are.
    """
    if not (late := jobs.where(F.col("attempt") > same).orderBy("ordinal").select("id", "attempt", "document_id").collect()):
        return jobs
    spark = jobs.sparkSession
    from ..operators.ranking import ranked

    placed = F.col("metadata.raw_index") if "metadata" in docs.columns and "raw_index" in docs.schema["metadata"].dataType.fieldNames() else F.lit(0)
    reserve = written(ranked(docs.where("role = 'reserve'").select("id", placed.alias("at")), [], ["at", "id"], "place").select("id", (F.col("place") - 1).alias("place")))
    if not (n := reserve.count()):
        return jobs
    full = {} if loads is None else {r.place: r.n for r in reserve.join(loads.withColumnRenamed("document_id", "id"), "id").select("place", "n").collect()}
    starts = {(r.slot, r.attempt): r.at for r in spark.createDataFrame([(r.id, r.attempt) for r in late], "slot string, attempt int").withColumn("at", remainder(seed, n, F.col("slot"), F.col("attempt"))).collect()}
    picked: list[tuple[str, int]] = []
    for r in late:
        at = starts[r.id, r.attempt]
        place = next(((at + i) % n for i in range(n) if full.get((at + i) % n, 0) < maximum), None)
        if place is not None:
            full[place] = full.get(place, 0) + 1
            picked.append((r.id, place))
    if not picked:
        return jobs
    new = spark.createDataFrame(picked, "id string, place long").join(reserve.withColumnRenamed("id", "__new"), "place").select("id", "__new")
    return jobs.join(F.broadcast(new), "id", "left").withColumn("document_id", F.coalesce("__new", "document_id")).drop("__new")  # a batch of jobs at most


def report(slots: DataFrame, attempts: DataFrame, project: Project, status: str, rounds: list[dict]) -> dict:
    facts = ledger.counts(slots, attempts, project.target.max_attempts_per_slot).first().asDict()
    return {"status": status, **facts, "deficits": {r.name: r.n for r in ledger.deficits(slots).orderBy("name").collect()}, "rounds": rounds}


def execute(spark: SparkSession, path: str, stop=lambda: False) -> dict:
    """Work on a plan until its target is met, nothing may be tried again, or ``stop()``; doing so again goes on from there.

    A round writes its attempts before they are judged, so no answer is asked for twice, and each table of a round is
    committed as a whole: what a lost driver leaves is finished first. Each round reads written tables, not its elders' plans.
    """
    project = load_project(path)
    with open(f"{path}/plan.json", encoding="utf-8") as f:
        facts = json.load(f)
    if facts["config_hash"] != project.hash:
        raise planning.PlanError("the plan was made for another configuration")
    t, g = project.target, project.generation
    book = ledger.Ledger(spark, f"{path}/ledger")
    docs = spark.read.parquet(f"{path}/documents")
    backend = registry.find("backends", g.backend)(**({"model": g.model, "in_flight": g.in_flight, "queue": g.queue, "ordered": g.ordered} | g.params if g.backend != "fake" else {}))
    budget, rounds, status = math.ceil(t.examples * t.max_total_attempt_multiplier), [], "partial"
    with locked(path):
        while True:
            made = book.table("attempts")
            number = 1 if made is None else (made.agg(F.max("round")).first()[0] or 0) + 1
            judged = book.table("evaluations")
            waiting = None if made is None else made.where("status = 'generated'")
            if waiting is not None and judged is not None:
                waiting = waiting.join(judged.select("id"), "id", "left_anti")
            if waiting is not None and not waiting.isEmpty():
                # left by a driver that was lost between a round's two writes
                number -= 1
                _judge(book, waiting.drop("round"), docs, judged, number)
                _save(book, path, project, number)
                continue
            attempts = book.attempts()
            slots = written(ledger.slot_states(book.table("slots"), attempts))
            done = slots.where("status = 'accepted'").count()
            used = 0 if attempts is None else attempts.count()
            if done >= t.examples:
                status = "completed"
                break
            jobs = ledger.pending(slots, t.max_attempts_per_slot, min(project.runtime.scheduler_batch, max(0, budget - used)))
            if stop() or len(rounds) >= project.runtime.max_rounds:
                status = "interrupted"
                break
            jobs = written(jobs)
            if jobs.isEmpty():
                break
            began = time.monotonic()
            loads = None if attempts is None else ledger.accepted_documents(attempts)
            jobs = reassigned(jobs, docs, loads, seed=facts["seed"], same=t.same_document_attempts, maximum=t.maximum)
            asked = generation.requests(
                jobs.withColumnRenamed("id", "slot_id").select("slot_id", "document_id", "task", "difficulty", "chunk_id", "ordinal", "attempt"), docs, seed=facts["seed"],
                language=g.language, max_input_tokens=g.max_input_tokens, max_output_tokens=g.max_output_tokens,
            )
            fresh = generation.candidates(generation.answers(asked, backend), g.keep_raw).withColumn("created_at", F.current_timestamp())
            fresh = book.append("attempts", fresh, number)
            _judge(book, fresh.where("status = 'generated'"), docs, judged, number)
            _save(book, path, project, number)
            rounds.append({"round": number, "attempts": fresh.count(), "seconds": round(time.monotonic() - began, 3)})
            sinks.save_json(f"{path}/progress.json", {"phase": "running", "target": t.examples, "accepted": done, "attempted": used + rounds[-1]["attempts"], "round": number})
        attempts = book.attempts()
        empty = spark.createDataFrame([], "slot_id string, status string, selected_for_llm boolean, input_tokens int, output_tokens int")
        out = report(slots, empty if attempts is None else attempts, project, status, rounds)
        if attempts is not None:
            timed = attempts.select(F.lit(1).alias("all"), "latency_seconds", "input_tokens", "output_tokens", "queue_depth", F.lit(float(sum(r["seconds"] for r in rounds))).alias("duration_seconds"), F.lit(0.0).alias("startup_seconds"))
            out["metrics"] = measures.stage_metrics(timed, ["all"]).drop("all").first().asDict()
        sinks.save_json(f"{path}/report.json", out)
        sinks.save_json(f"{path}/progress.json", {"phase": "finished", "status": status, "target": t.examples, "accepted": out["accepted"], "accepted_percent": round(out["accepted"] * 100 / t.examples, 3), "eta_seconds": None})
        if status == "completed":
            exports(spark, path)
    return out


def _judge(book: ledger.Ledger, batch: DataFrame, docs: DataFrame, judged: DataFrame | None, number: int) -> None:
    accepted = None if judged is None else judged.where("verdict = 'accept'")
    out = gates.evaluate(batch, docs, accepted, accepted)
    book.append("evaluations", out.select("id", "slot_id", "fingerprint", "verdict", "issues", "overall_score", "scores", "evaluator", "selected_for_llm"), number)


def _save(book: ledger.Ledger, path: str, project: Project, number: int) -> None:
    sinks.checkpoint(accepted_candidates(book), f"{path}/checkpoints", project.output.formats, number, rows=project.output.shard_rows)


def save(spark: SparkSession, path: str) -> int:
    """Write the checkpoint shards that accepted candidates of a run lack; how many items that were."""
    book, project = ledger.Ledger(spark, f"{path}/ledger"), load_project(path)
    with locked(path):
        number = book.table("attempts").agg(F.max("round")).first()[0] or 0
        items = ledger.Ledger(spark, f"{path}/checkpoints").table("items")
        last = 0 if items is None else items.agg(F.max("round")).first()[0] or 0
        return sinks.checkpoint(accepted_candidates(book), f"{path}/checkpoints", project.output.formats, max(number, last + 1), rows=project.output.shard_rows).count()


def finished(path: str) -> bool:
    """Has the last run of this plan ended?"""
    try:
        with open(f"{path}/progress.json", encoding="utf-8") as f:
            return json.load(f)["phase"] == "finished"
    except FileNotFoundError:
        return False


def accepted_candidates(book: ledger.Ledger) -> DataFrame:
    done = book.table("evaluations").where("verdict = 'accept'").select("id")
    return book.table("attempts").join(done, "id", "left_semi").drop("round")


def exports(spark: SparkSession, path: str) -> str:
    """Write the layouts of what is accepted, generation_info.json and a dataset card."""
    project = load_project(path)
    book = ledger.Ledger(spark, f"{path}/ledger")
    good = accepted_candidates(book)
    out = f"{path}/exports"
    exporting.export(good, out, ratios=project.output.splits, seed=project.selection.seed, formats=project.output.formats, containers=project.output.containers)
    n, g = good.count(), project.generation
    sinks.save_json(f"{out}/generation_info.json", {"project": project.name, "examples": n, "formats": project.output.formats, "containers": project.output.containers, "generator": g.model, "evaluator": "deterministic only", "config_hash": project.hash})
    container = "parquet" if "parquet" in project.output.containers else "jsonl"
    with open(f"{out}/README.md", "w", encoding="utf-8") as f:
        f.write(exporting.card(project.name, n, g.model, project.hash, project.output.formats, container, [s for s in exporting.SPLITS if project.output.splits.get(s)]))
    return out


def new_run(root: str) -> str:
    return f"{root.rstrip('/')}/{uuid.uuid4().hex[:12]}"
