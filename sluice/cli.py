"""Command line: python -m sluice <command> …; results are JSON or KEY=VALUE lines on standard output.

Exit codes: 0 done, 2 a configuration or corpus that can't be used, 3 ``doctor`` found problems, 4 a run that is partial or interrupted.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.durable import written
from .operators import audit, eligibility, ledger, planning, unchunk
from .plans import config, engine, registry
from .sources import readers, sinks


def _value(text: str) -> object:
    try:
        return json.loads(text)
    except ValueError:
        return text


def pairs(items: list[str]) -> dict[str, object]:
    """KEY=VALUE options; a value that is JSON is taken as such."""
    out = {}
    for item in items:
        key, sep, value = item.partition("=")
        if not sep or not key:
            raise config.ConfigError(f"{item!r} is not KEY=VALUE")
        out[key] = _value(value)
    return out


def project_name(source: str) -> str:
    """The last part of a path or dataset name, in lower case with dashes."""
    stem = os.path.splitext(source.rstrip("/").rsplit("/", 1)[-1])[0].lower()
    return "".join(c if c.isalnum() else "-" for c in stem).strip("-") or "synthetic-sft"


def _direct(a: argparse.Namespace) -> config.Project:
    """A project from options alone."""
    names = [t for t in a.tasks.split(",") if t] if a.tasks else registry.names("tasks")
    if unknown := sorted(set(names) - set(registry.names("tasks"))):
        raise config.ConfigError("unknown tasks: " + ", ".join(unknown))
    return config.build(
        config.Project,
        {
            "name": a.name or project_name(a.source),
            "source": {"params": {"path": a.source} | ({"format": a.format} if a.format else {}), "field_map": pairs(a.field), "filters": pairs(a.filter), "profile": a.profile},
            "selection": {"count": a.documents, "fraction": a.fraction if a.documents is None else None, "seed": a.seed, "strata": a.strata.split(",") if a.strata else []},
            "tasks": {"weights": dict.fromkeys(names, 1.0)},
            "target": {"examples": a.examples, "minimum": a.per_document[0], "maximum": a.per_document[1], "reserve_fraction": a.reserve},
            "generation": {"backend": a.backend, "model": a.model, "chunk_size": a.chunk[0], "chunk_overlap": a.chunk[1], "params": pairs(a.param)},
            "output": {"formats": a.formats.split(","), "containers": a.containers.split(","), "splits": {k: float(v) for k, v in pairs(a.split).items()} or {"train": 1.0}},
        },
    )


def preflight(spark: SparkSession, a: argparse.Namespace) -> dict:
    docs = readers.documents(readers.with_index(readers.read(spark, a.source, a.format)), pairs(a.field))
    ns = [c for c in ("ns", "namespace") if c in docs.schema["metadata"].dataType.fieldNames()]
    take = eligibility.eligible(F.col("text"), F.col("title"), F.col(f"metadata.{ns[0]}") if ns else None, a.profile)
    return planning.preflight(docs, take, count=a.documents, fraction=a.fraction, minimum=a.per_document[0], maximum=a.per_document[1]).first().asDict()


def status(spark: SparkSession, path: str) -> dict:
    book = ledger.Ledger(spark, f"{path}/ledger")
    attempts = book.attempts()
    empty = spark.createDataFrame([], "slot_id string, status string, selected_for_llm boolean, input_tokens int, output_tokens int")
    slots = ledger.slot_states(book.table("slots"), attempts)
    return ledger.counts(slots, empty if attempts is None else attempts, engine.load_project(path).target.max_attempts_per_slot).first().asDict()


def rebuild(spark: SparkSession, a: argparse.Namespace) -> dict:
    own = pairs(a.source_split)
    rows = readers.read_splits(spark, {k: str(v) for k, v in own.items()}) if own else readers.read(spark, a.source)
    o = unchunk.Options(
        text=a.text, index=a.index, total=a.total, group_by=tuple(a.group_by.split(",")) if a.group_by else (), group_id=a.group_id, strategy=a.strategy,
        max_overlap=a.max_overlap, expected_overlap=a.expected_overlap, split_policy=a.split_policy,
    )
    docs, quarantine = unchunk.reconstructed(rows, o)
    sinks.unchunked(docs.drop("conflicts", "overlaps"), quarantine, a.out, a.rows_per_file)
    out = unchunk.report(rows, docs, quarantine)
    sinks.save_json(f"{a.out}/reports/report.json", out)
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    two = {"nargs": 2, "type": int}

    def corpus(name: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("source")
        c.add_argument("--format")
        c.add_argument("--profile")
        c.add_argument("--field", action="append", default=[], metavar="NAME=PATH")
        c.add_argument("--documents", type=int)
        c.add_argument("--fraction", type=float)
        c.add_argument("--per-document", **two, default=[1, 3])
        return c

    corpus("preflight")
    for name in ("plan", "run"):
        c = corpus(name)
        c.add_argument("out")
        c.add_argument("--config")
        c.add_argument("--examples", type=int, default=100)
        for flag, default in (("--name", None), ("--tasks", None), ("--strata", None), ("--backend", "fake"), ("--model", "fake-generator"), ("--formats", "messages"), ("--containers", "jsonl")):
            c.add_argument(flag, default=default)
        c.add_argument("--seed", type=int, default=42)
        c.add_argument("--reserve", type=float, default=0.0)
        c.add_argument("--chunk", **two, default=[8000, 400])
        for flag in ("--filter", "--param", "--split"):
            c.add_argument(flag, action="append", default=[], metavar="KEY=VALUE")
    sub.add_parser("validate").add_argument("config")
    for name in ("resume", "status", "checkpoint", "export", "audit-sample", "audit-score", "inspect"):
        c = sub.add_parser(name)
        c.add_argument("out")
        if name == "status":
            c.add_argument("--watch", type=float, metavar="SECONDS")
        c.add_argument("--size", type=int, default=300)
        c.add_argument("--seed", type=int, default=42)
        c.add_argument("--limit", type=int, default=20)
        c.add_argument("--what", default="attempts", choices=("attempts", "errors", "rejections", "successes"))
    c = sub.add_parser("unchunk")
    c.add_argument("source", nargs="?")
    c.add_argument("out")
    for flag, default in (("--text", "text"), ("--index", "chunk_index"), ("--total", "chunk_total"), ("--group-by", None), ("--group-id", None), ("--strategy", "auto"), ("--split-policy", "train")):
        c.add_argument(flag, default=default)
    c.add_argument("--max-overlap", type=int, default=256)
    c.add_argument("--expected-overlap", type=int)
    c.add_argument("--rows-per-file", type=int, default=10_000)
    c.add_argument("--source-split", action="append", default=[], metavar="NAME=PATH")
    for name in ("schema", "plugins", "doctor"):
        sub.add_parser(name)
    return p


def _ended(out: dict) -> int:
    """Print a run's report; the exit code is 0 if it reached its target and 4 if it is partial or interrupted."""
    print(json.dumps(out, default=str))
    return 0 if out["status"] == "completed" else 4


def doctor(spark: SparkSession) -> dict:
    """What is there, and ``problems`` that a run would have."""
    problems = []
    try:
        written(spark.range(1))
    except Exception as e:  # whatever the storage raises
        problems.append(f"shared folder: {e}")
    try:
        spark.range(1).mapInArrow(lambda batches: batches, "id long").collect()
    except Exception as e:  # a worker without pyarrow, or of another version
        problems.append(f"Python workers: {e}")
    return {"problems": problems, "python": sys.version.split()[0], "spark": spark.version, "cores": spark.sparkContext.defaultParallelism, "shared_folder": spark.conf.get("spark.checkpoint.dir", None), "plugins": {k: registry.names(k) for k in registry.KINDS}}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "schema":
        print(json.dumps(config.schema(), indent=2))
        return 0
    if a.command == "plugins":
        print("\n".join(f"{k}: {', '.join(registry.names(k))}" for k in registry.KINDS))
        return 0
    spark = spark or SparkSession.builder.appName("sluice").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if a.command == "preflight":
            print("\n".join(f"{k.upper()}={'' if v is None else v}" for k, v in preflight(spark, a).items()))
        elif a.command in ("plan", "run"):
            project = config.load(a.config) if a.config else _direct(a)
            facts = engine.make_plan(spark, project, a.out)
            return _ended(engine.execute(spark, a.out)) if a.command == "run" else print(json.dumps(facts, default=str)) or 0
        elif a.command == "resume":
            return _ended(engine.execute(spark, a.out))
        elif a.command == "validate":
            project = config.load(a.config)
            for kind, name in (("sources", project.source.plugin), ("backends", project.generation.backend)):
                registry.find(kind, name)
            print(json.dumps({"valid": True, "name": project.name, "config_hash": project.hash}))
        elif a.command == "status":
            while True:
                print(json.dumps(status(spark, a.out)), flush=True)
                if not a.watch or engine.finished(a.out):
                    break
                time.sleep(a.watch)
        elif a.command == "checkpoint":
            print(json.dumps({"items": engine.save(spark, a.out)}))
        elif a.command == "export":
            print(engine.exports(spark, a.out))
        elif a.command == "inspect":
            rows = ledger.Ledger(spark, f"{a.out}/ledger").attempts()
            for r in ledger.recent(rows, a.what, a.limit).select("id", "document_id", "status", "reason").collect():
                print(json.dumps(r.asDict(), ensure_ascii=False))
        elif a.command == "audit-sample":
            book = ledger.Ledger(spark, f"{a.out}/ledger")
            judged = book.table("attempts").drop("round").join(book.table("evaluations").select("id", "verdict", "issues", "evaluator", "selected_for_llm"), "id")
            got = audit.sample(judged, a.size, a.seed)
            for name, df in (("review", audit.review(got)), ("key", audit.key(got))):
                df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{a.out}/audit/{name}")
            print(f"{a.out}/audit/review")
        elif a.command == "audit-score":
            reviewed = spark.read.schema("audit_id string, human_verdict string").json(f"{a.out}/audit/review")
            audit.check_complete(reviewed)
            keys = spark.read.schema("audit_id string, system_verdict string, selected_for_llm boolean").json(f"{a.out}/audit/key")
            print(json.dumps(audit.score(reviewed, keys).first().asDict()))
        elif a.command == "unchunk":
            print(json.dumps(rebuild(spark, a)))
        elif a.command == "doctor":
            found = doctor(spark)
            print(json.dumps(found, indent=2))
            return 3 if found["problems"] else 0
    except (ValueError, NotImplementedError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0
