"""Requests, backends and candidates."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.hashing import marker, request_seed
from .chunking import pick

SYSTEM = (
    "Write a single training example for instruction tuning out of the source passage that you are given, and answer with JSON in the requested schema only. "
    "Every fact must come from the passage. Use the requested language throughout. The instruction has to make sense to a reader who never sees the passage, "
    "so don't point to it in any words or language. Leave out your reasoning. Offsets of evidence count characters within the named section."
)
#: Guidance by task.
TASKS = {
    "definition": "Ask for an exact definition that rests on the passage alone.",
    "closed_qa": "Ask one question, not a trivial one, with a single answer that the passage supports.",
    "summarization": "Ask for a focused summary that keeps the important facts.",
    "information_extraction": "Ask for facts to be extracted into a structure that the instruction spells out.",
    "comparison": "Ask for a comparison, if the passage covers both sides.",
    "classification": "Ask for a label that the passage can justify.",
    "timeline": "Ask for events in order, if the passage dates several of them.",
    "rewrite": "Ask for a rewriting under a constraint that adds no facts.",
    "concept_explanation": "Ask for a concept to be explained as a teacher would, from the passage.",
    "structured_extraction": "Ask for an extraction with a compact structured output.",
    "fact_checking": "Ask whether a claim is true, with direct evidence for the answer.",
    "taxonomy": "Ask for a taxonomy of categories that the passage supports.",
    "short_answer": "Ask a concise factual question that needs a short answer.",
    "didactic_explanation": "Ask for clear teaching at the requested difficulty.",
}
DIFFICULTIES = ("easy", "medium", "hard")
RISKS = ("low", "medium", "high")
#: Tokens left free for a chat template.
MARGIN = 128
EVIDENCE = "array<struct<document_id:string,section_id:string,start:int,end:int,quote:string>>"
PAYLOAD = "struct<instruction:string,input:string,output:string,risk:string,difficulty:string,evidence:array<struct<section_id:string,start:string,end:string,quote:string>>>"
#: What a model is asked to answer in, where its server can hold it to a schema.
_STRING = {"type": "string"}
_WHERE = {"type": "object", "properties": {"section_id": _STRING, "start": {"type": "integer", "minimum": 0}, "end": {"type": "integer", "minimum": 1}, "quote": _STRING}, "required": ["section_id", "start", "end"]}
SCHEMA = {
    "type": "object",
    "properties": {"instruction": _STRING, "input": _STRING, "output": _STRING, "risk": _STRING | {"enum": list(RISKS)}, "difficulty": _STRING | {"enum": list(DIFFICULTIES)}, "evidence": {"type": "array", "items": _WHERE}},
    "required": ["instruction", "output", "evidence"],
}
Counter = Callable[[Sequence[str]], list[int]]


def count_quarters(texts: Sequence[str]) -> list[int]:
    """The approximate counter: a quarter of the characters, rounded up, at least 1."""
    return [max(1, (len(t) + 3) // 4) for t in texts]


def evidence_sections(docs: DataFrame) -> Column:
    """A document's sections, or one of its whole text."""
    whole = F.array(F.struct(F.lit("0").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.col("title").alias("title")))
    return F.when(F.coalesce(F.size("sections"), F.lit(0)) > 0, F.col("sections")).otherwise(whole)


def rendered(sections: Column) -> Column:
    """Sections as text, each under a line with its id, with an empty line between."""
    return F.array_join(F.transform(sections, lambda s: F.concat(F.lit("[section_id="), s["id"], F.lit("]\n"), s["text"])), "\n\n")


def _head(ids: list[str], texts: list[str], chars: int) -> str:
    """Sections as :func:`rendered` does, with the first ``chars`` characters of their texts in all."""
    out = []
    for i, t in zip(ids, texts, strict=True):
        if chars <= 0:
            break
        if t:
            out.append(f"[section_id={i}]\n{t[:chars]}")
        chars -= len(t)
    return "\n\n".join(out)


def fitted(prompt: Column, sections: Column, max_tokens: int, counter: Counter = count_quarters) -> Column:
    """struct(text, truncated): as many characters of the sections as the tokens left by ``prompt`` (without them) hold.

    Tokens are counted over the JSON-escaped text, headers with it. ValueError where the prompt alone leaves none.
    """

    @F.pandas_udf("text string, truncated boolean")
    def run(prompts: pd.Series, ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        escaped = lambda x: json.dumps(x, ensure_ascii=False)[1:-1]
        room = [max_tokens - n - MARGIN for n in counter(list(prompts))]
        if min(room, default=1) <= 0:
            raise ValueError("max_input_tokens is too small for the prompt")
        own = [(list(i), ["" if t is None else t for t in x]) for i, x in zip(ids, texts, strict=True)]
        whole = ["\n\n".join(f"[section_id={i}]\n{t}" for i, t in zip(*o, strict=True)) for o in own]
        over = [k for k, n in enumerate(counter([escaped(w) for w in whole])) if n > room[k]]
        low, high = dict.fromkeys(over, 0), {k: sum(map(len, own[k][1])) for k in over}
        open_ = [k for k in over if low[k] < high[k]]
        while open_:  # one count of all open rows a round
            mid = {k: (low[k] + high[k] + 1) // 2 for k in open_}
            for k, n in zip(open_, counter([escaped(_head(*own[k], mid[k])) for k in open_]), strict=True):
                if n <= room[k]:
                    low[k] = mid[k]
                else:
                    high[k] = mid[k] - 1
            open_ = [k for k in open_ if low[k] < high[k]]
        for k in over:
            whole[k] = _head(*own[k], low[k])
        return pd.DataFrame({"text": whole, "truncated": pd.Series(range(len(whole))).isin(over)})

    return run(prompt, F.transform(sections, lambda s: s["id"]), F.transform(sections, lambda s: s["text"]))


def requests(jobs: DataFrame, docs: DataFrame, *, seed: int, language: str = "en", max_input_tokens: int = 53_248, max_output_tokens: int = 4096, counter: Counter = count_quarters) -> DataFrame:
    """Requests for jobs(slot_id, document_id, task, difficulty, chunk_id, ordinal, attempt) over docs(id, source, title, text, sections).

    request_id, seed, messages and so on, a row a job whose document is there. Documents are joined by their id; Catalyst
    broadcasts the jobs of a round, which the scheduler bounds, rather than shuffle the corpus.
    """
    both = jobs.join(docs.select(F.col("id").alias("document_id"), "source", "title", evidence_sections(docs).alias("__all")), "document_id")
    chosen = pick(F.col("__all"), F.col("chunk_id"), (F.col("ordinal") + F.col("attempt") - 2).cast("int"))
    shown = F.when(F.col("chunk_id").isNull(), F.col("__all")).otherwise(F.array(chosen))
    guidance = F.create_map(*(F.lit(x) for kv in TASKS.items() for x in kv))
    both = both.withColumn("__shown", shown).withColumn("request_id", F.concat("slot_id", F.lit("-a"), F.col("attempt").cast("string")))

    def payload(context: Column, truncated: Column) -> Column:
        parts = F.struct(
            F.col("task").alias("task"), F.lit(language).alias("language"), F.col("difficulty").alias("difficulty"), F.try_element_at(guidance, F.col("task")).alias("task_guidance"),
            F.col("document_id").alias("document_id"), F.col("title").alias("title"), truncated.alias("context_truncated"), context.alias("source_excerpt"),
        )
        return F.to_json(parts, {"ignoreNullFields": "false"})

    bare = F.concat(F.lit(SYSTEM + "\n"), payload(F.lit(""), F.lit(True)))
    both = both.withColumn("__c", fitted(bare, F.col("__shown"), max_input_tokens, counter))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return both.select(
        "request_id", request_seed(seed, F.col("request_id")).alias("seed"), "slot_id", "ordinal", "attempt", "document_id", "source", "title", "task", "difficulty",
        F.get(F.col("__shown"), F.lit(0))["id"].alias("chunk_id"), F.array(message("system", F.lit(SYSTEM)), message("user", payload(F.col("__c.text"), F.col("__c.truncated")))).alias("messages"),
        F.lit(max_output_tokens).alias("max_output_tokens"), F.col("__c.truncated").alias("context_truncated"),
    )


def fake_answers(asked: DataFrame, model: str = "fake-generator") -> DataFrame:
    """asked with raw (JSON text), error, tokens and latency from the deterministic backend, as columns alone."""
    evidence = F.array(F.struct(F.coalesce("chunk_id", F.lit("0")).alias("section_id"), F.lit(0).alias("start"), F.lit(24).alias("end")))
    told = F.struct(
        F.format_string("Complete this %s task at %s difficulty.", "task", "difficulty").alias("instruction"), F.lit("").alias("input"),
        F.format_string("A grounded %s answer for %s. Deterministic test marker: %s.", F.col("task"), F.col("document_id"), marker(F.col("slot_id"), F.col("document_id"))).alias("output"),
        F.lit("low").alias("risk"), evidence.alias("evidence"),
    )
    none = F.lit(None)
    return asked.withColumns({"raw": F.to_json(told), "error": none.cast("string"), "input_tokens": none.cast("int"), "output_tokens": none.cast("int"), "latency_seconds": F.lit(0.0), "queue_depth": F.lit(0), "generator": F.lit("fake"), "model": F.lit(model)})


class Backend:
    """What a model needs to be: ``answer`` gets a request as a dict and returns (raw text, input tokens, output tokens) or raises."""

    name = "backend"

    def __init__(self, model: str = "", in_flight: int = 8, queue: int = 64, ordered: bool = False):
        if in_flight < 1 or queue < in_flight:
            raise ValueError("a queue holds at least what is in flight")
        self.model, self.in_flight, self.queue, self.ordered = model, in_flight, queue, ordered

    def answer(self, request: dict) -> tuple[str, int | None, int | None]:
        raise NotImplementedError


class HttpBackend(Backend):
    """Chat completions over HTTP; asks for a JSON schema and, where the server refuses that with status 400, without it."""

    name = "openai_compatible"

    def __init__(self, url: str, model: str, key_env: str | None = None, timeout: float = 120.0, schema: dict | None = SCHEMA, temperature: float = 0.1, **kw):
        super().__init__(model, **kw)
        self.url, self.key_env, self.timeout, self.schema, self.temperature = url.rstrip("/"), key_env, timeout, schema, temperature

    def _post(self, body: dict) -> dict:
        import os
        import urllib.request

        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {os.environ[self.key_env]}"} if self.key_env else {})
        asked = urllib.request.Request(f"{self.url}/chat/completions", json.dumps(body).encode(), head)
        with urllib.request.urlopen(asked, timeout=self.timeout) as got:
            return json.load(got)

    def answer(self, request: dict) -> tuple[str, int | None, int | None]:
        from urllib.error import HTTPError

        body = {"model": self.model, "messages": [dict(m) for m in request["messages"]], "seed": request["seed"], "max_tokens": request["max_output_tokens"], "temperature": self.temperature}
        wanted = {"response_format": {"type": "json_schema", "json_schema": {"name": "candidate", "schema": self.schema}}} if self.schema else {}
        try:
            got = self._post(body | wanted)
        except HTTPError as e:
            if e.code != 400 or not wanted:
                raise
            got = self._post(body)
        used = got.get("usage") or {}
        return got["choices"][0]["message"]["content"], used.get("prompt_tokens"), used.get("completion_tokens")


def stream(backend: Backend, rows: Iterator[dict]) -> Iterator[dict]:
    """Answers as they complete (or in order of submission), with at most ``in_flight`` at work and ``queue`` read ahead; errors stay with their row."""
    import time

    def work(row: dict, began: float, depth: int) -> dict:
        try:
            raw, i, o = backend.answer(row)
            got = {"raw": raw, "error": None, "input_tokens": i, "output_tokens": o}
        except Exception as e:  # a failed request is a row of its own, not a failed task
            got = {"raw": None, "error": f"{type(e).__name__}: {e}", "input_tokens": None, "output_tokens": None}
        return row | got | {"latency_seconds": time.monotonic() - began, "queue_depth": depth}

    with ThreadPoolExecutor(1 if backend.ordered else backend.in_flight) as pool:
        held: list[Future] = []
        for row in rows:
            held.append(pool.submit(work, row, time.monotonic(), len(held)))
            if len(held) >= backend.queue:
                done = {held[0]} if backend.ordered else wait(held, return_when=FIRST_COMPLETED).done
                wait(done)
                yield from (f.result() for f in held if f in done)
                held = [f for f in held if f not in done]
        if backend.ordered:
            yield from (f.result() for f in held)
        else:
            from concurrent.futures import as_completed

            yield from (f.result() for f in as_completed(held))


def answers(asked: DataFrame, backend: Backend | None = None, size: int = 128) -> DataFrame:
    """asked with the backend's answers (see :func:`fake_answers`, which stands in without one), ``size`` rows to a frame.

    Nothing is retried here: the result must be written once before it is read, or the model is asked again.
    """
    if backend is None:
        return fake_answers(asked)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the rows go through as they are read, and wait in the queue's room only
        rows = (row for f in frames for row in f.to_dict("records"))
        held: list[dict] = []
        for row in stream(backend, rows):
            held.append(row)
            if len(held) >= size:
                yield pd.DataFrame(held)
                held = []
        if held:
            yield pd.DataFrame(held)

    fields = asked.schema.simpleString()[len("struct<") : -1]
    more = "raw:string,error:string,input_tokens:int,output_tokens:int,latency_seconds:double,queue_depth:int"
    out = asked.mapInPandas(run, f"struct<{fields},{more}>")
    return out.withColumns({"generator": F.lit(backend.name), "model": F.lit(backend.model)})


def candidates(answered: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Attempts: answered rows with the candidate that their JSON makes; an answer that isn't one becomes an error.

    status is "generated" or "error". Texts are stripped, missing ones empty, risk "medium" unless given; the slot's
    difficulty stands whatever the answer says. With ``keep_raw`` the answer is kept as text.
    """
    body = T.model_json(F.col("raw"))
    got = answered.withColumn("__p", F.from_json(body, PAYLOAD)).withColumn("__bad", F.col("raw").isNotNull() & body.isNull())
    number = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
    evidence = F.transform(
        F.coalesce(F.col("__p.evidence"), F.array().cast("array<struct<section_id:string,start:string,end:string,quote:string>>")),
        lambda e: F.struct(F.col("document_id"), F.coalesce(e["section_id"], F.lit("0")).alias("section_id"), number(e["start"]).alias("start"), number(e["end"]).alias("end"), F.nullif(e["quote"], F.lit("")).alias("quote")),
    )
    odd = F.exists(evidence, lambda e: (e["start"] < 0) | (e["end"] <= e["start"]))
    error = F.coalesce(
        "error", F.when(F.col("raw").isNull(), "backend returned no response"), F.when(F.col("__bad"), "JSONDecodeError: no JSON object in the answer"),
        F.when(odd, "ValidationError: evidence must end after its start"),
    )
    own = lambda name: F.coalesce(T.strip(F.col(f"__p.{name}")), F.lit(""))
    ok = error.isNull()
    keep = lambda c, n: F.when(ok, c).alias(n)
    return got.select(
        F.col("request_id").alias("id"), "slot_id", "ordinal", "attempt", "document_id", "source", F.col("title").alias("source_title"), "task", "difficulty",
        F.when(ok, "generated").otherwise("error").alias("status"), error.alias("error"), keep(own("instruction"), "instruction"), keep(own("input"), "input"), keep(own("output"), "output"),
        keep(evidence.cast(EVIDENCE), "evidence"), keep(F.coalesce(F.nullif(F.col("__p.risk"), F.lit("")), F.lit("medium")), "risk"), "generator", "model",
        "input_tokens", "output_tokens", "latency_seconds", "queue_depth", (F.col("raw") if keep_raw else F.lit(None).cast("string")).alias("raw"),
    )
