"""Training layouts of accepted candidates, leakage-free splits, and the guard before any of it leaves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.hashing import digest
from .ranking import ranked

SPLITS = ("train", "validation", "test")
_ABOUT = ("source", "document_id", "source_title", "task", "difficulty", "evidence", "generator", "model")


def prompt() -> Column:
    """The instruction, with the input as context below it where there is one."""
    given = F.coalesce("input", F.lit(""))
    return F.when(given == "", F.col("instruction")).otherwise(F.concat("instruction", F.lit("\n\nContext:\n"), given))


def messages() -> Column:
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(said("user", prompt()), said("assistant", F.col("output")))


#: Layouts by name: DataFrame of candidates -> DataFrame.
LAYOUTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "messages": lambda c: c.select("id", messages().alias("messages"), *_ABOUT),
    "prompt_completion": lambda c: c.select("id", prompt().alias("prompt"), F.col("output").alias("completion"), *_ABOUT),
    "alpaca": lambda c: c.select("id", "instruction", "input", "output", *_ABOUT),
    "canonical": lambda c: c.withColumn("messages", messages()),
}


def commonest(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """key and ``name``: its most frequent value, the least of equals. Two partial aggregates, no window."""
    n = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("m")).select(key, F.col("m.v").alias(name))


def split_sizes(n: Column, ratios: dict[str, float]) -> Column:
    """struct(train, validation, test): whole shares of n by largest remainders, ties to the later name."""
    raw = {s: n * F.lit(float(ratios[s])) for s in SPLITS}
    rest = F.reverse(F.array_sort(F.array(*(F.struct((raw[s] - F.floor(raw[s])).alias("f"), F.lit(s).alias("s")) for s in SPLITS))))
    left = n - sum((F.floor(raw[s]) for s in SPLITS), F.lit(0))
    at = lambda s: F.array_position(F.transform(rest, lambda x: x["s"]), F.lit(s))
    return F.struct(*((F.floor(raw[s]) + F.when(at(s) <= left, 1).otherwise(0)).alias(s) for s in SPLITS))


def check_ratios(ratios: dict[str, float]) -> dict[str, float]:
    ratios = {s: float(ratios.get(s, 0.0)) for s in SPLITS}
    if min(ratios.values()) < 0 or abs(sum(ratios.values()) - 1) > 1e-6:
        raise ValueError("split ratios are at least 0 and make 1")
    return ratios


def assign_splits(candidates: DataFrame, ratios: dict[str, float], seed: int) -> DataFrame:
    """document_id and split, so that no document is in two.

    Documents are grouped by their commonest task and difficulty; in each group, in the order of a seeded digest, come
    train, validation and test, in sizes by :func:`split_sizes`. A group that holds most documents is ranked over ranges.
    """
    ratios = check_ratios(ratios)
    both = commonest(candidates, "document_id", "task", "task").join(commonest(candidates, "document_id", "difficulty", "difficulty"), "document_id")
    keyed = both.withColumn("key", digest(seed, F.col("document_id")))
    sizes = both.groupBy("task", "difficulty").agg(F.count("*").alias("n")).withColumn("k", split_sizes(F.col("n"), ratios)).drop("n")
    placed = ranked(keyed, ["task", "difficulty"], ["key", "document_id"]).join(sizes, ["task", "difficulty"])
    split = F.when(F.col("rank") <= F.col("k.train"), "train").when(F.col("rank") <= F.col("k.train") + F.col("k.validation"), "validation").otherwise("test")
    return placed.select("document_id", split.alias("split"))


def told_on(candidates: DataFrame) -> DataFrame:
    """id of the candidates whose texts refer to a source that the reader can't see."""
    folds = candidates.select("id", *(T.folded(F.coalesce(c, F.lit(""))).alias(c) for c in ("instruction", "input", "output")))
    return folds.where(T.has_reference(F.col("instruction"), F.col("input"), F.col("output"))).select("id")


def guard(candidates: DataFrame) -> None:
    """ValueError that names the first ten such candidates and how many more there are."""
    bad = told_on(candidates).orderBy("id")
    if first := [r.id for r in bad.limit(10).collect()]:
        more = bad.count() - len(first)
        raise ValueError("refusing to export source-dependent SFT content: " + ", ".join(first) + (f" and {more} more" if more else ""))


def export(candidates: DataFrame, path: str, *, ratios: dict[str, float], seed: int, formats: list[str], containers: list[str], rows_per_file: int = 1_000_000) -> DataFrame:
    """Write path/format/container/split=… for every layout and container, after :func:`guard`; a split of ratio 0 isn't written.

    Overwriting a layout removes splits that it no longer has. Returns the splits.
    """
    guard(candidates)
    from ..functions.durable import written

    splits = written(assign_splits(candidates, ratios, seed))
    own = candidates.join(splits, "document_id")
    for f in formats:
        view = LAYOUTS[f](own.drop("split")).join(splits, "document_id")
        for c in containers:
            out = view.repartition("split") if c == "single" else view
            writer = out.write.mode("overwrite").partitionBy("split").option("maxRecordsPerFile", rows_per_file)
            (writer.option("ignoreNullFields", "false").json if c == "jsonl" else writer.parquet)(f"{path}/{f}/{c}")
    return splits


def card(name: str, examples: int, model: str, config_hash: str, formats: list[str], container: str, splits: list[str]) -> str:
    """A dataset card: front matter that lists the files of each layout and split, and where the rows come from."""
    front = [line for f in formats for line in (f"- config_name: {f}", "  data_files:", *(x for s in splits for x in (f"  - split: {s}", f"    path: {f}/{container}/split={s}/*")))]
    facts = {"Examples": examples, "Generator": f"`{model}`", "Evaluator": "deterministic gates", "Configuration": f"`{config_hash}`"}
    return "\n".join(["---", "configs:", *front, "---", "", f"# {name}", "", *(f"- {k}: {v}" for k, v in facts.items()), "", "Check provenance and licences before publishing.", ""])
