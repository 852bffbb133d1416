"""Documents rebuilt from overlapping chunk rows; groups that can't be rebuilt safely are set aside with the reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durable import written
from ..functions.hashing import one_in_ten

STRATEGIES = ("auto", "token-overlap", "text-overlap", "concat-no-overlap")
POLICIES = ("train", "majority", "original-if-consistent", "hash")
#: Name of the split that a reader of several splits adds to each row; it goes before a column of the data.
SOURCE_SPLIT = "__source_split"
#: Most differing values that a conflict reports.
SHOWN = 5


@dataclass(frozen=True)
class Options:
    text: str = "text"
    index: str = "chunk_index"
    total: str = "chunk_total"
    group_by: tuple[str, ...] = ()
    group_id: str | None = None
    strategy: str = "auto"
    max_overlap: int = 256
    expected_overlap: int | None = None
    split_policy: str = "train"
    split: str = "split"
    drop: tuple[str, ...] = ("token_count",)
    max_groups: int | None = None
    #: column whose order says which groups come first, for max_groups
    arrival: str | None = None
    #: (encode, decode) of a tokenizer, picklable
    tokenizer: tuple[Callable[[str], list[int]], Callable[[list[int]], str]] | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        bad = {
            "give exactly one of group_by and group_id": bool(self.group_by) == bool(self.group_id),
            "max_overlap is zero or positive": self.max_overlap < 0,
            "expected_overlap is zero or positive": (self.expected_overlap or 0) < 0,
            "concat-no-overlap requires an expected overlap of 0": self.strategy == "concat-no-overlap" and self.expected_overlap != 0,
            "token-overlap requires a tokenizer": self.strategy == "token-overlap" and self.tokenizer is None,
            f"strategy is one of {STRATEGIES}": self.strategy not in STRATEGIES,
            f"split policy is one of {POLICIES}": self.split_policy not in POLICIES,
            "max_groups needs the column of arrival": self.max_groups is not None and self.arrival is None,
        }
        for message, wrong in bad.items():
            if wrong:
                raise ValueError(message)

    @property
    def way(self) -> str:
        return self.strategy if self.strategy != "auto" else "token-overlap" if self.tokenizer else "text-overlap"

    @property
    def required(self) -> list[str]:
        return sorted({self.text, self.index, self.total, *self.group_by, *([self.group_id] if self.group_id else [])})


def group_key(o: Options) -> Column:
    """The group's id as text; several columns joined by "|"; null is "None"."""
    names = [o.group_id] if o.group_id else list(o.group_by)
    return F.concat_ws("|", *(F.coalesce(F.col(n).cast("string"), F.lit("None")) for n in names))


def overlap(left: Column, right: Column, most: int, expected: int | None) -> Column:
    """Length of the longest end of left that starts right, from 1 to ``most``; or the expected one if it holds. Null if none does."""
    limit = F.least(F.lit(most), F.length(left), F.length(right))
    if expected is not None:
        e = F.lit(expected)
        return F.when((e <= limit) & (F.lit(expected == 0) | (F.right(left, e) == F.left(right, e))), e)
    sizes = F.when(limit > 0, F.sequence(limit, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.get(F.filter(sizes, lambda n: F.right(left, n) == F.left(right, n)), F.lit(0))


def merge_text(texts: Column, most: int, expected: int | None) -> Column:
    """struct(text, overlaps, ok) of texts merged by :func:`overlap`.

    Only the last ``most`` characters of what is merged are compared, for no overlap is longer, and the parts are joined
    once at the end.
    """
    tail = lambda s: F.right(s, F.lit(max(most, expected or 0, 1)))
    first = F.get(texts, F.lit(0))
    start = F.struct(F.array(first).alias("parts"), tail(first).alias("tail"), F.array().cast("array<int>").alias("ov"), F.lit(True).alias("ok"))

    def step(a: Column, x: Column) -> Column:
        n = F.when(a["ok"], overlap(a["tail"], x, most, expected))
        rest = F.substring(x, F.coalesce(n, F.lit(0)) + 1, F.length(x))
        return F.struct(
            F.when(n.isNotNull(), F.array_append(a["parts"], rest)).otherwise(a["parts"]).alias("parts"),
            F.when(n.isNotNull(), tail(F.concat(a["tail"], rest))).otherwise(a["tail"]).alias("tail"),
            F.when(n.isNotNull(), F.array_append(a["ov"], n)).otherwise(a["ov"]).alias("ov"),
            n.isNotNull().alias("ok"),
        )

    return F.aggregate(F.slice(texts, 2, F.greatest(F.size(texts), F.lit(1))), start, step, lambda a: F.struct(F.array_join(a["parts"], "").alias("text"), a["ov"].alias("overlaps"), a["ok"].alias("ok")))


def merge_tokens(texts: Column, o: Options) -> Column:
    """As :func:`merge_text` over token ids, with the ids decoded at the end."""
    encode, decode = o.tokenizer
    most, expected = o.max_overlap, o.expected_overlap

    @F.pandas_udf("text string, overlaps array<int>, ok boolean")
    def run(groups: pd.Series) -> pd.DataFrame:
        rows = []
        for own in groups:
            merged, found, ok = list(encode(own[0])), [], True
            for t in own[1:]:
                ids = list(encode(t))
                limit = min(most, len(merged), len(ids))
                tries = range(limit, 0, -1) if expected is None else [expected] if expected <= limit else []
                n = next((n for n in tries if n == 0 or merged[-n:] == ids[:n]), None)
                if n is None:
                    ok = False
                    break
                found.append(n)
                merged += ids[n:]
            rows.append((decode(merged) if ok else None, found, ok))
        return pd.DataFrame(rows, columns=["text", "overlaps", "ok"])

    return run(texts)


def count_tokens(text: Column, o: Options) -> Column:
    encode = o.tokenizer[0]

    @F.pandas_udf("int")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else len(encode(t)))

    return run(text)


def missing_columns(rows: DataFrame, o: Options) -> list[str]:
    return [c for c in o.required if c not in rows.columns]


def grouped(rows: DataFrame, o: Options) -> DataFrame:
    """group_id, n and chunks (structs in the order of index): one shuffle, by group."""
    keyed = rows.withColumn("group_id", group_key(o))
    if o.max_groups is not None:
        first = keyed.groupBy("group_id").agg(F.min(o.arrival).alias("__at")).orderBy("__at", "group_id").limit(o.max_groups)
        keyed = keyed.join(first.select("group_id"), "group_id", "left_semi")
    whole = lambda c: F.col(c).cast("string").try_cast("long")
    carried = [c for c in rows.columns if c not in {o.text, o.index, o.total, SOURCE_SPLIT, *o.drop}]
    split = [F.col(c).cast("string") for c in (SOURCE_SPLIT, o.split) if c in rows.columns]
    chunk = F.struct(
        whole(o.index).alias("i"), whole(o.total).alias("n"), F.coalesce(F.col(o.text).cast("string"), F.lit("")).alias("text"),
        (F.coalesce(*split) if split else F.lit(None).cast("string")).alias("split"), F.struct(*(F.to_json(F.struct(F.col(c).alias("v"))).alias(c) for c in carried) or [F.lit(1).alias("_")]).alias("kept"),
        F.struct(*(F.col(c) for c in carried) or [F.lit(1).alias("_")]).alias("raw"),
    )
    # maps can't be compared, so rows sort by what comes before the raw values
    ordered = F.array_sort(F.collect_list(chunk), lambda a, b: F.when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1).otherwise(0))
    return keyed.groupBy("group_id").agg(ordered.alias("chunks")).withColumn("n", F.size("chunks"))


def _problem(o: Options) -> Column:
    """Why a group can't be rebuilt, before its texts are looked at; null if it may be."""
    idx = F.transform("chunks", lambda c: c["i"])
    totals = F.array_distinct(F.transform("chunks", lambda c: c["n"]))
    total = F.get(totals, F.lit(0))
    expected = F.when(total > 0, F.sequence(F.lit(0).cast("long"), total - 1)).otherwise(F.array().cast("array<long>"))
    show = lambda a: F.concat(F.lit("["), F.array_join(a, ", "), F.lit("]"))
    return (
        F.when(F.exists(idx, lambda x: x.isNull()), f"{o.index} must be an integer")
        .when(F.exists(totals, lambda x: x.isNull()), f"{o.total} must be an integer")
        .when(F.size(totals) != 1, "chunk_total is inconsistent within group")
        .when(idx != expected, F.concat(F.lit("chunk indexes are incomplete or duplicated: expected "), show(expected), F.lit(", got "), show(idx)))
    )


def _split(o: Options) -> Column:
    values = F.array_compact(F.transform("chunks", lambda c: c["split"]))
    if o.split_policy == "train":
        return F.lit("train")
    distinct = F.array_distinct(values)
    if o.split_policy == "original-if-consistent":
        chosen = F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))).otherwise("train")
    elif o.split_policy == "majority":
        votes = F.transform(distinct, lambda v: F.struct((-F.size(F.filter(values, lambda x: x == v))).alias("n"), v.alias("v")))
        chosen = F.array_min(votes)["v"]
    else:
        chosen = F.when(one_in_ten(F.col("group_id")), "validation").otherwise("train")
    return F.when(F.size(values) > 0, chosen).otherwise("train")


def reconstructed(rows: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantine) of chunk rows.

    documents: the columns that all rows of a group agree on (null where they don't), the text, reconstructed_group_id,
    split, source_chunk_count, reconstructed_token_count with a tokenizer, reconstruction_status, conflicts (map of column
    to up to five differing values as JSON) and overlaps. quarantine: group_id, reason, error and rows. Both read one
    written table of groups. Rows without a required column are all set aside, a row of quarantine each.
    """
    quarantine = "group_id string, reason string, error string, rows long"
    if missing := missing_columns(rows, o):
        gone = rows.select(F.lit("<unknown>").alias("group_id"), F.lit("missing_required_columns").alias("reason"), F.lit("missing required columns: " + ", ".join(missing)).alias("error"), F.lit(1).cast("long").alias("rows"))
        return rows.sparkSession.createDataFrame([], f"reconstructed_group_id string, `{o.text}` string, split string, source_chunk_count int, reconstruction_status string"), gone
    texts = F.transform("chunks", lambda c: c["text"])
    made = grouped(rows, o).withColumn("problem", _problem(o)).withColumn("texts", F.when(F.col("problem").isNull() & (F.size("chunks") > 0), texts).otherwise(F.array(F.lit(""))))
    if o.way == "concat-no-overlap":
        m = F.struct(F.array_join("texts", "").alias("text"), F.array().cast("array<int>").alias("overlaps"), F.lit(True).alias("ok"))
    else:
        m = merge_tokens(F.col("texts"), o) if o.way == "token-overlap" else merge_text(F.col("texts"), o.max_overlap, o.expected_overlap)
    made = written(made.withColumn("m", m).withColumn("split_", _split(o)))
    kind = "token" if o.way == "token-overlap" else "text"
    error = F.coalesce("problem", F.when(~F.col("m.ok"), f"{kind} overlap could not be inferred"))
    bad = made.where(error.isNotNull()).select("group_id", F.lit("unsafe_reconstruction").alias("reason"), error.alias("error"), F.col("n").cast("long").alias("rows"))
    good = made.where(error.isNull())
    names = [f.name for f in made.schema["chunks"].dataType.elementType["raw"].dataType if f.name != "_"]
    same = lambda c: F.size(F.array_distinct(F.transform("chunks", lambda x: x["kept"][c]))) <= 1
    value = lambda c: F.get(F.col("chunks"), F.lit(0))["raw"][c]
    seen = lambda c: F.slice(F.array_distinct(F.transform("chunks", lambda x: x["kept"][c])), 1, SHOWN)
    pairs = F.array_compact(F.array(*(F.when(~same(c), F.struct(F.lit(c).alias("k"), seen(c).alias("v"))) for c in names))) if names else None
    conflicts = F.map_from_entries(pairs) if names else F.create_map().cast("map<string,array<string>>")
    taken = {o.text, "split", "reconstructed_group_id", "source_chunk_count", "reconstructed_token_count", "reconstruction_status"}
    docs = good.select(
        *(F.when(same(c), value(c)).alias(c) for c in names if c not in taken),
        F.col("group_id").alias("reconstructed_group_id"), F.col("m.text").alias(o.text), F.col("split_").alias("split"), F.col("n").alias("source_chunk_count"),
        *([count_tokens(F.col("m.text"), o).alias("reconstructed_token_count")] if o.tokenizer else []),
        F.lit("reconstructed").alias("reconstruction_status"), conflicts.alias("conflicts"), F.col("m.overlaps").alias("overlaps"),
    )
    assert bad.schema.simpleString() == rows.sparkSession.createDataFrame([], quarantine).schema.simpleString()
    return docs, bad


def overlap_histogram(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode("overlaps").alias("overlap")).groupBy("overlap").agg(F.count("*").alias("n"))


def conflict_counts(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(F.map_keys("conflicts")).alias("column")).groupBy("column").agg(F.count("*").alias("n"))


def report(rows: DataFrame, docs: DataFrame, quarantine: DataFrame) -> dict:
    """Counters of a reconstruction; conflicts and overlaps by value, of which there are few."""
    return {
        "input_rows": rows.count(),
        "reconstructed_groups": (n := docs.count()),
        "quarantined_groups": (q := quarantine.count()),
        "groups_seen": n + q,
        "conflicts_by_column": {r.column: r.n for r in conflict_counts(docs).orderBy("column").collect()},
        "overlap_histogram": {str(r.overlap): r.n for r in overlap_histogram(docs).orderBy("overlap").collect()},
    }
