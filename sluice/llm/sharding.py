"""Minimax contiguous partition of ordered atomic groups: least feasible shard capacity by binary search, then greedy cuts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

SHARDS = 64
#: Documents with ids next to each other that a query's atomic group holds at most, by source.
SPAN = 256
#: Most running totals (8 bytes each) that the driver holds; of more groups it holds so many and reads what lies between.
HELD = 20_000_000
#: Capacities that one reading of the totals tries where they aren't held.
AT_ONCE = 64


def shards_needed(ends: np.ndarray, capacity: int, most: int) -> int:
    """Shards of at most ``capacity`` that greedy filling takes for groups with these running totals; ``most`` + 1 if more."""
    at = used = 0
    base = 0
    while at < len(ends) and used <= most:
        nxt = int(np.searchsorted(ends, base + capacity, side="right"))
        if nxt == at:
            return most + 1
        at, base, used = nxt, int(ends[nxt - 1]), used + 1
    return used if at >= len(ends) else most + 1


def least_capacity(feasible: Callable[[list[int]], list[bool]], low: int, high: int, at_once: int) -> int:
    """Least capacity in [low, high] that is feasible (high is), with up to ``at_once`` tries a round."""
    while low < high:
        step = max(1, (high - low) // (at_once + 1))
        tries = sorted({min(high - 1, low + step * (i + 1)) for i in range(at_once)}) if at_once > 1 else [(low + high) // 2]
        good = feasible(tries)
        for c, ok in zip(tries, good, strict=True):
            if ok:
                high = c
                break
            low = c + 1
    return low


def _running(sized: DataFrame, order: list[str]) -> DataFrame:
    """sized in order with ``part``, ``nth`` in it and ``upto`` (total of sizes up to the row), by range partitions and their offsets."""
    ranged = C.cut(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("part").agg(F.sum("size").alias("s")).orderBy("part").collect()  # a row a partition
    before, total = {}, 0
    for r in parts:
        before[r.part] = total
        total += r.s
    spark = sized.sparkSession
    offs = spark.createDataFrame([(int(k), int(v)) for k, v in before.items()], "part int, off long")
    own = Window.partitionBy("part").orderBy(*order)
    sums = ranged.join(F.broadcast(offs), "part").withColumn("upto", F.col("off") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return sums.withColumn("nth", F.row_number().over(own))


class Totals:
    """Running totals too many for the driver, which holds every so many-th of them and reads the stretches between them that cuts fall in."""

    def __init__(self, run: DataFrame, n: int, total: int, held: int):
        self.run, self.total, self.stretches = run.select("upto"), total, {}
        stride = -(-n // max(held, 16))
        some = run.where(F.pmod("nth", F.lit(stride)) == 0).select("upto").distinct().toPandas()["upto"].to_numpy(np.int64)
        self.marks = np.unique(np.append(some, total))

    def below(self, most: list[int]) -> list[int]:
        """The largest total up to each of these, 0 if there is none."""
        at = np.minimum(np.searchsorted(self.marks, most), len(self.marks) - 1).tolist()
        ends = {k: (int(self.marks[k - 1]) if k else 0, int(self.marks[k])) for k in at}
        if new := [k for k in ends if k not in self.stretches]:
            inside = reduce(lambda a, b: a | b, [F.col("upto").between(ends[k][0] + 1, ends[k][1]) for k in new])
            got = self.run.where(inside).distinct().toPandas()["upto"].to_numpy(np.int64)  # a stretch each
            for k in new:
                self.stretches[k] = np.unique(np.concatenate([got[(got > ends[k][0]) & (got <= ends[k][1])], [ends[k][0]]]))
        return [int(self.stretches[k][np.searchsorted(self.stretches[k], x, side="right") - 1]) for k, x in zip(at, most, strict=True)]

    def cuts(self, capacities: list[int], shards: int) -> list[list[int]]:
        """Totals at which greedy filling cuts, for each capacity (none below a single size); it ends beyond ``shards`` of them."""
        out = [[] for _ in capacities]
        while open_ := [i for i, x in enumerate(out) if len(x) <= shards and (x[-1] if x else 0) < self.total]:
            for i, cut in zip(open_, self.below([(out[i][-1] if out[i] else 0) + capacities[i] for i in open_]), strict=True):
                out[i].append(cut)
        return [x or [0] for x in out]


def partition(groups: DataFrame, order: list[str], shards: int = SHARDS, held: int = HELD) -> tuple[DataFrame, int]:
    """(groups(order columns, size) with ``shard`` from 0, the largest shard's least possible size).

    Groups are taken in the order of ``order``, which must tell them apart, and never split. The capacity is the least
    for which greedy filling needs at most ``shards`` shards; with it the groups are cut greedily, so every shard but
    the last is as full as the next group allows. Null and negative sizes count as 0. No groups: no rows, capacity 0.
    """
    sized = groups.select(*order, F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    run = C.cut(_running(sized, order))
    stats = run.agg(F.count("*").alias("n"), F.max("size").alias("most"), F.sum("size").alias("total")).first()
    if not stats.n:
        return run.select(*order, "size", F.lit(0).alias("shard")), 0
    shards = max(1, shards)
    low, high = max(int(stats.most), -(-int(stats.total) // shards)), int(stats.total)
    ordered = run.select("upto").orderBy("upto")
    if stats.n <= held:
        ends = ordered.toPandas()["upto"].to_numpy(np.int64)
        capacity = least_capacity(lambda cs: [shards_needed(ends, c, shards) <= shards for c in cs], low, high, 1)
        cuts, at, base = [], 0, 0
        while at < len(ends):
            nxt = int(np.searchsorted(ends, base + capacity, side="right")) if capacity else len(ends)
            base = int(ends[nxt - 1])
            cuts.append(base)
            at = nxt
    else:
        totals = Totals(run, stats.n, int(stats.total), held)
        capacity = least_capacity(lambda cs: [len(x) <= shards for x in totals.cuts(cs, shards)], low, high, AT_ONCE)
        cuts = totals.cuts([capacity], shards)[0]
    # groups of size 0 at a cut share its total and stay with the groups before it
    bounds = F.array(*(F.lit(int(c)).cast("long") for c in cuts))
    shard = F.size(F.filter(bounds, lambda c: c < F.col("upto")))
    return run.select(*order, "size", shard.cast("int").alias("shard")), int(capacity)


def document_shards(docs: DataFrame, shards: int = SHARDS, span: int = SPAN) -> DataFrame:
    """doc_id, source, shard, shard_bytes and capacity of every row of docs(doc_id, source, text).

    The atomic groups, in order, are the documents of a source with doc_id in the same ``span`` of ids; a size is the
    bytes of the texts. Null texts have none; a null source is "" and a null doc_id, or a string that isn't a whole
    number, is of the group before all ids; rows that repeat are each counted. No documents: no rows. Other columns are
    ignored.
    """
    docs = C.columns(docs, "doc_id", "source", "text")
    number = F.col("doc_id").try_cast("long") if C.kind(docs, "doc_id") == "string" else F.col("doc_id")
    keyed = docs.select("doc_id", "source", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("g_source"), F.coalesce(F.floor(number / span), F.lit(-(1 << 62))).alias("g_block"), F.octet_length(F.col("text").cast("string")).alias("bytes"))
    sizes = keyed.groupBy("g_source", "g_block").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("size"))
    cut, capacity = partition(sizes, ["g_source", "g_block"], shards)
    cut = C.cut(cut)
    full = cut.groupBy("shard").agg(F.sum("size").alias("shard_bytes"))
    where = C.cut(cut.join(F.broadcast(full), "shard").drop("size"))  # a row a shard is broadcast
    groups = C.small_ids(where)
    return keyed.join(groups, ["g_source", "g_block"]).select("doc_id", "source", "shard", "shard_bytes", F.lit(capacity).cast("long").alias("capacity"))



#: ``document_shards`` in DuckDB's SQL: binary search with a greedy count a step, then a cut a step.
SQL = f"""
WITH RECURSIVE k AS (
  SELECT coalesce(source, '') AS s, coalesce(floor(doc_id / {SPAN}.0)::BIGINT, {-(1 << 62)}) AS b, sum(coalesce(octet_length(encode(text)), 0))::BIGINT AS size FROM documents GROUP BY ALL),
e AS (SELECT *, (sum(size) OVER (ORDER BY s, b))::BIGINT AS upto FROM k),
l AS (SELECT list(size ORDER BY s, b) AS sizes, list(upto ORDER BY s, b) AS ends, max(size) AS most, sum(size)::BIGINT AS total FROM e),
search AS (
  SELECT greatest(most, ((total + {SHARDS - 1}) // {SHARDS})::BIGINT) AS lo, total AS hi FROM l
  UNION ALL
  SELECT CASE WHEN ok THEN lo ELSE mid + 1 END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT lo, hi, mid, list_reduce(list_transform(sizes, lambda x: {{'n': 1::BIGINT, 'c': x}}), lambda a, x: CASE WHEN a.c + x.c > mid THEN {{'n': a.n + 1, 'c': x.c}} ELSE {{'n': a.n, 'c': a.c + x.c}} END).n <= {SHARDS} AS ok
    FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM search WHERE lo < hi), l)),
cap AS (SELECT max(lo) AS capacity FROM search WHERE lo = hi),
cuts AS (
  SELECT list_max(list_filter(ends, lambda x: x <= capacity)) AS base FROM l, cap
  UNION ALL
  SELECT list_max(list_filter(ends, lambda x: x <= base + capacity)) FROM cuts, l, cap WHERE base < total),
placed AS (SELECT s, b, size, (SELECT count(*) FROM cuts WHERE base < upto)::INT AS shard FROM e),
full_ AS (SELECT *, (sum(size) OVER (PARTITION BY shard))::BIGINT AS shard_bytes FROM placed)
SELECT d.doc_id, d.source, f.shard, f.shard_bytes, (SELECT capacity FROM cap)::BIGINT AS capacity
FROM documents d JOIN full_ f ON f.s = coalesce(d.source, '') AND f.b = coalesce(floor(d.doc_id / {SPAN}.0)::BIGINT, {-(1 << 62)})
"""
