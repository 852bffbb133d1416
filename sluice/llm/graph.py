"""Connected components by repeated contraction onto least neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in edges(a, b): root is the least id of its component.

    Each round maps every id to its least neighbour, follows that map eight steps, and contracts the edges by it, so the
    length of a chain shrinks eightfold or more a round. Null ends are dropped. No edges give no rows.
    """
    key = C.kind(edges, "a")
    e = C.cut(edges.select("a", "b").where("a <> b").distinct())
    total = C.cut(edges.select(F.col("a").alias("id")).union(edges.select("b")).where("id is not null").distinct().select("id", F.col("id").alias("root")))
    while not e.isEmpty():
        both = e.union(e.select("b", "a")).toDF("id", "n")
        up = both.groupBy("id").agg(F.least("id", F.min("n")).alias("p"))
        for _ in range(3):
            up = C.cut(up)
            nxt = up.select(F.col("id").alias("p"), F.col("p").alias("q"))
            up = up.join(nxt, "p").select("id", F.col("q").alias("p"))
        up = C.cut(up)
        total = C.cut(total.join(up.toDF("root", "p"), "root", "left").select("id", F.coalesce("p", "root").cast(key).alias("root")))
        e = e.join(up.toDF("a", "pa"), "a").join(up.toDF("b", "pb"), "b").where("pa <> pb")
        e = C.cut(e.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
    return total
