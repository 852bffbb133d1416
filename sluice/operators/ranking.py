"""Ranks over a whole table or a hot group, without one task that holds it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.durable import written

#: Most rows that one task ranks by itself; narrow rows, of which a task sorts this many in memory.
ONE_TASK = 1_000_000


def ranked(df: DataFrame, by: list[str], order: list[str | Column], name: str = "rank", one_task: int = ONE_TASK) -> DataFrame:
    """df with row_number from 1 in ``order`` within ``by`` (non-null columns; [] for the whole table).

    df is written once. Up to ``one_task`` rows are ranked by a plain window. Beyond that, rows are range-partitioned by
    (by, order) and written once more; a row's rank is its place in its range plus the rows of its group in the ranges
    before, of which there is one count a range and group. A group of any size spreads over ranges.
    """
    df = written(df)
    if df.count() <= one_task:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    placed = written(df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()))
    counts = placed.groupBy("__range", *by).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    local = F.row_number().over(Window.partitionBy("__range", *by).orderBy(*order))
    return placed.join(offsets, ["__range", *by]).withColumn(name, (local + F.col("__before")).cast("long")).drop("__range", "__before")
