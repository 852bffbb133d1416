"""Snapshots, checkpoint shards and small JSON files beside a run."""

from __future__ import annotations

import json
import os
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durable import written

#: Rows in a file.
SNAPSHOT_ROWS, SHARD_ROWS = 10_000, 10_000


def snapshot(docs: DataFrame, path: str, rows: int = SNAPSHOT_ROWS) -> DataFrame:
    """Documents as Parquet of at most ``rows`` a file; a document is found by a join on its id."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def load_snapshot(spark, path: str) -> DataFrame:
    """A snapshot in Parquet or, from older runs, in JSON lines; of a repeated id the last row."""
    kind = "json" if path.endswith((".jsonl", ".json")) else "parquet"
    rows = getattr(spark.read, kind)(path)
    placed = rows.select("id", F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("__row"), F.monotonically_increasing_id().alias("__at"))
    return placed.groupBy("id").agg(F.max_by("__row", "__at").alias("__row")).select("__row.*")


def checkpoint(accepted: DataFrame, path: str, formats: list[str], round_: int, split: str = "train", rows: int = SHARD_ROWS) -> DataFrame:
    """Write what of accepted candidates the shards under ``path`` lack, in each format, and return the items written.

    Spark commits a folder as a whole, and the list of items comes last: after a crash the same call writes what is
    missing, and on a complete run it writes nothing.
    """
    from ..operators.exporting import LAYOUTS
    from ..operators.ledger import Ledger, unsaved

    spark = accepted.sparkSession
    book = Ledger(spark, path)
    saved = book.table("items")
    saved = spark.createDataFrame([], "candidate_id string, format string, split string") if saved is None else saved
    todo = written(unsaved(accepted, formats, saved, split))
    for f in formats:
        own = accepted.join(todo.where(F.col("format") == f).select("id"), "id", "left_semi")
        LAYOUTS[f](own).write.mode("overwrite").option("maxRecordsPerFile", rows).json(f"{path}/{f}/{split}/round={round_}")
    return book.append("items", todo.select(F.col("id").alias("candidate_id"), "format", "split"), round_)


def save_json(path: str, value: dict[str, Any]) -> None:
    """Write a small JSON file as a whole: a reader sees the old one or the new one."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".part", "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False, default=str)
    os.replace(path + ".part", path)


def unchunked(docs: DataFrame, quarantine: DataFrame, path: str, rows: int = 10_000, group_bytes: int = 8 << 20) -> None:
    """Rebuilt documents as Parquet of at most ``rows`` a file (typed even when there are none) and the quarantine as JSON."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", rows).option("parquet.block.size", group_bytes).parquet(f"{path}/data")
    quarantine.write.mode("overwrite").json(f"{path}/reports/quarantine")
