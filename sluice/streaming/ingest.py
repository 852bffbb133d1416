"""Structured Streaming forms: incremental ingest of corpus files, incremental gates over attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators.chunking import OVERLAP, SIZE, chunked
from ..operators.eligibility import eligible


def arriving(spark: SparkSession, path: str, schema: str, format: str = "json", files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the rows of files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(format).load(path)


def chunk_stream(rows: DataFrame, profile: str | None = None, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Eligible documents of a stream of (id, text, title), chunked: no state, so it runs in any output mode."""
    docs = rows.select(F.col("id").cast("string"), T.strip(F.coalesce("text", F.lit(""))).alias("text"), "title", F.array().cast("array<struct<id:string,text:string,title:string>>").alias("sections"))
    return chunked(docs.where(eligible(F.col("text"), F.col("title"), None, profile)), size, overlap)


def ingest(rows: DataFrame, path: str, checkpoint: str, profile: str | None = None, size: int = SIZE, overlap: int = OVERLAP) -> StreamingQuery:
    """Chunk what has arrived since the last call and append it to ``path``; each file goes in once, whatever fails between."""
    out = chunk_stream(rows, profile, size, overlap).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.trigger(availableNow=True).start()


def save_accepted(rows: DataFrame, path: str, checkpoint: str, formats: list[str], shard_rows: int) -> StreamingQuery:
    """Write accepted candidates as checkpoint shards, a round a batch; a batch that is done again adds nothing."""
    from ..sources.sinks import checkpoint as shards

    def batch(df: DataFrame, number: int) -> None:
        shards(df, path, formats, number, rows=shard_rows)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Attempts by status in tumbling windows of ``ts``, for progress over a stream; what is later than ``late`` is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")
