"""Corpus readers and the mapping of their rows onto documents."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..functions import text as T
from ..functions.durable import written

FIELDS = {"id": "id", "text": "text", "title": "title", "sections": "sections", "license": "license"}
FORMATS = ("jsonl", "ndjson", "json", "parquet")
_SECTION = "array<struct<id:string,text:string,title:string>>"


class SourceError(ValueError):
    """A source that can't be read as asked."""


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of JSON lines. Blank lines are skipped; a line that isn't a JSON object is an error with its file and number."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(~T.blank(F.col("value")))
    # the scan for a schema parses every line, so that only a look at what lines begin with is left to do
    found = None if schema else spark.read.json(path)
    wrong = ~T.strip(F.col("value")).startswith("{")
    if found is None or "_corrupt_record" in found.columns:
        wrong = wrong | F.try_parse_json("value").isNull()
    for bad in lines.where(wrong).limit(1).collect():
        # only now is the file read in order, to number the line
        at = next(i for i, r in enumerate(spark.read.text(bad.file).toLocalIterator(), 1) if r.value == bad.value)
        raise SourceError(f"{bad.file}:{at}: not a JSON object")
    return spark.read.option("mode", "FAILFAST").schema(schema or found.schema).json(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of a JSON file that is a list, or an object with a list ``records``."""
    reader = spark.read.option("multiLine", "true").option("mode", "FAILFAST")
    out = (reader.schema(schema) if schema else reader).json(path)
    if "records" in out.columns and isinstance(out.schema["records"].dataType, t.ArrayType):
        return out.select(F.explode("records").alias("r")).select("r.*")
    return out


def read(spark: SparkSession, path: str, format: str | None = None, schema: str | None = None) -> DataFrame:
    """The rows of a local source; the format is by name or by the path's suffix."""
    kind = (format or os.path.splitext(path.rstrip("/"))[1].lstrip(".")).lower()
    if kind in ("jsonl", "ndjson"):
        return read_jsonl(spark, path, schema)
    if kind == "json":
        return read_json(spark, path, schema)
    if kind == "parquet":
        return spark.read.parquet(path)
    raise SourceError(f"unsupported format {kind!r}; one of {', '.join(FORMATS)}")


def read_splits(spark: SparkSession, paths: dict[str, str], format: str | None = None) -> DataFrame:
    """Several splits as one table, each row with its split's name; columns that some lack are null there."""
    from ..operators.unchunk import SOURCE_SPLIT

    out = None
    for name, path in paths.items():
        one = read(spark, path, format).withColumn(SOURCE_SPLIT, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def remote(*_args, **_params) -> DataFrame:
    """Hub datasets need the network: download them, and read the files."""
    raise SourceError("remote datasets can't be read from here; download the files and use the local source")


def with_index(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """df with raw_index from 0 in the order of ``order`` (columns that tell rows apart), or else as the rows come.

    Without an order the rows are written once; their place is the rows of earlier partitions and the place in their own.
    """
    if order:
        from ..operators.ranking import ranked

        return ranked(df, [], order, "raw_index").withColumn("raw_index", F.col("raw_index") - 1)
    placed = written(df.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()))
    from pyspark.sql.window import Window

    parts = placed.groupBy("__p").agg(F.count("*").alias("n"), F.min("__m").alias("__first"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # over a row a partition
    parts = parts.select("__p", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(parts), "__p").withColumn("raw_index", F.col("__m") - F.col("__first") + F.col("__before")).drop("__p", "__m", "__first", "__before")


def at_path(df: DataFrame, path: str) -> Column | None:
    """Column of a dotted path, None where the schema lacks it."""
    from ..operators.eligibility import resolver

    return resolver(df)(path)


def sections(df: DataFrame, path: str) -> Column:
    """Sections from null, a string, or an array of strings or structs.

    A struct's text is the first of text, content and section_text that isn't empty, its id the first of id and section_id
    that isn't empty or 0, else its place in the array, its title title or heading. Blank sections go, after the count.
    """
    own = at_path(df, path)
    none = F.array().cast(_SECTION)
    if own is None:
        return none
    kind = df.select(own.alias("s")).schema["s"].dataType
    if isinstance(kind, t.StringType):
        own, kind = F.when(own.isNotNull(), F.array(own)), t.ArrayType(t.StringType())
    if not isinstance(kind, t.ArrayType):
        return none
    item = kind.elementType

    def first(x: Column, names: tuple[str, ...], zero: bool = False) -> Column:
        if not isinstance(item, t.StructType):
            return F.lit(None).cast("string")
        have = [x[n].cast("string") for n in names if n in item.fieldNames()]
        have = [F.when(~h.isin("", "0", "0.0", "false") if not zero else h != "", h) for h in have]
        return F.coalesce(*have) if have else F.lit(None).cast("string")

    def one(x: Column, i: Column) -> Column:
        if isinstance(item, t.StructType):
            text = first(x, ("text", "content", "section_text"), zero=True)
            sid = F.coalesce(first(x, ("id", "section_id")), i.cast("string")) if not isinstance(_kind(item, "id"), t.StringType) else F.coalesce(first(x, ("id", "section_id"), zero=True), i.cast("string"))
            title = first(x, ("title", "heading"), zero=True)
        else:
            text, sid, title = x.cast("string"), i.cast("string"), F.lit(None).cast("string")
        return F.struct(sid.alias("id"), T.strip(F.coalesce(text, F.lit(""))).alias("text"), title.alias("title"))

    return F.coalesce(F.filter(F.transform(own, one), lambda s: s["text"] != ""), none)


def _kind(item: t.StructType, name: str) -> t.DataType | None:
    return item[name].dataType if name in item.fieldNames() else None


def documents(df: DataFrame, fields: dict[str, str] | None = None, source: str = "local", index: str = "raw_index") -> DataFrame:
    """id, text, title, sections, license, source and metadata (struct of the other top-level columns) of rows with an index column.

    The id is the value at its path, "None" where it is null, and the row's index where the path isn't in the schema. The
    text is stripped, "" for null. An empty title stays, an empty license is null.
    """
    f = FIELDS | (fields or {})
    text, ident, title, licence = (at_path(df, f[k]) for k in ("text", "id", "title", "license"))
    none = F.lit(None).cast("string")
    others = [c for c in df.columns if c not in set(f.values()) and c != index]
    ident = F.col(index).cast("string") if ident is None else F.coalesce(ident.cast("string"), F.lit("None"))
    return df.select(
        ident.alias("id"), T.strip(F.coalesce(text.cast("string") if text is not None else none, F.lit(""))).alias("text"),
        (title.cast("string") if title is not None else none).alias("title"), sections(df, f["sections"]).alias("sections"),
        (F.nullif(licence.cast("string"), F.lit("")) if licence is not None else none).alias("license"), F.lit(source).alias("source"),
        F.struct(*(F.col(f"`{c}`") for c in others), F.col(index).alias("raw_index")).alias("metadata"),
    )
