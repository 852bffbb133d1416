"""Text functions: stripping, folding, references to hidden sources, fingerprints, token estimates, fences of model JSON."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

#: Bytes of an Arrow batch that Python has as objects at once.
SLICE = 1 << 20

#: The 29 code points that count as white space; Spark's own trim knows U+0020 alone.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE))


def blank(c: Column) -> Column:
    """True for null and for nothing but white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


def fold(value: str | None) -> str | None:
    """Compatibility-decomposed, without combining marks, case-folded, white space as single spaces."""
    if value is None:
        return None
    if not value.isascii():
        value = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return " ".join(value.casefold().split())


def slices(values: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """values in parts of at most ``most`` bytes, or of one row."""
    if len(values) <= 1 or values.nbytes <= most:
        yield values
    else:
        half = len(values) // 2
        yield from slices(values[:half], most)
        yield from slices(values[half:], most)


def in_slices(f: Callable, spark_type: DataType | str, arrow_type: pa.DataType) -> Callable:
    """UDF of f over values that aren't null. Besides the Arrow batch, whose bytes Spark bounds, a worker holds one slice of it."""

    @F.arrow_udf(spark_type)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            for own in slices(b):
                yield pa.array([None if x is None else f(x) for x in own.to_pylist()], arrow_type)

    return run


_fold = in_slices(fold, StringType(), pa.string())


def folded(text: Column | str) -> Column:
    """``fold`` of a column: ASCII in the JVM, other texts in Arrow batches, for the JVM has neither this decomposition nor case folding."""
    text = F.col(text) if isinstance(text, str) else text
    text = text.cast("string")
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.trim(F.regexp_replace(F.lower(text), "[\\x09-\\x0d\\x1c-\\x20]+", " "))).otherwise(_fold(F.when(~plain, text)))


def _one(words: str, sep: str | None = None) -> str:
    return "(?:" + "|".join(sorted(words.split(sep))) + ")"


_NOUN = {
    "pt": _one("artigo conteudo contexto documento fonte material passagem texto trecho"),
    "en": _one("article content context document material passage source text"),
    "es": _one("articulo contenido contexto documento fuente material pasaje texto"),
}
_THIS = _one("a o esta este essa esse")
_MAYBE = {"pt": f"(?:{_one('a o esta este essa esse um uma')} )?", "en": f"(?:{_one('above below provided that the this')} )?", "es": f"(?:{_one('el la ese esa este esta')} )?"}
#: References to a source that the reader doesn't see, over folded text, in the order in which they are tried.
REFERENCES = (
    rf"\b{_one('segundo,conforme,de acordo com,com base em,com base no,com base na', ',')} {_MAYBE['pt']}{_NOUN['pt']}\b",
    rf"\b{_NOUN['pt']} (?:acima|abaixo|(?:fornecid|apresentad)[ao]s?)\b",
    rf"\b(?:{_one('mencionad citad descrit informad apresentad')}[ao]s?) {_one('na no nessa nesse nesta neste')} {_NOUN['pt']}\b",
    rf"\b{_THIS} {_NOUN['pt']} {_one('cita mostra afirma informa fornece descreve menciona apresenta')}\b",
    rf"\b{_one('based on,according to', ',')} {_MAYBE['en']}{_NOUN['en']}\b",
    rf"\b{_NOUN['en']} {_one('provided below above')}\b",
    rf"\b{_one('shown stated provided presented described mentioned cited')} in (?:{_one('provided that this the')} )?{_one('article context document passage source text')}\b",
    rf"\b{_one('segun,con base en,de acuerdo con', ',')} {_MAYBE['es']}{_NOUN['es']}\b",
    rf"\b{_NOUN['es']} (?:siguiente|anterior|proporcionad[ao])\b",
)


def reference_in(text: Column) -> Column:
    """The first reference in folded text, by the order of REFERENCES, or null. Stays in the JVM."""
    found = [F.nullif(F.regexp_extract(text, "(?U)" + p, 0), F.lit("")) for p in REFERENCES]
    return F.coalesce(*found)


def has_reference(*texts: Column) -> Column:
    """Is there a reference in any of these folded texts; null counts as none."""
    out = F.lit(False)
    for t in texts:
        out = out | F.coalesce(t.rlike("(?U)" + "|".join(REFERENCES)), F.lit(False))
    return out


def fingerprint(*texts: Column) -> Column:
    """SHA-256 of folded texts joined by U+001F: 64 characters to compare, group and join by, whatever the texts' length."""
    return F.sha2(F.concat_ws("\u001f", *(F.coalesce(t, F.lit("")) for t in texts)), 256)


def tokens_of(length: Column) -> Column:
    """A quarter of so many characters, rounded up, at least 1."""
    return F.greatest(F.lit(1), F.ceil(length / 4)).cast("int")


def estimated_tokens(text: Column) -> Column:
    return tokens_of(F.length(text))


def friendly_reason(error: Column, issues: Column, status: Column) -> Column:
    """What to show for an attempt: a plain message for known errors, else the error's first line, the issues, or the status."""
    known = (
        F.when(error.contains("JSONDecodeError"), "The model's answer was not valid JSON")
        .when(error.contains("ValidationError") | error.contains("Pydantic"), "The answer does not follow the schema")
        .when(error.contains("backend returned no response"), "The backend gave no answer")
        .otherwise(F.substring_index(F.regexp_replace(error, r"\r\n?", "\n"), "\n", 1))
    )
    return F.when(F.coalesce(error, F.lit("")) != "", known).when(F.coalesce(F.size(issues), F.lit(0)) > 0, F.array_join(issues, ", ")).otherwise(status)


def model_json(answer: Column) -> Column:
    """The JSON object in a model's answer as text: fences dropped, else from the first "{" to the last "}"; null if there is none."""
    bare = strip(answer)
    bare = F.regexp_replace(bare, r"(?iU)\A```(?:json)?\s*", "")
    bare = F.regexp_replace(bare, r"(?U)\s*```\z", "")
    first = F.locate("{", bare)
    last = F.length(bare) - F.locate("}", F.reverse(bare)) + 1
    inner = F.when((first > 0) & bare.contains("}") & (last > first), F.substring(bare, first, last - first + 1))
    whole = F.to_json(F.try_parse_json(bare))
    cut = F.to_json(F.try_parse_json(inner))
    # what parses as a whole but is no object is an error, not a reason to look inside
    return F.when(whole.isNotNull(), F.when(whole.startswith("{"), whole)).otherwise(F.when(cut.startswith("{"), cut))


def identifier(prefix: str, number: Column, width: int = 8) -> Column:
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", number.cast("long")))
