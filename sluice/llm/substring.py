"""Repeated passages: lines and runs of clauses are normalised and hashed, the earliest of each digest stays, the others are cut out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Least weight of a line that counts and of a run of clauses; a shorter one ("All rights reserved.") is never cut out alone.
MIN_WORDS, RUN_WORDS = 8, 20
#: Code of a text that repeats a unit of its own.
AGAIN = -1
#: Full stops and commas of scripts without spaces end a clause by themselves; other typographic marks and spaces count as a space.
_STOPS = "\u3002\uff01\uff1f\uff1b\uff1a\uff0c\u3001\uff0e\uff61\uff64"
_BLANKS = "\x1c\x1d\x1e\x1f\x85\xa0\xa1\xab\xb7\xbb\xbf" + "".join(map(chr, [*range(0x2000, 0x2030), 0x2039, 0x203A, 0x205F, 0x3000, 0xFEFF]))
FROM, TO = _STOPS + _BLANKS + "İΣ", "\x1f" * len(_STOPS) + " " * len(_BLANKS) + "iσ"
_TABLE = str.maketrans(FROM, TO)
_MARK = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x1f", np.uint8))
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c\x1f", np.uint8))
_LINE = np.arange(256) == 10
_CHAR = (np.arange(256) & 0xC0) != 0x80
_WIDE = np.arange(256) >= 0xE0


class Units:
    """Clauses of texts and the units made of them.

    A clause ends behind a run of marks and white space that holds both. A unit is a line of weight ``least``, or the
    clauses from one with a word up to the first at which their weight is ``run``. A weight is the number of words, and
    half the characters from U+0800 on, whose scripts may have no spaces. Of clause k: ``of`` (its text), ``char`` (its
    first character). Of each unit, by text and place: ``text``, ``first`` and ``last`` (clauses), ``pos`` (twice the
    number of its first clause in the text, and 1 for a line), ``d1`` and ``d2`` (digest), ``again`` (has the text had it before?).
    """

    def __init__(self, texts: list[str], least: int = MIN_WORDS, run: int = RUN_WORDS):
        w = C.Words([t if t.isascii() and "\x1e" not in t and "\x1f" not in t else t.translate(_TABLE) for t in texts])
        a, u64 = w.buf, np.uint64
        count = lambda of: np.concatenate([[0], np.cumsum(of[a])])
        marks, blanks, lines, chars, wide = map(count, (_MARK, _BLANK, _LINE, _CHAR, _WIDE))
        # texts stand one behind another with a line end behind each
        size = np.array([len(t) + 1 for t in texts], np.int64)
        at = np.searchsorted(chars, np.cumsum(size) - size, side="right") - 1 if texts else np.zeros(0, np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ~(_MARK | _BLANK)[a], [False]]).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        gap = np.maximum(np.concatenate([[0], end[:-1]])[: len(start)], at[np.searchsorted(at, start, side="right") - 1] if len(start) else 0)
        new = (marks[start] > marks[gap]) & (blanks[start] > blanks[gap])
        p = np.unique(np.concatenate([at[size > 1], start[new]]))
        self.of = of = np.searchsorted(at, p, side="right") - 1
        self.char = chars[p] - chars[at[of]]
        word = np.append(np.searchsorted(w.start, p), len(w.hash))
        stop = np.append(p[1:], len(a))
        weight = np.diff(word) + (wide[stop] - wide[p]) // 2
        upto = np.concatenate([[0], np.cumsum(weight)])
        n = len(p)
        to = np.searchsorted(upto[1:], upto[:-1] + run)
        begin = np.flatnonzero((weight > 0) & (to < n) & (of[np.minimum(to, n - 1)] == of)) if n else np.zeros(0, np.int64)
        head = np.flatnonzero(np.concatenate([[True], (lines[p[1:]] > lines[p[:-1]]) | (of[1:] > of[:-1])])[:n])
        tail = np.append(head[1:], n) - 1
        whole = upto[tail + 1] - upto[head] >= least if n else np.zeros(0, bool)
        first, last = np.concatenate([begin, head[whole]]), np.concatenate([to[begin], tail[whole]])
        kind = np.arange(len(first)) >= len(begin)
        up, down = C._powers(len(w.hash) + 1)

        def digest(h: np.ndarray, salt: int) -> np.ndarray:
            total = np.concatenate([np.zeros(1, u64), np.cumsum(h * up[: len(h)])])
            b, e = word[first], word[last + 1]
            return C.mix((total[e] - total[b]) * down[b] + (e - b).astype(u64) * u64(salt) + kind.astype(u64))

        d1, d2 = digest(w.hash, 0x9E3779B97F4A7C15), digest(C.mix(w.hash ^ u64(0xA0761D6478BD642F)), 0xE7037ED1A0B428DB)
        zero = np.searchsorted(of, np.arange(len(texts)))  # first clause of each text
        pos = (first - zero[of[first]]) * 2 + kind
        by = np.lexsort((pos, d2, d1, of[first]))
        again = np.zeros(len(by), bool)
        if len(by) > 1:
            x, y = by[1:], by[:-1]
            again[x] = (d1[x] == d1[y]) & (d2[x] == d2[y]) & (of[first[x]] == of[first[y]])
        order = np.lexsort((pos, of[first]))
        self.first, self.last, self.pos, self.again = first[order], last[order], pos[order], again[order]
        self.d1, self.d2, self.text = d1[order].view(np.int64), d2[order].view(np.int64), of[self.first]

    def codes(self) -> np.ndarray:
        """Place and half of the second digest of each unit."""
        return self.pos << 32 | self.d2 & 0xFFFFFFFF


def cut(texts: list[str | None], late: list[list[int] | None], least: int = MIN_WORDS, run: int = RUN_WORDS) -> tuple[list[str | None], list[list[tuple[int, int]]]]:
    """Texts without the units of these codes, and the removed spans as [start, end) characters of the original."""
    out, spans = list(texts), [[] for _ in texts]
    own = [i for i, (t, x) in enumerate(zip(texts, late, strict=True)) if t and x]
    for i, j in C.steps([texts[k] for k in own]):
        some = own[i:j]
        u = Units([texts[k] for k in some], least, run)
        codes, clauses, units = u.codes(), np.searchsorted(u.of, np.arange(j - i + 1)), np.searchsorted(u.text, np.arange(j - i + 1))
        for n, k in enumerate(some):
            t, mine = texts[k], slice(units[n], units[n + 1])
            gone = np.isin(codes[mine], np.array(late[k], np.int64)) | (u.again[mine] & (AGAIN in late[k]))
            cover = np.zeros(clauses[n + 1] - clauses[n] + 1, np.int64)
            np.add.at(cover, u.first[mine][gone] - clauses[n], 1)
            np.add.at(cover, u.last[mine][gone] - clauses[n] + 1, -1)
            flip = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(cover) > 0]).astype(np.int8)))
            at = np.append(u.char[clauses[n] : clauses[n + 1]], len(t))[flip].tolist()
            spans[k] = list(zip(at[::2], at[1::2], strict=True))
            out[k] = "".join(t[x:y] for x, y in zip([0, *at[1::2]], [*at[::2], len(t)], strict=True))
    return out, spans


def units(docs: DataFrame, least: int = MIN_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """doc_id, d1 and code of every unit of docs(doc_id, text) that its text hasn't had before, and a row of code AGAIN where it has had one.

    d1 and the low half of the code are the digest (96 bits), the high half of the code is the place.
    """
    import pyarrow as pa

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in C.steps(texts):
                u = Units(texts[i:j], least, run)
                new, own = np.flatnonzero(~u.again), np.unique(u.text[u.again])
                d1, code = np.concatenate([u.d1[new], np.zeros(len(own), np.int64)]), np.concatenate([u.codes()[new], np.full(len(own), AGAIN)])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate([u.text[new], own]) + i)), pa.array(d1), pa.array(code)], ["doc_id", "d1", "code"])

    return docs.mapInArrow(each, f"doc_id {C.kind(docs, 'doc_id')}, d1 long, code long")


def repeats(docs: DataFrame, least: int = MIN_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """doc_id and codes (of its units that occurred before, by the order of doc_id and then of place; AGAIN for those that it repeats itself).

    Joins sort both sides at any size, so that a run on little data has the plan of one on much.
    """
    u = C.cut(units(docs, least, run))
    fresh = u.where(F.col("code") != AGAIN).withColumn("d2", F.col("code").bitwiseAND(0xFFFFFFFF))
    first = fresh.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    late = fresh.join(first.hint("merge"), ["d1", "d2"]).where("doc_id <> first").select("doc_id", "code").union(u.where(F.col("code") == AGAIN).select("doc_id", "code"))
    return late.groupBy("doc_id").agg(F.collect_set("code").alias("codes"))


def cleaned(docs: DataFrame, least: int = MIN_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """doc_id, text (what is left) and removed (array of struct start, end: spans of the original) of every row of docs(doc_id, text).

    Units are lines of at least ``least`` words and runs of clauses of at least ``run`` words (see :class:`Units`), compared
    without case, punctuation and spacing. The first occurrence of a unit, by doc_id and then place, stays in the whole
    corpus; every later one, in the same document too, goes, so a passage goes from its first whole clause to its last
    wherever in a line it stands. Null texts stay null and empty ones empty, both with no spans. Rows that repeat a
    doc_id are taken as one document and don't clean each other. A null doc_id takes no part and its row stays as it is.
    A document of nothing but repeats comes out with the text "". An empty table gives no rows; other columns are ignored.
    """
    import pyarrow as pa

    docs = C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    late = C.cut(repeats(docs.where("doc_id is not null"), least, run))
    key = C.kind(docs, "doc_id")
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, spans = cut(b.column(1).to_pylist(), b.column(2).to_pylist(), least, run)
            removed = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(span))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), removed], ["doc_id", "text", "removed"])

    both = docs.join(late.hint("merge"), "doc_id", "left").select("doc_id", "text", "codes")
    return both.mapInArrow(clean, f"doc_id {key}, text string, removed array<struct<start:int,end:int>>")


def without_repeats(docs: DataFrame, least: int = MIN_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """docs with each text cut as by :func:`cleaned`, n_chars made to fit where there is one, and documents left empty by it dropped.

    Rows of null or empty text, of a null doc_id and of a repeated one are kept as :func:`cleaned` says; an empty table
    gives no rows; all columns, whatever their names, stay.
    """
    import pyarrow as pa

    names, kinds = docs.columns, [f.dataType.simpleString() for f in docs.schema.fields]
    plain, at = C.plain(docs), {n: f"c{i}" for i, n in enumerate(docs.columns)}
    key, text, chars = at["doc_id"], at["text"], at.get("n_chars")
    plain = plain.withColumn(text, F.col(text).cast("string"))
    late = C.cut(repeats(plain.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text")), least, run)).toDF("id", "codes")
    both = plain.join(late.hint("merge"), F.col(key) == F.col("id"), "left").drop("id")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            codes = t["codes"].to_pylist()
            out, _ = cut(t[text].to_pylist(), codes, least, run)
            gone = pa.array([bool(y) and not (x or "").strip() for x, y in zip(out, codes, strict=True)])
            t = t.set_column(t.schema.get_field_index(text), text, pa.array(out, pa.string())).drop_columns(["codes"]).append_column("gone", gone)
            yield from t.to_batches()

    fields = ", ".join(f"{c} {'string' if c == text else k}" for c, k in zip(plain.columns, kinds, strict=True))
    kept = both.mapInArrow(clean, f"{fields}, gone boolean").where("not gone").drop("gone")
    if chars:
        kept = kept.withColumn(chars, F.length(text).cast(kinds[names.index("n_chars")]))
    return kept.toDF(*names)


_ALL = "PARTITION BY doc_id ORDER BY i"
_CODES = lambda s: " || ".join(f"chr({ord(c)})" for c in s)
#: The whole of ``cleaned`` but for the spans' form, in DuckDB's SQL: spans as text, "start-end" joined by commas.
SQL = rf"""
WITH t AS (
  SELECT doc_id, text, lower(translate(text, {_CODES(FROM)}, {_CODES(TO)})) AS n FROM documents WHERE text IS NOT NULL AND text <> ''),
s AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(n, '([.,;:!?\n\x1f \t\r\x0b\x0c]*(?:[.,;:!?][ \t\r\x0b\x0c]|[ \t\r\x0b\x0c][.,;:!?]|[\n\x1f])[.,;:!?\n\x1f \t\r\x0b\x0c]*)', '\1' || chr(30), 'g'), chr(30)), lambda x: x <> '') AS parts FROM t),
p AS (
  SELECT doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS part FROM s),
m AS (
  SELECT *, trim(regexp_replace(part, '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+', ' ', 'g')) AS unit,
         coalesce(sum(length(part) - length(replace(part, chr(10), ''))) OVER ({_ALL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM p),
v AS (
  SELECT *, CASE WHEN unit = '' THEN 0 ELSE len(string_split(unit, ' ')) END + length(regexp_replace(part, '[^\x{{800}}-\x{{10FFFF}}]', '', 'g')) // 2 AS weight FROM m),
c AS (
  SELECT *, sum(weight) OVER ({_ALL}) AS upto, sum(length(part)) OVER ({_ALL}) AS stop FROM v),
e AS (
  SELECT doc_id, upto, min(i) AS i FROM c GROUP BY ALL),
u AS (
  SELECT a.doc_id, a.i AS head, e.i AS tail, 'run' AS kind FROM (SELECT doc_id, i, upto - weight + {RUN_WORDS} AS need FROM c WHERE weight > 0) a ASOF JOIN e ON a.doc_id = e.doc_id AND a.need <= e.upto
  UNION ALL
  SELECT doc_id, min(i), max(i), 'line' FROM c GROUP BY doc_id, line HAVING sum(weight) >= {MIN_WORDS}),
a AS (
  SELECT doc_id, list(unit ORDER BY i) AS units FROM c GROUP BY doc_id),
g AS (
  SELECT doc_id, head, tail, row_number() OVER (PARTITION BY kind, body ORDER BY doc_id, head) > 1 AS late FROM (
    SELECT u.*, array_to_string(list_filter(units[head + 1:tail + 1], lambda x: x <> ''), ' ') AS body FROM u JOIN a USING (doc_id))),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(head, tail + 1)) AS i FROM g WHERE late),
k AS (
  SELECT c.doc_id, c.i, stop - length(part) AS s, stop AS e, gone.i IS NOT NULL AS out FROM c LEFT JOIN gone ON gone.doc_id = c.doc_id AND gone.i = c.i),
r AS (
  SELECT *, i - sum(out::INT) OVER ({_ALL}) AS run FROM k),
spans AS (
  SELECT doc_id, string_agg(s || '-' || e, ',' ORDER BY s) AS removed FROM (
    SELECT doc_id, min(s)::BIGINT AS s, max(e)::BIGINT AS e FROM r WHERE out GROUP BY doc_id, run) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substring(text, s::BIGINT + 1, (e - s)::BIGINT), '' ORDER BY i) AS text FROM k JOIN t USING (doc_id) WHERE NOT out GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, coalesce(spans.removed, '') AS removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""
