"""Near-duplicates by improved consistent weighted sampling (Ioffe, 2010) over TF-IDF shingles, banded and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .graph import components

#: Words in a shingle; weighted Jaccard similarity from which two documents are copies; bands and samples in a band
#: (a pair at the threshold itself shares a band with a chance of 1 - (1 - 0.5**4)**36 = 0.90).
SHINGLE, THRESHOLD, BANDS, ROWS = 2, 0.5, 36, 4
#: Shingles that may be frequent: those in more documents than 1/FREQUENT of all (document, shingle) pairs, so there are as many at most.
FREQUENT = 1 << 17
#: Hash buckets of the count that bounds each shingle's from above.
_BITS = 19
#: Random draws of each kind; a shingle takes others for each sample. A table of them fits a core's cache.
_DRAWS_BITS = 16
#: Members of a bucket that are compared with each other in one task.
BLOCK = 512
_tables: list[np.ndarray] = []


class Frequencies:
    """ln((1 + documents) / (1 + documents with a shingle)) + 1; shingles in fewer documents than ``least`` count as in that many."""

    def __init__(self, keys: np.ndarray, df: np.ndarray, least: int, documents: int):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.idf = (np.log((1 + documents) / (1 + df[order])) + 1).astype(np.float32)
        self.rare = np.float32(np.log((1 + documents) / (1 + least)) + 1)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(shingles), self.rare)
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        return np.where(self.keys[at] == shingles, self.idf[at], self.rare)


def weights(words: np.ndarray, idf: Frequencies | None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and their TF-IDF (or counts, without idf)."""
    s, tf = np.unique(C.shingles(words, n), return_counts=True)
    return s, tf if idf is None else tf * idf.of(s)


def tables() -> list[np.ndarray]:
    """Draws of 1/r, r, beta and ln c: r, c from Gamma(2, 1), beta uniform."""
    if not _tables:
        n = 1 << _DRAWS_BITS
        u = C.mix(np.arange(1, 5 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        u = (((u >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53).reshape(5, n)
        r, c = -np.log(u[0] * u[1]), -np.log(u[2] * u[3])
        _tables[:] = [x.astype(np.float32) for x in (1 / r, r, u[4], np.log(c))]
    return _tables


_plain: dict[float, tuple[np.ndarray, np.ndarray]] = {}


def plain(w: float) -> tuple[np.ndarray, np.ndarray]:
    """t and ln a of each draw for the one weight that most shingles have."""
    if w not in _plain:
        inv, r, beta, lnc = tables()
        t = np.floor(np.float32(np.log(w)) * inv + beta)
        _plain.clear()
        _plain[w] = t, lnc - r * (t - beta) - r
    return _plain[w]


def sample(s: np.ndarray, w: np.ndarray, k: int, common: float | None = None) -> np.ndarray:
    """k samples (hash of shingle and t) of a weighted set; two sets agree at a sample with their weighted Jaccard similarity.

    Of the draws, each shingle takes others for each sample. ``common``: a weight that many shingles have.
    """
    low, high = s.astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    nth, shift = np.arange(1, k + 1, dtype=np.uint32)[:, None], np.uint32(32 - _DRAWS_BITS)
    best, out, rows = np.full(k, np.inf, np.float32), np.zeros(k, np.uint64), np.arange(k)

    def take(own: np.ndarray, lna: np.ndarray, t: np.ndarray, draw: np.ndarray | None) -> None:
        at = lna.argmin(axis=1)
        got = lna[rows, at]
        less = np.flatnonzero(got < best)
        best[less] = got[less]
        steps = t[rows[less], at[less]] if draw is None else t[draw[rows[less], at[less]]]
        out[less] = C.mix(s[own[at[less]]] + np.uint64(C._P) * steps.astype(np.int64).view(np.uint64))

    same = w == np.float32(common) if common else np.zeros(len(s), bool)
    for own in (np.flatnonzero(same), np.flatnonzero(~same)):
        for i in range(0, len(own), 512):
            x = own[i : i + 512]
            draw = nth * high[x]
            draw += low[x]
            draw >>= shift
            draw = draw.astype(np.intp)
            if same[x[0]]:
                t, lna = plain(float(np.float32(common)))
                take(x, lna.take(draw, mode="clip"), t, draw)
            else:
                inv, r, beta, lna = (table.take(draw, mode="clip") for table in tables())
                inv *= np.log(w[x]).astype(np.float32)
                inv += beta
                t = np.floor(inv, out=inv)
                # ln a = ln c - r * (t - beta) - r
                beta -= t
                beta -= 1
                beta *= r
                lna += beta
                take(x, lna, t, None)
    return out


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets of ascending shingles."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    least = np.minimum(a[1], b[1][at])[b[0][at] == a[0]].sum()
    return float(least / (a[1].sum() + b[1].sum() - least))


def _each(texts: list[str]) -> Iterator[np.ndarray]:
    for i, j in C.steps(texts):
        w = C.Words(texts[i:j])
        for x in range(j - i):
            yield w.hash[w.at[x] : w.at[x + 1]]


def document_frequencies(docs: DataFrame, n: int = SHINGLE, frequent: int = FREQUENT) -> Frequencies:
    """Document frequencies of docs(text): exact for every shingle in at least a share of 1/``frequent`` of all pairs, that share for the others.

    The first pass counts hash buckets, which bound the counts of their shingles from above; the second counts the
    shingles of the buckets that reach the share. So tables stay as small on any corpus, and the share is relative to it.
    """
    import pyarrow as pa

    shift = np.uint64(64 - _BITS)

    def counted(batches: Iterator[pa.RecordBatch], of, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        rows, size, count = [], 0, 0
        for b in batches:
            for words in _each([t or "" for t in b.column(0).to_pylist()]):
                if len(words):
                    count += 1
                    rows.append(of(np.unique(C.shingles(words, n))))
                    size += len(rows[-1])
                    if size > most:
                        yield *np.unique(np.concatenate(rows), return_counts=True), count
                        rows, size, count = [], 0, 0
        if rows:
            yield *np.unique(np.concatenate(rows), return_counts=True), count

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, count = np.zeros(1 << _BITS, np.int64), 0
        for at, c, docs_ in counted(batches, lambda s: s >> shift, 1 << 20):
            seen[at.astype(np.int64)] += c
            count += docs_
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(seen[at], count))], ["bucket", "n"])

    texts = docs.select("text")
    rows = texts.mapInArrow(buckets, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    documents, rows = int(rows.n[rows.bucket < 0].sum()), rows[rows.bucket >= 0]
    least = max(1, -(-int(rows.n.sum()) // frequent))
    may = np.zeros(1 << _BITS, bool)
    may[rows.bucket[rows.n >= least]] = True
    shared = docs.sparkSession.sparkContext.broadcast(may)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        for s, c, _ in counted(batches, lambda s: s[shared.value[(s >> shift).astype(np.int64)]], 1 << 20):
            keys, at = np.unique(np.concatenate([held[0], s]), return_inverse=True)
            held = [keys, np.bincount(at, weights=np.concatenate([held[1], c]), minlength=len(keys)).astype(np.int64)]
            if len(keys) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1])], ["s", "n"])
                held = [np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1])], ["s", "n"])

    found = texts.mapInArrow(shingles, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()  # ``frequent`` rows at most
    return Frequencies(found.s.to_numpy(np.int64).view(np.uint64), found.n.to_numpy(np.int64), least, documents)


def sketches(docs: DataFrame, idf, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, whole (hash of all words in order; null without words) and bands (array of long)."""
    import pyarrow as pa

    key = C.kind(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole, out = [], []
            for words in _each([t or "" for t in b.column(1).to_pylist()]):
                if len(words):
                    s, w = weights(words, idf.value, n)
                    h = np.arange(1, bands + 1, dtype=np.uint64)
                    for column in sample(s, w, bands * rows, idf.value.rare).reshape(bands, rows).T:
                        h = C.mix(h * np.uint64(C._P) + column)
                    out.append(h.view(np.int64))
                    whole.append(int(C.mix((words * C._powers(len(words))[0][: len(words)]).sum(keepdims=True) + np.uint64(len(words))).view(np.int64)[0]))
                else:
                    out.append(np.zeros(0, np.int64))
                    whole.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(whole, pa.int64()), C.list_column(out, np.int64)], ["doc_id", "whole", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, whole long, bands array<long>")


def vectors(docs: DataFrame, n: int) -> DataFrame:
    """id and vec: the shingles (uint64) and then their counts (uint32), as bytes."""
    import pyarrow as pa

    key = C.kind(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for words in _each([t or "" for t in b.column(1).to_pylist()]):
                s, tf = weights(words, None, n)
                out.append(s.astype("<u8").tobytes() + tf.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "vec"])

    return docs.select("doc_id", "text").mapInArrow(run, f"id {key}, vec binary")


def verified(pairs: DataFrame, vecs: DataFrame, idf) -> DataFrame:
    """pairs(a, b) with their weighted Jaccard similarity; an ``a`` of many pairs has its vector in as many tasks as they need."""
    import pyarrow as pa

    key = C.kind(pairs, "a")

    def read(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        m = len(raw) // 12
        s = np.frombuffer(raw, "<u8", m)
        return s, np.frombuffer(raw, "<u4", m, 8 * m) * idf.value.of(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, vec = None, None
        for b in batches:
            out = []
            for va, vb in zip(b.column(2), b.column(3), strict=True):
                va = va.as_py()
                if va != last:
                    last, vec = va, read(va)
                out.append(jaccard(vec, read(vb.as_py())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    parts = C.cut(pairs.groupBy("a").agg(F.ceil(F.count("*") / C.HOT).cast("int").alias("parts")).where("parts > 1"))
    many = C.small_ids(parts)
    spread = pairs.join(many, "a", "left").select("a", "b", F.pmod(F.hash("b"), F.coalesce("parts", F.lit(1))).alias("part"))
    heads = vecs.toDF("a", "va").join(many, "a", "left").select("a", "va", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    both = spread.join(vecs.toDF("b", "vb"), "b").join(heads, ["a", "part"]).select("a", "b", "va", "vb")
    return both.mapInArrow(run, f"a {key}, b {key}, similarity double")


def between(buckets: DataFrame, sim: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of members of a bucket that are in different components and could be similar.

    1 - similarity is a metric, so two members whose distances to their bucket's head differ by more than 1 - threshold
    are not similar to each other. A large bucket is compared block by block, each pair of blocks in a task of its own.
    """
    own = buckets.join(roots.toDF("b", "root"), "b", "left").select("h", "a", "b", F.coalesce("root", "b").alias("root"))
    own = own.join(sim.select("a", "b", "similarity"), ["a", "b"], "left").select("h", "b", "root", F.coalesce("similarity", F.lit(1.0)).alias("sim"))
    own = C.cut(own)
    mixed = own.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("r0 <> r1 and n > 2")
    own = C.by_key(own, C.cut(mixed.select("h", "blocks", "n")), "h").withColumn("block", F.pmod(F.hash("b"), F.col("blocks")))
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = own.select("h", "b", "root", "sim", F.col("block").alias("i"), F.explode(all_blocks).alias("j"))
    right = own.select("h", F.col("b").alias("b2"), F.col("root").alias("root2"), F.col("sim").alias("sim2"), F.col("block").alias("j"), F.explode(all_blocks).alias("i"))
    pairs = left.join(right, ["h", "i", "j"]).where((F.col("b") < F.col("b2")) & (F.col("root") != F.col("root2")) & (F.abs(F.col("sim") - F.col("sim2")) <= 1 - threshold + 1e-9))
    return pairs.select(F.col("b").alias("a"), F.col("b2").alias("b")).distinct()


def groups(docs: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, group_doc_id (least doc_id of its group) and keep (is it that one), a row for each doc_id of docs(doc_id, text).

    Groups are the connected components of pairs whose weighted Jaccard similarity over TF-IDF shingles of n words is at
    least ``threshold``. Every document is a query; candidates share one of ``bands`` bands of consistent weighted
    samples. A band's bucket is first checked as a star around its least document; where that leaves a bucket in several
    components, the pairs between them that could be similar are checked, so thousands of copies of one document cost a
    comparison each and no pair that could join two groups is passed over. Texts with the same words in the same order
    are copies without a comparison. Null, empty and wordless texts are groups of their own. Rows that repeat a doc_id
    count as one document of that id (one row comes out); a null doc_id can't be grouped and gives no row. An empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")).where("doc_id is not null")
    idf = spark.sparkContext.broadcast(document_frequencies(docs, n))
    sk = C.cut(sketches(docs, idf, n, bands, rows))
    same = C.cut(sk.where("whole is not null").groupBy("whole").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1"))
    copies = C.cut(C.by_key(sk.select("doc_id", "whole"), same, "whole").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct())
    heads = sk.join(copies.select(F.col("b").alias("doc_id")), "doc_id", "left_anti")
    members = C.cut(heads.select("doc_id", F.explode("bands").alias("h")))
    first = C.cut(members.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count("*").alias("n")).where("a <> z").drop("z"))
    buckets = C.cut(C.by_key(members, first, "h").select("h", "a", F.col("doc_id").alias("b")))
    star = C.cut(buckets.where("a <> b").select("a", "b").distinct())
    ids = C.cut(star.select(F.col("a").alias("doc_id")).union(star.select("b")).distinct())
    vecs = C.cut(vectors(docs.join(C.small_ids(ids), "doc_id", "left_semi"), n).dropDuplicates(["id"]))
    sim = C.cut(verified(star, vecs, idf))
    close = copies.union(sim.where(F.col("similarity") >= threshold).select("a", "b"))
    roots = components(close)
    rest = C.cut(between(buckets, sim, roots, threshold).join(star, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        more = C.cut(verified(rest, vecs, idf).where(F.col("similarity") >= threshold))
        if not more.isEmpty():
            roots = components(close.union(more.select("a", "b")))
    every = sk.select("doc_id").distinct()
    out = every.join(roots.toDF("doc_id", "root"), "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("group_doc_id"))
    return out.withColumn("keep", F.col("doc_id") == F.col("group_doc_id"))


def drop_copies(docs: DataFrame, **how) -> DataFrame:
    """docs without the documents that aren't the first of their group by :func:`groups`.

    Null, empty and wordless texts stay, as do rows of a null doc_id and all rows of a repeated one that stays; an empty
    table gives no rows; all columns stay, whatever their names.
    """
    return C.without(docs, "doc_id", C.cut(groups(docs, **how).where("not keep").select("doc_id")))
