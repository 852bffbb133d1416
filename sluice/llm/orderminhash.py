"""Order MinHash (Marçais et al., 2019): fingerprints that follow edit distance, since they keep the order of k-mers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Words in a k-mer, k-mers in a tuple, tuples in a signature.
K, TUPLE, SKETCHES = 2, 3, 16


def occurrences(kmers: np.ndarray) -> np.ndarray:
    """How often each k-mer has been seen before it: 0 at its first place."""
    order = np.argsort(kmers, kind="stable")
    new = np.concatenate([[True], kmers[order[1:]] != kmers[order[:-1]]])
    at = np.arange(len(kmers))
    out = np.empty(len(kmers), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


def signature(words: np.ndarray, k: int = K, size: int = TUPLE, sketches: int = SKETCHES) -> np.ndarray:
    """``sketches`` hashes of word hashes: each of the ``size`` least occurrence-numbered k-mers in the order of the text."""
    if not len(words):
        return np.zeros(0, np.int64)
    kmers = C.shingles(words, k)
    numbered = C.mix(kmers + np.uint64(0x632BE59BD9B4E019) * occurrences(kmers).astype(np.uint64))
    least = min(size, len(kmers))
    chosen = np.empty((sketches, least), np.int64)
    for m in range(sketches):
        ranks = C.mix(numbered ^ C.BYTES[m % 256] + np.uint64(m))
        chosen[m] = np.argpartition(ranks, least - 1)[:least]
    chosen.sort(axis=1)
    out = np.arange(1, sketches + 1, dtype=np.uint64)
    for column in kmers[chosen].T:
        out = C.mix(out * np.uint64(C._P) + column)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, k: int = K, size: int = TUPLE, sketches: int = SKETCHES) -> DataFrame:
    """doc_id, n_kmers and signature (array of long) of every row of docs(doc_id, text).

    A k-mer is k words in a row, lower-cased, without punctuation; a text of fewer words is one k-mer, and one of fewer
    than ``size`` k-mers takes those it has. Null, empty and wordless texts get n_kmers 0 and an empty signature, a null
    doc_id stays null, repeated rows give repeated equal rows, and other columns are ignored. The share of equal places
    of two signatures estimates order-aware similarity. One narrow pass: no shuffle, any text length.
    """
    import pyarrow as pa

    key = C.kind(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            out, n = [], []
            for i, j in C.steps(texts):
                w = C.Words(texts[i:j])
                for x in range(j - i):
                    own = w.hash[w.at[x] : w.at[x + 1]]
                    n.append(max(len(own) - k + 1, min(1, len(own))))
                    out.append(signature(own, k, size, sketches))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), C.list_column(out, np.int64)], ["doc_id", "n_kmers", "signature"])

    return C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")).mapInArrow(run, f"doc_id {key}, n_kmers long, signature array<long>")


def similarity(a: str, b: str) -> object:
    """Column: share of places at which two signatures agree; 0 where either is empty."""
    same = F.size(F.filter(F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y")), lambda p: p["x"] == p["y"]))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), same / F.greatest(F.size(a), F.size(b))).otherwise(F.lit(0.0))
