"""Quality classifier: expectation-maximisation weighs overlapping heuristic labellers, and their posteriors train a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Most documents on which the lexicons and the scorer are fitted, labelled ones first, chosen by the hash of doc_id.
FIT_DOCS = 16_000
#: Score from which a document is junk or toxic.
REJECT = 0.5
#: Hashed features: words and their first 4 to 7 bytes; the first DENSE are bins of the text's shape.
BITS, DENSE = 20, 32
PREFIXES = (4, 5, 6, 7)
#: Words that an untrained labeller takes for insults.
INSULTS = ("idiot", "stupid", "moron", "loser", "pathetic", "scum", "worthless", "trash", "disgusting", "clown")
#: Labellers, by task; a vote is 1 (bad), 0 (good) or -1 (none).
JUNK = ("symbols", "shouting", "stutter", "bars", "sentences", "plain", "human")
TOXIC = ("insults", "words", "prefixes", "silence", "human")
_SHIFT = np.uint64(64 - BITS)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"%#*&$|!@~^_=<>{}[]\\+", np.uint8))
_BAR = np.isin(np.arange(256), np.frombuffer(b"|", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) < 91)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) < 123)
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))
_INK = np.arange(256) > 32


class Features:
    """Features of texts: ``index`` (hashed, of words and prefixes) with ``doc`` of each, and ``shape`` (texts x 5 shares)."""

    def __init__(self, texts: list[str]):
        w = C.Words(texts)
        n = len(texts)
        count = np.diff(w.at)
        doc = np.repeat(np.arange(n), count)
        self.words = w.hash
        self.parts = [w.hash, *(w.prefixes(p) for p in PREFIXES)]
        self.index = [((h >> _SHIFT).astype(np.int64) | DENSE) for h in self.parts]
        self.doc = doc
        raw = [t.encode("utf-8", "replace") for t in texts]
        a = np.frombuffer(b"".join(raw) + b"\n", np.uint8)
        at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)

        def share(of: np.ndarray) -> np.ndarray:
            s = np.concatenate([[0], np.cumsum(of[a], dtype=np.int64)])
            return np.diff(s[at])

        ink, up = np.maximum(share(_INK), 1), share(_UPPER)
        same = np.zeros(len(w.hash), bool)
        if len(same) > 1:
            same[1:] = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
        stutter = np.bincount(doc, weights=same, minlength=n) / np.maximum(count, 1)
        self.shape = np.stack([share(_SYMBOL) / ink, up / np.maximum(up + share(_LOWER), 1), stutter, share(_BAR) / np.maximum(count, 1), count / np.maximum(share(_STOP), 1)], axis=1)
        self.count = count

    EDGES = np.array([[0.01, 0.04, 0.1], [0.1, 0.3, 0.6], [0.02, 0.1, 0.3], [0.02, 0.1, 0.4], [30, 60, 150]])

    def bins(self) -> np.ndarray:
        """The index of each shape's bin, texts x 5."""
        return np.stack([np.searchsorted(e, self.shape[:, i]) + 4 * i for i, e in enumerate(self.EDGES)], axis=1)

    def junk_votes(self) -> np.ndarray:
        """Each shape's vote of bad, beyond its bound, or none; and a vote of good where all shapes are far below theirs."""
        hi = np.array([0.05, 0.5, 0.1, 0.25, 120])
        plain = (self.shape < np.array([0.02, 0.2, 0.03, 0.05, 60])).all(axis=1) & (self.count >= 5)
        return np.concatenate([np.where((self.shape > hi) & (self.count >= 5)[:, None], 1, -1), np.where(plain, 0, -1)[:, None]], axis=1)

    def toxic_votes(self, simple: np.ndarray, learned: np.ndarray) -> np.ndarray:
        """Votes of bad where a list's words or prefixes occur twice or more, or none; and a vote of good where none does at all."""
        v = np.stack([self.hits(simple, slice(0, 1)), self.hits(learned, slice(0, 1)), self.hits(learned, slice(1, None))], axis=1)
        return np.concatenate([np.where(v > 1, 1, -1), np.where(v.any(axis=1), -1, 0)[:, None]], axis=1)

    def hits(self, chosen: np.ndarray, kinds: slice) -> np.ndarray:
        """How many words of a text have a chosen feature of these kinds."""
        n = len(self.count)
        hit = np.zeros(len(self.doc), bool)
        for idx in self.index[kinds]:
            hit |= chosen[idx]
        return np.bincount(self.doc[hit], minlength=n)

    def rows(self) -> list[np.ndarray]:
        """Distinct features of each text."""
        key = np.concatenate([*((self.doc << BITS) | i for i in self.index), *((np.arange(len(self.count)) << BITS) | b for b in self.bins().T)])
        key = np.unique(key)
        cuts = np.searchsorted(key >> BITS, np.arange(len(self.count) + 1))
        return [(key[x:y] & ((1 << BITS) - 1)).astype(np.int32) for x, y in zip(cuts, cuts[1:], strict=False)]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each text's distinct features, for each column of weights."""
        n, out = len(self.count), []
        for w in weights:
            keys = [(self.doc[w[i] != 0] << BITS) | i[w[i] != 0] for i in self.index] + [(np.arange(n) << BITS) | b for b in self.bins().T]
            key = np.unique(np.concatenate(keys))
            out.append(np.bincount(key >> BITS, weights=w[key & ((1 << BITS) - 1)], minlength=n))
        return np.stack(out, axis=1)


def em(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of bad for each pattern, accuracies, share of bad) for patterns of votes seen counts times.

    For each labeller, EM estimates how often it votes bad, good or not at all on bad and on good documents, with
    labellers taken as independent given the class; accuracies[k] is the chance that a vote of labeller k is right. What
    a labeller does so seldom that counts say little follows the first guess.
    """
    n, k = votes.shape
    #: chances of the votes none, good, bad on a good document and on a bad one
    guess = np.array([[0.4, 0.55, 0.05], [0.4, 0.1, 0.5]])
    theta = np.tile(guess, (k, 1, 1))
    prior, post = 0.15, np.full(n, 0.15)
    if counts.sum():
        each = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
        for _ in range(rounds):
            like = np.einsum("nkv,kcv->nc", each, np.log(theta))
            odds = np.log(prior / (1 - prior)) + like[:, 1] - like[:, 0]
            post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            by = np.stack([(1 - post) * counts, post * counts], axis=1)
            theta = np.einsum("nc,nkv->kcv", by, each) + 0.5 * guess
            theta /= theta.sum(axis=2, keepdims=True)
            prior = float(np.clip((by[:, 1].sum() + 0.15) / (counts.sum() + 1), 1e-4, 0.5))
    right = (1 - prior) * theta[:, 0, 1] + prior * theta[:, 1, 2]
    wrong = (1 - prior) * theta[:, 0, 2] + prior * theta[:, 1, 1]
    return post, right / (right + wrong), prior


def lexicon(rows: list[np.ndarray], bad: np.ndarray, precision: float = 0.9) -> np.ndarray:
    """Which hashed features occur in bad documents far beyond chance (by likelihood ratio over all features) and seldom elsewhere."""
    size = 1 << BITS
    out = np.zeros(size, bool)
    if not len(rows) or not bad.any() or bad.all():
        return out
    flat, own = np.concatenate(rows), np.repeat(bad, [len(r) for r in rows])
    n, b = np.bincount(flat, minlength=size), np.bincount(flat[own], minlength=size)
    base = bad.mean()
    p = np.clip(b / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    gain = n * (p * np.log(p / base) + (1 - p) * np.log((1 - p) / (1 - base)))
    level = np.log(size) + 3
    out = (p >= precision) & (gain > level)
    out[:DENSE] = False
    # copies of one document speak once: as many supporters that differ as chance would need
    need, marked = int(np.ceil(level / -np.log(base))), np.flatnonzero(own)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[marked]
    marked = flat[marked]
    few = out[marked]
    doc, marked = doc[few], marked[few]
    order = np.argsort(marked, kind="stable")
    doc, marked = doc[order], marked[order]
    alike: dict[tuple[int, int], bool] = {}

    def copies(x: int, y: int) -> bool:
        if (x, y) not in alike:
            both = len(np.intersect1d(rows[x], rows[y], assume_unique=True))
            alike[x, y] = both > 0.5 * (len(rows[x]) + len(rows[y]) - both)
        return alike[x, y]

    ends = np.flatnonzero(np.diff(np.append(marked, -1)))
    for start, end in zip(np.concatenate([[0], ends[:-1] + 1]) if len(ends) else [], ends, strict=True):
        kept: list[int] = []
        for d in doc[start : end + 1].tolist():
            if not any(copies(x, d) for x in kept):
                kept.append(d)
                if len(kept) >= need:
                    break
        out[marked[start]] = len(kept) >= need
    return out


def fit_linear(rows: list[np.ndarray], target: np.ndarray, epochs: int = 6, batch: int = 256, alpha: float = 0.3, l1: float = 1.5, l2: float = 1.0) -> np.ndarray:
    """Weights of a logistic scorer by FTRL-proximal over soft targets; sparse by l1. The last weight is the bias."""
    size = 1 << BITS
    z, s = np.zeros(size + 1), np.zeros(size + 1)
    w = np.zeros(size + 1)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            lens = np.array([len(rows[x]) + 1 for x in own])
            flat = np.concatenate([np.append(rows[x], size) for x in own])
            doc = np.repeat(np.arange(len(own)), lens)
            idx, inv = np.unique(flat, return_inverse=True)
            own_w = w[idx]
            p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, weights=own_w[inv]), -30, 30)))
            g = np.bincount(inv, weights=(p - target[own])[doc])
            sigma = (np.sqrt(s[idx] + g * g) - np.sqrt(s[idx])) / alpha
            z[idx] += g - sigma * own_w
            s[idx] += g * g
            zi = z[idx]
            pen = np.where(idx == size, 0, l1)
            w[idx] = np.where(np.abs(zi) <= pen, 0, -(zi - np.sign(zi) * pen) / ((1 + np.sqrt(s[idx])) / alpha + l2))
    return w


def _labels(labels: DataFrame) -> DataFrame:
    """One row a doc_id: the worse of its labels; 0/1, null where unknown."""
    return C.columns(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg((1 - F.min("quality")).alias("junk"), F.max("toxic").alias("toxic"))


def _texts(docs: DataFrame) -> DataFrame:
    return C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))


def scored(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, reject: float = REJECT) -> DataFrame:
    """doc_id, junk, toxic (scores in 0..1) and keep (both below ``reject``) of every row of docs(doc_id, text).

    1. Up to ``fit_docs`` documents, labelled ones first, give the word and prefix lexicons that mark toxic labels.
    2. Every document gets the votes of all labellers, the human one where labels(doc_id, quality, toxic) has it.
    3. For junk and for toxic, EM over the counts of vote patterns of all documents gives each labeller's accuracies
       and each pattern's posterior; 4. the posteriors of the documents of step 1 train a scorer each, which 5. scores all.

    Null, empty and wordless texts score by their bins alone. A repeated doc_id shares its labels, the worse of them; a
    null doc_id has none but is scored. Without labels the untrained labellers decide. An empty table gives no rows.
    Other columns are ignored. The lexicons and weights (8 bytes a hashed feature) don't grow with the corpus.
    """
    import pyarrow as pa

    spark, key = docs.sparkSession, C.kind(docs, "doc_id")
    docs = _texts(docs)
    known = C.cut(_labels(labels))
    chosen = docs.select("doc_id").where("doc_id is not null").distinct().join(known, "doc_id", "left")
    chosen = C.cut(chosen.orderBy(F.col("toxic").isNull() & F.col("junk").isNull(), F.xxhash64("doc_id"), "doc_id").limit(fit_docs))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in C.steps(texts):
                out = [r.tobytes() for r in Features(texts[i:j]).rows()]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(out, pa.binary())], ["doc_id", "row"])

    # fit_docs rows at most, so broadcast
    own = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").mapInArrow(rows, f"doc_id {key}, row binary")
    fit = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "row", "toxic").toArrow().sort_by("doc_id")
    ids = fit["doc_id"].to_pylist()
    sample = [np.frombuffer(r, np.int32) for r in fit["row"].to_pylist()]
    tox = np.array([-1 if t is None else t for t in fit["toxic"].to_pylist()], np.int64)
    at = np.flatnonzero(tox >= 0)
    insults = np.zeros(1 << BITS, bool)
    insults[(C.Words([" ".join(INSULTS)]).hash >> _SHIFT).astype(np.int64) | DENSE] = True
    found = lexicon([sample[i] for i in at], tox[at] == 1)
    lists = spark.sparkContext.broadcast((insults, found))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        simple, learned = lists.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in C.steps(texts):
                f = Features(texts[i:j])
                v = np.concatenate([f.junk_votes(), f.toxic_votes(simple, learned)], axis=1) + 1
                code = (v @ 3 ** np.arange(v.shape[1])).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(code)], ["doc_id", "code"])

    votes = docs.mapInArrow(vote, f"doc_id {key}, code int").join(known, "doc_id", "left")
    votes = C.cut(votes.select("doc_id", "code", F.coalesce("junk", F.lit(-1)).alias("junk"), F.coalesce("toxic", F.lit(-1)).alias("toxic")))
    seen = votes.groupBy("code", "junk", "toxic").count().toPandas()  # a row a pattern, at most 4,000, whatever the corpus
    spread = (seen["code"].to_numpy(np.int64)[:, None] // 3 ** np.arange(10)) % 3 - 1
    n = seen["count"].to_numpy(float)
    junk = np.concatenate([spread[:, :6], seen[["junk"]].to_numpy(np.int64)], axis=1)
    toxic = np.concatenate([spread[:, 6:], seen[["toxic"]].to_numpy(np.int64)], axis=1)
    post_j, acc_j, _ = em(junk, n)
    post_t, acc_t, _ = em(toxic, n)
    by = {(int(c), int(a), int(b)): (x, y) for c, a, b, x, y in zip(seen["code"], seen["junk"], seen["toxic"], post_j, post_t, strict=True)}
    mine = {r.doc_id: by[(r.code, r.junk, r.toxic)] for r in votes.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").collect()}
    target = np.array([mine[i] for i in ids]).reshape(-1, 2)
    weights = spark.sparkContext.broadcast(np.stack([fit_linear(sample, target[:, c]) for c in (0, 1)]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in C.steps(texts):
                s = 1 / (1 + np.exp(-np.clip(Features(texts[i:j]).scores(w[:, :-1]) + w[:, -1], -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(s[:, 0]), pa.array(s[:, 1]), pa.array((s < reject).all(axis=1))], ["doc_id", "junk", "toxic", "keep"])

    out = docs.mapInArrow(score, f"doc_id {key}, junk double, toxic double, keep boolean")
    out.accuracies = {"junk": dict(zip(JUNK, acc_j.tolist(), strict=True)), "toxic": dict(zip(TOXIC, acc_t.tolist(), strict=True))}
    return out


def accepted(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, reject: float = REJECT) -> DataFrame:
    """docs without the documents of which a row is rejected by :func:`scored`.

    Null, empty and wordless texts are scored as any other; of a repeated doc_id all rows go if one is rejected; rows of
    a null doc_id stay; an empty table gives no rows; all columns stay, whatever their names.
    """
    gone = C.cut(scored(docs, labels, fit_docs, reject).where("not keep and doc_id is not null").select("doc_id").distinct())
    return C.without(docs, "doc_id", gone)
