"""Language-model scoring: a causal self-attention model over sub-word ids, trained on the corpus it scores.

The functions in numpy say what is done. Where executors can, :mod:`lmkernel` does it in the JVM, in a fraction of the time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import lmkernel as K

#: Ids in a window; ids that a window shares with the one before; width of the model.
WINDOW, OVERLAP, WIDTH = 32, 8, 16
#: Bands of about this share of the corpus each, of at most so many ids.
BANDS, BAND_IDS = 32, 256
#: Passes over the corpus, each over every id once; rounds of a pass, after each of which the models are averaged.
EPOCHS, ROUNDS = 1, 2
#: Ids that one task trains on in a pass; models that are averaged at once; windows in a step; step size.
GROUP_IDS, FAN, BATCH, RATE = 4_000_000, 64, 128, 0.2
#: Least exponent in a softmax over ids, and largest of either sign in attention.
FLOOR, MOST = np.float32(-20), np.float32(20)
#: Bytes of parameters in a row that is averaged.
CHUNK = 1 << 16


class Vocabulary:
    """What the counts of ids say. Ids that occur are ranked by count; a band holds neighbours in rank, ``lo`` to ``hi``.

    ``rank`` of each id, ``band`` of each rank, log share of each band (``bias``) and of each rank in its band (``inside``).
    """

    def __init__(self, counts: np.ndarray):
        used = np.flatnonzero(counts > 0)
        used = used[np.lexsort((used, -counts[used]))]
        self.size = len(used)
        self.rank = np.full(len(counts), -1, np.int32)
        self.rank[used] = np.arange(len(used))
        p = counts[used] / max(1, counts.sum())
        upto, at = np.cumsum(p), [0]
        while at[-1] < len(used):
            lo = at[-1]
            full = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + 1 / BANDS, side="right"))
            at.append(min(len(used), max(lo + 1, min(full, lo + BAND_IDS))))
        self.lo, self.hi = np.array(at[:-1], np.int64), np.array(at[1:], np.int64)
        self.band = np.repeat(np.arange(len(self.lo)), self.hi - self.lo).astype(np.int16)
        share = np.add.reduceat(p, self.lo) if len(used) else np.zeros(0)
        self.bias = np.log(share).astype(np.float32)
        self.inside = np.log(p / share[self.band]).astype(np.float32)
        self.shapes = {
            "pos": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "o": (WIDTH, WIDTH), "out": (WIDTH + 1, len(self.lo)),
            "emb": (self.size + 1, WIDTH), "inner": (self.size, WIDTH + 1),
        }

    def initial(self) -> np.ndarray:
        """Parameters before training, by which an id has about its share of the corpus. Row 0 of the embedding starts a text.

        The last row of ``out`` and the last column of ``inner`` are added whatever the state.
        """
        rng = np.random.default_rng(11)
        scale = {"emb": 0.3, "inner": 0.0}
        parts = {k: rng.normal(0, 1, s) * scale.get(k, 0.15) for k, s in self.shapes.items()}
        parts["out"][-1], parts["inner"][:, -1] = self.bias, self.inside
        return np.concatenate([p.ravel() for p in parts.values()]).astype(np.float32)

    def unpack(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, s in self.shapes.items():
            n = int(np.prod(s))
            out[k] = flat[at : at + n].reshape(s)
            at += n
        return out


_SCALE = np.float32(WIDTH**-0.5)
_MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_SMALL = ("pos", "qkv", "o", "out")


def attend(m: dict[str, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden states of windows (B, WINDOW) of embedding rows, each place seeing itself and those before it."""
    b = len(rows)
    x = m["emb"].take(rows.ravel(), axis=0)
    x.reshape(b, -1)[...] += m["pos"].ravel()
    qkv = (x @ m["qkv"]).reshape(b, WINDOW, 3 * WIDTH)
    q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH : 2 * WIDTH], qkv[:, :, 2 * WIDTH :]
    a = np.matmul(q, k.transpose(0, 2, 1))
    a *= _SCALE
    np.clip(a, -MOST, MOST, out=a)
    np.exp(a, out=a)
    a *= _MASK
    a /= a.sum(axis=2, keepdims=True)
    mid = np.matmul(a, v).reshape(-1, WIDTH)
    h = mid @ m["o"]
    h += x
    return h, x, q, k, v, a, mid


def _exponential(z: np.ndarray, top: np.ndarray, each: np.ndarray | int, own: np.ndarray) -> np.ndarray:
    """z (rows from ``top`` on, ``each`` long) less its row's largest value, at ``own``; z becomes its exponential.

    What is below e**FLOOR of a row's largest counts as that: sums don't notice, and products of it stay in the range in
    which processors are fast (numbers near the least that a float holds slow them down many times).
    """
    z -= np.repeat(np.maximum.reduceat(z, top), each)
    chosen = z[own]
    np.maximum(z, FLOOR, out=z)
    np.exp(z, out=z)
    return chosen


class Heads:
    """Chances of ranks given their states: of each rank's band, and of it in its band.

    Rows are in the order of bands; those of bands of several ids have a stretch of ``inner`` each, one value an id.
    """

    def __init__(self, m: dict[str, np.ndarray], voc: Vocabulary, h: np.ndarray, ranks: np.ndarray):
        self.m, self.order = m, np.argsort(voc.band[ranks], kind="stable")
        ranks = ranks[self.order]
        self.bands = bands = voc.band[ranks]
        self.h = np.ones((len(ranks), WIDTH + 1), h.dtype)
        self.h[:, :WIDTH] = h[self.order]
        self.outer = self.h @ m["out"]
        wide = self.outer.shape[1]
        self.target = np.arange(len(ranks)) * wide + bands
        logs = _exponential(self.outer.ravel(), np.arange(0, self.outer.size, wide), wide, self.target) if len(ranks) else np.zeros(0, h.dtype)
        self.total = self.outer @ np.ones(wide, h.dtype)
        logs -= np.log(self.total)
        size = (voc.hi - voc.lo)[bands]
        self.several = np.flatnonzero(size > 1)
        self.size = size[self.several]
        end = np.cumsum(self.size)
        self.top = end - self.size
        self.inner = np.empty(int(end[-1]) if len(end) else 0, h.dtype)
        at = [0, *(np.flatnonzero(np.diff(bands)) + 1).tolist(), len(bands)] if len(bands) else [0]
        #: of each band of several ids that occurs: its rows, first rank and the one behind its last, place of its values
        self.parts, place = [], 0
        for i, j in zip(at, at[1:], strict=False):
            lo, hi = int(voc.lo[bands[i]]), int(voc.hi[bands[i]])
            if hi - lo > 1:
                to = place + (j - i) * (hi - lo)
                self.parts.append((i, j, lo, hi, place, to))
                np.matmul(self.h[i:j], m["inner"][lo:hi].T, out=self.inner[place:to].reshape(j - i, hi - lo))
                place = to
        if len(self.size):
            self.chosen = self.top + ranks[self.several] - voc.lo[bands[self.several]]
            got = _exponential(self.inner, self.top, self.size, self.chosen)
            self.within = np.add.reduceat(self.inner, self.top)
            logs[self.several] += got - np.log(self.within)
        self.logs = logs

    def backward(self) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """Gradients of the mean negative log chance: of the states (in the order of rows), of ``out``, of ``inner`` by run of bands."""
        z, n = self.outer, np.float32(1 / max(1, len(self.target)))
        z *= (n / self.total)[:, None]
        z.ravel()[self.target] -= n
        dh = z @ self.m["out"].T
        out, runs = self.h.T @ z, []
        if self.parts:
            z = self.inner
            z *= np.repeat(n / self.within, self.size)
            z[self.chosen] -= n
            g = np.empty((sum(hi - lo for _, _, lo, hi, _, _ in self.parts), WIDTH + 1), z.dtype)
            at = 0
            for i, j, lo, hi, a, b in self.parts:
                own = z[a:b].reshape(j - i, hi - lo)
                np.matmul(own.T, self.h[i:j], out=g[at : at + hi - lo])
                dh[i:j] += own @ self.m["inner"][lo:hi]
                if runs and runs[-1][1] == lo:
                    runs[-1] = (runs[-1][0], hi, runs[-1][2])
                else:
                    runs.append((lo, hi, at))
                at += hi - lo
            runs = [(lo, hi, g[x : x + hi - lo]) for lo, hi, x in runs]
        return dh[:, :WIDTH], out, runs


def chances(m: dict[str, np.ndarray], voc: Vocabulary, h: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Log chance of each rank given its hidden state."""
    heads = Heads(m, voc, h, ranks)
    out = np.empty(len(ranks), h.dtype)
    out[heads.order] = heads.logs
    return out


def gradient(m: dict[str, np.ndarray], voc: Vocabulary, rows: np.ndarray, ranks: np.ndarray, real: np.ndarray):
    """(mean negative log chance of the real ranks, its gradient by small parameter, that by place of the embedding's rows, that of ``inner`` by run)."""
    h, x, q, k, v, a, mid = attend(m, rows)
    shape, use = (len(rows), WINDOW, WIDTH), np.flatnonzero(real.ravel())
    heads = Heads(m, voc, h[use], ranks.ravel()[use])
    loss = -float(heads.logs.mean()) if len(use) else 0.0
    dhu, out, inner = heads.backward()
    dh = np.zeros(h.shape, h.dtype)
    dh[use[heads.order]] = dhu
    g = {"out": out, "o": mid.T @ dh}
    dmid = (dh @ m["o"].T).reshape(shape)
    ds = np.matmul(dmid, v.transpose(0, 2, 1))
    ds *= a
    ds -= a * ds.sum(axis=2, keepdims=True)
    ds *= _SCALE
    d = np.empty((len(rows), WINDOW, 3 * WIDTH), h.dtype)
    d[:, :, :WIDTH], d[:, :, WIDTH : 2 * WIDTH], d[:, :, 2 * WIDTH :] = np.matmul(ds, k), np.matmul(ds.transpose(0, 2, 1), q), np.matmul(a.transpose(0, 2, 1), dmid)
    d = d.reshape(-1, 3 * WIDTH)
    g["qkv"] = x.T @ d
    dx = dh
    dx += d @ m["qkv"].T
    g["pos"] = dx.reshape(shape).sum(axis=0)
    return loss, g, dx, inner


def windows(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first place, first place scored) of the windows that score each id of texts with these numbers of ids once."""
    step = WINDOW - OVERLAP
    n = np.where(lens > 0, 1 + np.maximum(0, -(-(lens - WINDOW) // step)), 0)
    text = np.repeat(np.arange(len(lens)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, nth * step, np.where(nth > 0, nth * step + OVERLAP, 0)


def _inputs(ids: list[np.ndarray], voc: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embedding rows seen, ranks, first place of each text) of texts one after another, with room for a window behind."""
    lens = np.array([len(x) for x in ids], np.int64)
    ranks = np.concatenate([voc.rank[np.concatenate(ids)] if len(ids) else np.zeros(0, np.int32), np.zeros(WINDOW, np.int32)])
    rows = np.zeros(len(ranks), np.int32)
    rows[1:] = ranks[:-1] + 1
    at = np.cumsum(lens) - lens
    rows[at[lens > 0]] = 0
    return rows, ranks, at


def scores(m: dict[str, np.ndarray], ids: list[np.ndarray], voc: Vocabulary, batch: int = 128) -> np.ndarray:
    """Sum of the log chances of each text's ids."""
    lens = np.array([len(x) for x in ids], np.int64)
    rows, ranks, at = _inputs(ids, voc)
    text, first, scored = windows(lens)
    out, offsets = np.zeros(len(ids)), np.arange(WINDOW)
    for i in range(0, len(text), batch):
        t, f, s = text[i : i + batch], first[i : i + batch], scored[i : i + batch]
        take = (at[t] + f)[:, None] + offsets
        use = np.flatnonzero(((offsets >= (s - f)[:, None]) & (offsets < (lens[t] - f)[:, None])).ravel())
        h = attend(m, rows[take])[0][use]
        out += np.bincount(np.repeat(t, WINDOW)[use], weights=chances(m, voc, h, ranks[take.ravel()[use]]), minlength=len(ids))
    return out


def training(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first place) of the windows, one behind another, that hold each id of texts with these numbers of ids once."""
    n = -(-lens // WINDOW)
    text = np.repeat(np.arange(len(lens)), n)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW


def mixed_order(n: int, seed: int) -> np.ndarray:
    """The order of n windows by a hash of their number and the seed, as lmkernel has it."""
    return np.argsort(C.mix(np.arange(n, dtype=np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(32), kind="stable")


def train_pass(flat: np.ndarray, ids: list[np.ndarray], voc: Vocabulary, seed: int, order: Callable[[int, int], np.ndarray] | None = None) -> tuple[np.ndarray, int]:
    """(parameters after Adagrad over every window of each text, in a mixed order, numpy's own if none is given; ids trained on)."""
    flat = flat.copy()
    m, sq = voc.unpack(flat), voc.unpack(np.full(len(flat), 1e-3, np.float32))
    lens = np.array([len(x) for x in ids], np.int64)
    rows, ranks, at = _inputs(ids, voc)
    text, first = training(lens)
    mixed = order(len(text), seed) if order else np.random.default_rng(seed).permutation(len(text))
    offsets, seen = np.arange(WINDOW), 0

    def learn(value: np.ndarray, total: np.ndarray, g: np.ndarray) -> None:
        total += g * g
        value -= RATE * g / np.sqrt(total)

    for i in range(0, len(mixed), BATCH):
        t, f = text[mixed[i : i + BATCH]], first[mixed[i : i + BATCH]]
        take, real = (at[t] + f)[:, None] + offsets, offsets < (lens[t] - f)[:, None]
        own = np.where(real, rows[take], 0)
        _, g, dx, inner = gradient(m, voc, own, ranks[take], real)
        for k in _SMALL:
            learn(m[k], sq[k], g[k])
        for lo, hi, own_g in inner:
            learn(m["inner"][lo:hi], sq["inner"][lo:hi], own_g)
        # rows that no window holds have no gradient, and Adagrad leaves them as they are
        place = np.flatnonzero(real.ravel())
        place = place[np.argsort(own.ravel()[place], kind="stable")]
        row = own.ravel()[place]
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        part, held = np.add.reduceat(dx[place], start, axis=0), row[start]
        total = sq["emb"][held] + part * part
        sq["emb"][held] = total
        m["emb"][held] -= RATE * part / np.sqrt(total)
        seen += len(place)
    return flat, seen


def _ids(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _in_jvm(spark) -> bool:
    return K.ready(spark, {"WINDOW": WINDOW, "OVERLAP": OVERLAP, "WIDTH": WIDTH, "FLOOR": FLOOR, "MOST": MOST, "SCALE": _SCALE, "RATE": RATE})


def trained(coded: DataFrame, voc: Vocabulary, total: int, dtype, epochs: int, group_ids: int = GROUP_IDS) -> np.ndarray:
    """Parameters trained on every id of coded(h, ids) once an epoch.

    Rows fall by their hash into groups of about ``group_ids`` ids and into rounds. In a round, each group goes on from the
    shared parameters, over its rows in the order of their hash, and the results are averaged by ids trained on, FAN at a
    time. So what comes out doesn't depend on how the rows are partitioned.
    """
    import pyarrow as pa

    spark, flat = coded.sparkSession, voc.initial()
    groups = max(1, -(-total // group_ids))
    shared_voc, fields = spark.sparkContext.broadcast(voc), "grp long, part int, n long, raw binary"
    placed = coded.select(F.pmod("h", F.lit(groups)).alias("grp"), F.pmod(F.shiftright("h", 40), F.lit(ROUNDS)).alias("round"), "h", "ids")

    def rows(grp: int, n: int, out: np.ndarray) -> pa.Table:
        raw = out.astype(np.float32).tobytes()
        parts = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)] if n else []
        return pa.table({"grp": pa.array([grp] * len(parts), pa.int64()), "part": pa.array(range(len(parts)), pa.int32()), "n": pa.array([n] * len(parts), pa.int64()), "raw": pa.array(parts, pa.binary())})

    # what applyInArrow takes has one argument and no hints
    def learner(now, seed: int):
        def learn(t):
            t = t.sort_by([("h", "ascending"), ("ids", "ascending")])
            out, n = train_pass(now.value, _ids(t["ids"], dtype), shared_voc.value, seed, mixed_order)
            return rows(t["grp"][0].as_py(), n, out)

        return learn

    def average(t):
        t, total, n = t.sort_by("grp"), 0.0, 0
        for w, raw in zip(t["n"].to_pylist(), t["raw"].to_pylist(), strict=True):
            total, n = total + np.frombuffer(raw, np.float32).astype(np.float64) * w, n + w
        return pa.table({"grp": pa.array([t["to"][0].as_py()], pa.int64()), "part": t["part"].slice(0, 1), "n": pa.array([n], pa.int64()), "raw": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

    for seed in range(epochs * ROUNDS):
        # more partitions than groups, so that few tasks get several
        by_group = placed.where(F.col("round") == seed % ROUNDS).repartition(4 * groups, "grp").groupBy("grp")
        if _in_jvm(spark):
            learn = K.function(spark, K.pack(flat, voc, dtype.itemsize), BATCH, CHUNK, "array<binary>")
            own = by_group.agg(F.expr(f"sum(length(ids)) div {dtype.itemsize}").alias("n"), F.array_sort(F.collect_list(F.struct("h", "ids"))).alias("own"))
            models = own.select("grp", F.expr(f"posexplode({learn}(own.ids, {seed}L))").alias("part", "raw"), "n").select("grp", "part", "n", "raw")
        else:
            models = by_group.applyInArrow(learner(spark.sparkContext.broadcast(flat), seed), fields)
        left = groups
        while left > 1:
            models = models.withColumn("to", F.expr(f"grp div {FAN}")).groupBy("to", "part").applyInArrow(average, fields)
            left = -(-left // FAN)
        if got := sorted(models.select("part", "raw").collect(), key=lambda r: r.part):  # the parameters, once
            flat = np.frombuffer(b"".join(bytes(r.raw) for r in got), np.float32)
    return flat


def scored(docs: DataFrame, vocab: str = C.VOCAB, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, n_tokens, logprob (sum of natural logs) and perplexity of every row of docs(doc_id, text).

    The ids of all texts are counted, and those that occur are ranked and split into bands. A causal self-attention model
    is trained on every id of every text once an epoch (:func:`trained`) to tell the band of the next id, and the id in
    its band, both from the state of attention. Then windows of WINDOW ids, which share OVERLAP ids with the one before,
    score each id once, given the ids before it in its window. Null and empty texts have n_tokens 0, logprob 0 and a null
    perplexity; a null doc_id stays null; repeated rows are trained on and scored each; an empty table gives no rows;
    other columns are ignored. Ids are written once to the shared folder; training shuffles ids, no text.
    """
    import pyarrow as pa

    spark, key = docs.sparkSession, C.kind(docs, "doc_id")
    size, dtype = C.encoder(vocab).size, C.encoder(vocab).dtype

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = C.encoder(vocab)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in enc.many(b.column(1).to_pylist())], pa.binary())], ["doc_id", "ids"])

    texts = C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    coded = C.cut(texts.mapInArrow(encode, f"doc_id {key}, ids binary").withColumn("h", F.xxhash64("doc_id", "ids")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            for i, j in C.steps(raw := b.column(0).to_pylist()):
                n += np.bincount(np.frombuffer(b"".join(raw[i:j]), dtype), minlength=size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["id", "n"])

    seen = coded.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size)
    counts[seen["id"]] = seen["n"]
    voc = Vocabulary(counts)
    flat = trained(coded.where(F.length("ids") > 0), voc, int(counts.sum()), dtype, epochs) if voc.size else voc.initial()
    if _in_jvm(spark):
        score = K.function(spark, K.pack(flat, voc, dtype.itemsize), BATCH, CHUNK, "double")
        own = coded.selectExpr("doc_id", f"length(ids) div {dtype.itemsize} as n_tokens", f"{score}(ids, 0L) as logprob")
        return own.selectExpr("*", "if(n_tokens > 0, exp(least(-logprob / n_tokens, 700D)), null) as perplexity")
    shared_voc, final = spark.sparkContext.broadcast(voc), spark.sparkContext.broadcast(flat)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared_voc.value
        m = v.unpack(final.value)
        for b in batches:
            ids = _ids(b.column(1), dtype)
            for i, j in C.steps(ids, 1 << 18):
                s = scores(m, ids[i:j], v)
                n = np.array([len(x) for x in ids[i:j]], np.int64)
                ppl = np.exp(np.minimum(-s / np.maximum(n, 1), 700))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n), pa.array(s), pa.array(ppl, mask=n == 0)], ["doc_id", "n_tokens", "logprob", "perplexity"])

    return coded.select("doc_id", "ids").mapInArrow(score, f"doc_id {key}, n_tokens long, logprob double, perplexity double")
