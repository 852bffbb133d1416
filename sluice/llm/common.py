"""Shared pieces: table access, durable cuts of lineage, vectorised word hashing, cached sub-word encoding."""

from __future__ import annotations

import base64
import re
import tempfile
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Default vocabulary (ranks of a public byte-level BPE); always a parameter of the operators.
VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Largest id set, in rows, that is broadcast (about 16 bytes a row); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
#: Rows of one key from which a join takes care of it by itself.
HOT = 100_000
#: Characters of text that one vectorised step takes at once; its arrays fit a core's cache.
STEP_CHARS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); one of our own only where none is set and Spark runs in this process, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="sluice-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it again: later work doesn't depend on executors that may go.

    The table is deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/sluice-{uuid.uuid4().hex}"
    df.write.parquet(path)
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(file)
    return spark.read.schema(df.schema).parquet(path)


def small_ids(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """ids (already cut) marked for broadcast if there are at most ``limit`` rows, else left to a shuffled join."""
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def by_key(rows: DataFrame, heads: DataFrame, key: str) -> DataFrame:
    """rows joined with heads(key, n and more; already cut), which has one row a key, n the number of rows with it.

    A key of more than HOT rows meets them where they are, by broadcast (there are rows/HOT such keys at most, and their
    number is checked), so no task gets all rows of a key; the others are shuffled. n is left out.
    """
    hot = cut(heads.where(F.col("n") > HOT))
    if hot.isEmpty():
        return rows.join(heads.drop("n"), key)
    rest = rows.join(small_ids(hot.select(key)), key, "left_anti").join(heads.where(F.col("n") <= HOT).drop("n"), key)
    return rows.join(small_ids(hot).drop("n"), key).unionByName(rest)


def kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def plain(df: DataFrame) -> DataFrame:
    """df with its columns named c0, c1 and so on, whatever their names are."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def columns(df: DataFrame, *names: str) -> DataFrame:
    """These columns of df, told from others by their exact names."""
    p = plain(df)
    return p.select(*(F.col(f"c{df.columns.index(n)}").alias(n) for n in names))


def without(df: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """df without the rows whose ``key`` is in gone (one column, already cut); all columns as they were."""
    return plain(df).join(small_ids(gone.toDF("gone")), F.col(f"c{df.columns.index(key)}") == F.col("gone"), "left_anti").toDF(*df.columns)


def steps(texts: list[str], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, at least one text each."""
    i = total = 0
    for j, t in enumerate(texts):
        if j > i and total + len(t) > limit:
            yield i, j
            i, total = j, 0
        total += len(t)
    if i < len(texts):
        yield i, len(texts)


# ---- hashing -------------------------------------------------------------------------------------------------------

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_pow: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, in place of weak low bits of sums and products."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_code = np.arange(256)
#: Bytes of words: ASCII letters and digits, and whatever isn't ASCII.
WORD = ((_code >= 48) & (_code < 58)) | ((_code >= 65) & (_code < 91)) | ((_code >= 97) & (_code < 123)) | (_code >= 128)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _pow or len(_pow[0]) < n:
        m = max(n, STEP_CHARS * 2)
        _pow[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, p, np.uint64)])) for p in (np.uint64(_P), np.uint64(_PINV))]
    return _pow[0], _pow[1]


class Words:
    """Words of texts, lower-cased: ``hash`` of each, ``at[i]:at[i+1]`` those of text i, byte ranges in ``buf``."""

    __slots__ = ("_sum", "at", "buf", "end", "hash", "start")

    def __init__(self, texts: list[str]):
        raw = [t.lower().encode("utf-8", "replace") for t in texts]
        self.buf = a = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], WORD[a]]).view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        up, _ = _powers(len(a) + 1)
        self._sum = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(BYTES[a] * up[: len(a)], out=self._sum[1:])
        self.hash = self.span(self.start, self.end)
        first = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]) if raw else np.zeros(1, np.int64)
        self.at = np.searchsorted(self.start, first)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes in each range."""
        return mix((self._sum[end] - self._sum[start]) * _powers(len(self.buf) + 1)[1][start])

    def prefixes(self, n: int) -> np.ndarray:
        """Hash of the first n bytes of each word."""
        return self.span(self.start, np.minimum(self.end, self.start + n)) ^ np.uint64(n)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words in a row; of all the words if there are fewer."""
    n = max(1, min(n, len(words)))
    if not len(words):
        return words
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_P) + words[i : len(words) - n + 1 + i]
    return mix(out)


def list_column(parts: list[np.ndarray], dtype) -> object:
    """An Arrow list column of one array a row."""
    import pyarrow as pa

    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(dtype, copy=False)))


# ---- sub-word ids --------------------------------------------------------------------------------------------------

#: The vocabulary's own split, by way of ``re``; equal to it on texts that _UNUSUAL doesn't match.
_USUAL = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNUSUAL = re.compile("[^\t\n\r -~¡«¬»¿À-ɏ–—‘’“”„…€]")
#: Of bytes that begin a character of usual texts: 0 end of text, 1 white space, 2 letter, 3 digit, 4 other; 9 within one.
_KIND = np.full(256, 4, np.uint8)
_KIND[0], _KIND[[9, 10, 13, 32]], _KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[0xC3:0xCA], _KIND[0x80:0xC0] = 0, 1, 3, 2, 2, 2, 9
_ENDS1 = np.isin(np.arange(256), np.frombuffer(b"sdmt", np.uint8))
_EXACT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder(dict):
    """Text to little-endian uint16/uint32 ids by a byte-level BPE, with a bounded memory of pieces already encoded.

    A piece's ids don't depend on its neighbours, so remembering them changes nothing but the time.
    """

    KEEP = 300_000

    def __init__(self, path: str = VOCAB):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._code = "H" if self.size <= 1 << 16 else "I"
        self._whole = tiktoken.Encoding("own", pat_str=_EXACT, mergeable_ranks=ranks, special_tokens={})
        self._piece = self._whole._core_bpe.encode_single_piece
        self.by_key: dict[int, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.KEEP:
            self.clear()
        self[piece] = out = array(self._code, self._piece(piece.encode())).tobytes()
        return out

    def raw(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _UNUSUAL.search(text):
            return np.array(self._whole.encode_ordinary(text), self.dtype).tobytes()
        return b"".join(map(self.__getitem__, _USUAL.findall(text)))

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.raw(text), self.dtype)

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, as :meth:`ids` has them; usual texts are split and put together some hundred thousand characters at a time."""
        out = [np.zeros(0, self.dtype)] * len(texts)
        usual = []
        for i, t in enumerate(texts):
            if t:
                if _UNUSUAL.search(t) or "\xd7" in t or "\xf7" in t:
                    out[i] = self.ids(t)
                else:
                    usual.append(i)
        for i, j in steps([texts[k] for k in usual], 4 * STEP_CHARS):
            for k, ids in zip(usual[i:j], self._together([texts[k].encode() for k in usual[i:j]]), strict=True):
                out[k] = ids
        return out

    def _together(self, raw: list[bytes]) -> list[np.ndarray]:
        a = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        kind = _KIND[a]
        rest = np.flatnonzero(kind == 9)  # bytes within a character are what its first is
        for _ in range(2):
            kind[rest] = kind[rest - 1]
        begin = np.ones(len(a) + 1, bool)
        begin[1:-1] = kind[1:] != kind[:-1]
        run = np.flatnonzero(begin)
        start, end = run[:-1], run[1:]
        # the last white space before something goes with it if it is a blank, and by itself if it isn't
        space = np.flatnonzero((kind[start] == 1) & (kind[np.minimum(end, len(a) - 1)] != 0))
        last = end[space] - 1
        begin[last] = True
        begin[end[space][a[last] == 32]] = False
        # a quote that begins a piece takes s, d, m, t, ll, ve or re with it
        quote = np.flatnonzero((a[:-2] == 39) & begin[:-3] & begin[1:-2] & (kind[1:-1] == 2)) if len(a) > 2 else np.zeros(0, np.int64)
        if len(quote):
            one, two = a[quote + 1], a[quote + 2]
            taken = np.where(_ENDS1[one], 1, np.where(((one == 108) & (two == 108)) | (((one == 118) | (one == 114)) & (two == 101)), 2, 0))
            quote, taken = quote[taken > 0], taken[taken > 0]
            begin[quote + 1], begin[quote + 1 + taken] = False, True
        at = np.flatnonzero(begin)
        start, end = at[:-1], at[1:]
        own = kind[start] != 0
        start, end = start[own], end[own]
        up, down = _powers(len(a) + 1)
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(BYTES[a] * up[: len(a)], out=total[1:])
        key, first, which = np.unique(mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), return_index=True, return_inverse=True)
        if len(self.by_key) > self.KEEP:
            self.by_key.clear()
        known, found = self.by_key, []
        for k, i in zip(key.tolist(), first.tolist(), strict=True):
            ids = known.get(k)
            if ids is None:
                known[k] = ids = array(self._code, self._piece(a[start[i] : end[i]].tobytes())).tobytes()
            found.append(ids)
        size = np.array([len(x) for x in found], np.int64) // self.dtype.itemsize
        flat, n = np.frombuffer(b"".join(found), self.dtype), size[which]
        to = np.cumsum(n)
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - (to - n), n) + np.arange(to[-1])]
        ends = np.cumsum([len(r) + 1 for r in raw])
        cuts = to[np.searchsorted(start, ends) - 1]
        return np.split(ids, cuts[:-1])


_encoders: dict[str, Encoder] = {}


def encoder(path: str = VOCAB) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
