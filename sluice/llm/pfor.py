"""Token ids as binary: patched frame-of-reference blocks with exception lists and an index of block starts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Ids in a block; share of a block's ids that its width must hold.
BLOCK, SHARE = 128, 0.9
#: min uint32, width uint8, exceptions uint8, ids uint16
HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("out", "u1"), ("n", "<u2")])


def encode(ids: list[np.ndarray], block: int = BLOCK, share: float = SHARE) -> list[tuple[bytes, np.ndarray]]:
    """(payload, byte offset of each block) of each array of ids below 2**32.

    A block: head, ids less the minimum packed at ``width`` bits (the least width that holds ``share`` of them), then the
    exceptions' places (uint8) and their whole differences (uint32). No ids: empty payload, no block.
    """
    assert 8 <= block <= 256 and block % 8 == 0
    lens = np.array([len(x) for x in ids], np.int64)
    per = -(-lens // block)
    total = int(per.sum())
    if not total:
        return [(b"", np.zeros(0, np.int32)) for _ in ids]
    flat = np.concatenate(ids).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(per)])
    doc = np.repeat(np.arange(len(ids)), per)
    nth = np.arange(total) - first[doc]
    n = np.minimum(block, lens[doc] - nth * block)
    slot = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(first[:-1] * block, lens)
    grid = np.zeros(total * block, np.int64)
    grid[slot] = flat
    grid = grid.reshape(total, block)
    real = np.arange(block) < n[:, None]
    least = np.where(real, grid, np.int64(1) << 40).min(axis=1)
    grid = np.where(real, grid - least[:, None], 0)
    ranked = np.sort(np.where(real, grid, np.int64(1) << 40), axis=1)
    held = ranked[np.arange(total), np.maximum(np.ceil(n * share).astype(np.int64) - 1, 0)]
    width = np.where(held > 0, np.frexp(held.astype(np.float64))[1], 0)
    over = real & (grid >= (np.int64(1) << width)[:, None])
    outs = over.sum(axis=1)
    head = np.zeros(total, HEAD)
    head["least"], head["width"], head["out"], head["n"] = least, width, outs, n
    packed = -(-n * width // 8)
    size = HEAD.itemsize + packed + outs * 5
    start = np.concatenate([[0], np.cumsum(size)])
    buf = np.zeros(int(start[-1]), np.uint8)
    buf[start[:-1, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(total, -1)
    body = start[:-1] + HEAD.itemsize
    for w in np.unique(width):
        if not w:
            continue
        own = np.flatnonzero(width == w)
        low = (grid[own] & ((np.int64(1) << w) - 1)).astype("<u4")
        bits = np.unpackbits(low.view(np.uint8).reshape(len(own), block, 4), axis=2, bitorder="little")[:, :, :w]
        rows = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
        keep = np.arange(rows.shape[1]) < packed[own][:, None]
        at = body[own][:, None] + np.arange(rows.shape[1])
        buf[at[keep]] = rows[keep]
    b, place = np.nonzero(over)
    if len(b):
        k = np.arange(len(b)) - np.repeat(np.cumsum(outs) - outs, outs)
        tail = body + packed
        buf[tail[b] + k] = place
        value = grid[b, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        buf[(tail[b] + outs[b] + 4 * k)[:, None] + np.arange(4)] = value
    whole = buf.tobytes()
    ends = start[first]
    return [(whole[ends[i] : ends[i + 1]], (start[first[i] : first[i + 1]] - ends[i]).astype(np.int32)) for i in range(len(ids))]


def decode_block(payload: bytes, at: int) -> np.ndarray:
    """The ids of the one block that starts at byte ``at``."""
    h = np.frombuffer(payload, HEAD, 1, at)[0]
    n, w, outs, at = int(h["n"]), int(h["width"]), int(h["out"]), at + HEAD.itemsize
    size = -(-n * w // 8)
    ids = np.zeros(n, np.int64)
    if w:
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, size, at), bitorder="little")[: n * w].reshape(n, w)
        ids = bits.astype(np.int64) @ (np.int64(1) << np.arange(w))
    if outs:
        where = np.frombuffer(payload, np.uint8, outs, at + size)
        ids[where] = np.frombuffer(payload, "<u4", outs, at + size + outs)
    return ids + int(h["least"])


def decode(payload: bytes, starts: np.ndarray) -> np.ndarray:
    return np.concatenate([decode_block(payload, int(x)) for x in starts]) if len(starts) else np.zeros(0, np.int64)


def token_blocks(docs: DataFrame, vocab: str = C.VOCAB, block: int = BLOCK, share: float = SHARE) -> DataFrame:
    """doc_id, n_tokens, payload (binary) and starts (array of int, one byte offset a block) of every row of docs(doc_id, text).

    Null and empty texts give n_tokens 0, an empty payload and no starts; a null doc_id stays null; repeated rows give
    repeated equal rows; other columns are ignored. ``vocab`` is a file of BPE ranks that all executors can read. One
    narrow pass without a shuffle: whole texts, encoded some hundred thousand characters at a time.
    """
    import pyarrow as pa

    key = C.kind(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = C.encoder(vocab)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in C.steps(texts):
                ids = enc.many(texts[i:j])
                coded = encode(ids, block, share)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(x) for x in ids], pa.int64()), pa.array([p for p, _ in coded], pa.binary()), C.list_column([s for _, s in coded], np.int32)],
                    ["doc_id", "n_tokens", "payload", "starts"],
                )

    return C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")).mapInArrow(run, f"doc_id {key}, n_tokens long, payload binary, starts array<int>")
