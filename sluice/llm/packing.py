"""Vector bin packing of examples into training sequences by the dot-product heuristic."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Most tokens, segments and loss-bearing tokens in a pack.
LIMITS = (4096, 16, 3072)
#: Examples packed together; the number of such cells follows the number of examples.
CELL = 2048


def pack(sizes: np.ndarray, limits: tuple[int, ...] = LIMITS) -> np.ndarray:
    """Bin number of each row of sizes(n, d), by the order given for ties.

    One bin is open at a time. Of the rows that fit what is left of it, the one with the largest dot product of its
    size and what is left, both as shares of the limits, goes in; when none fits, the next bin opens. A row over a limit
    by itself has a bin of its own.
    """
    n = len(sizes)
    out = np.full(n, -1, np.int64)
    share = sizes / np.array(limits, np.float64)
    live = np.flatnonzero((sizes <= np.array(limits)).all(axis=1))
    single = np.setdiff1d(np.arange(n), live)
    bins = 0
    own, sh = sizes[live], share[live]
    while len(live):
        left = np.array(limits, np.int64)
        used = np.zeros(len(live), bool)
        fits = np.ones(len(live), bool)
        while fits.any():
            score = np.where(fits, sh @ (left / np.array(limits, np.float64)), -1.0)
            at = int(score.argmax())
            used[at] = True
            out[live[at]] = bins
            left = left - own[at]
            fits = (own <= left).all(axis=1) & ~used
        bins += 1
        live, own, sh = live[~used], own[~used], sh[~used]
    out[single] = bins + np.arange(len(single))
    return out


def packed(examples: DataFrame, key: str, limits: tuple[int, int, int] = LIMITS, cell: int = CELL) -> DataFrame:
    """A row a pack: pack_id, ids (list of ``key``, in packing order), tokens, segments, loss_tokens and oversize.

    examples(key, tokens, segments, loss_tokens) are spread by the hash of their id over cells of about ``cell``, and
    each cell is packed by :func:`pack`, largest token count first; rows of an id that occurs more than ``cell`` times
    are spread over all cells. Null sizes count as 0, and negative ones too; an example over a limit alone is a pack of
    its own with oversize true. Null ids are packed as others are, ids of any type come out as they went in, repeated
    rows each take their room, no examples give no packs, and other columns are ignored.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    kind, names = C.kind(examples, key), ("tokens", "segments", "loss_tokens")
    narrow = C.columns(examples, key, *names).toDF("id", *names)
    narrow = C.cut(narrow.select("id", *(F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0)).alias(c) for c in names)))
    cells = max(1, math.ceil(narrow.count() / cell))
    hot = C.cut(narrow.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > cell).select(F.col("id").alias("hot"), F.lit(True).alias("many")))

    def run(part):  # without hints, which applyInArrow would look up
        sizes = np.stack([part[c].to_numpy() for c in names], axis=1).astype(np.int64)
        ids = part["id"].combine_chunks()
        # ids aren't compared by value where that has no order; equal sizes keep the order of ids where it has
        by_id = np.empty(len(ids), np.int64)
        by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((by_id, -sizes[:, 1], -sizes[:, 2], -sizes[:, 0]))
        bins = pack(sizes[order], limits)
        by_bin = np.argsort(bins, kind="stable")
        first = np.flatnonzero(np.diff(np.concatenate([[-1], bins[by_bin]])))
        total = np.add.reduceat(sizes[order][by_bin], first, axis=0)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(bins)).astype(np.int32)), ids.take(pa.array(order[by_bin])))
        here = int(part["cell"][0].as_py())
        return pa.table({
            "pack_id": [f"{here:08d}-{b:06d}" for b in range(len(first))], "ids": lists, "tokens": total[:, 0], "segments": total[:, 1], "loss_tokens": total[:, 2],
            "oversize": (total > np.array(limits)).any(axis=1),
        })

    spread = narrow.join(C.small_ids(hot), F.col("id").eqNullSafe(F.col("hot")), "left")
    placed = spread.select("id", *names, F.pmod(F.when(F.col("many"), F.floor(F.rand(7) * (1 << 40))).otherwise(F.xxhash64("id")), F.lit(cells)).alias("cell"))
    return placed.groupBy("cell").applyInArrow(run, f"pack_id string, ids array<{kind}>, tokens long, segments long, loss_tokens long, oversize boolean")


def _counted(docs: DataFrame, columns: list[str], vocab: str) -> DataFrame:
    """docs(columns, text) with the number of sub-word ids in place of the text."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = C.encoder(vocab)
        for b in batches:
            n = [len(x) for x in enc.many(b.column(len(columns)).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(columns))), pa.array(n, pa.int64())], [*columns, "tokens"])

    fields = ", ".join(f"`{c}` {C.kind(docs, c)}" for c in columns)
    return C.columns(docs, *columns, "text").withColumn("text", F.col("text").cast("string")).mapInArrow(run, f"{fields}, tokens long")


def conversation_packs(turns: DataFrame, limits: tuple[int, int, int] = LIMITS, vocab: str = C.VOCAB, cell: int = CELL) -> DataFrame:
    """Packs of whole conversations of turns(conv_id, turn, role, text): an example is a conversation, a segment a turn.

    Its loss-bearing tokens are those of role "assistant" (any case). Null and empty texts are turns of no tokens; turns
    of a null conv_id are one example of that id; repeated turns count each time. See :func:`packed`.
    """
    n = _counted(turns, ["conv_id", "role"], vocab)
    mine = F.lower(F.trim(F.col("role"))) == "assistant"
    each = n.groupBy("conv_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("segments"), F.sum(F.when(mine, F.col("tokens")).otherwise(0)).alias("loss_tokens"))
    return packed(each, "conv_id", limits, cell)


def document_packs(docs: DataFrame, limits: tuple[int, int, int], vocab: str = C.VOCAB, cell: int = CELL) -> DataFrame:
    """Packs of docs(doc_id, text), each document one segment of which all tokens bear loss; see :func:`packed`.

    Null and empty texts have no tokens, yet keep their place in a pack, so no document is lost. A document over the
    limit is a pack of its own, marked oversize, for the reader to split.
    """
    n = _counted(docs, ["doc_id"], vocab)
    return packed(n.select("doc_id", "tokens", F.lit(1).alias("segments"), F.col("tokens").alias("loss_tokens")), "doc_id", limits, cell)
