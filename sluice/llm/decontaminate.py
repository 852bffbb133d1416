"""Benchmark decontamination: pigeonhole pieces find candidates, Myers' bit-parallel distance verifies them."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Edits allowed for each character of an item (rounded down).
ERROR_RATE = 0.05
#: Characters of normalised items in one automaton (which takes about a hundred times that); more items, more automata.
SCAN_CHARS = 2_000_000
#: Characters of items that a pass over the documents takes, and of texts that a task holds to try several automata on.
PASS_CHARS, HELD_CHARS = 32_000_000, 16_000_000
_WORD = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    """Words in lower case with a space before, between and after; "" without words."""
    w = _WORD.findall((text or "").lower())
    return f" {' '.join(w)} " if w else ""


def pieces(item: str, rate: float = ERROR_RATE) -> tuple[int, list[tuple[int, str]]]:
    """The error budget k of an item and its k + 1 pieces, each with its place."""
    k = int(len(item) * rate)
    at = [len(item) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(at, at[1:], strict=False)]


class Pattern:
    """An item ready for Myers' algorithm: least edit distance of the whole item to any part of a text, and where that part ends."""

    def __init__(self, item: str):
        self.item, self.n = item, len(item)
        self.eq: dict[str, int] = {}
        for i, c in enumerate(item):
            self.eq[c] = self.eq.get(c, 0) | 1 << i

    def within(self, text: str, k: int) -> tuple[int, int] | None:
        """(distance, end) of the best place, the first of equals; None beyond k."""
        top, full, get = 1 << self.n - 1, (1 << self.n) - 1, self.eq.get
        pv, mv, score, best, end = full, 0, self.n, k + 1, -1
        left = len(text)
        for j, c in enumerate(text):
            eq = get(c, 0)
            xv = eq | mv
            xh = ((eq & pv) + pv ^ pv) | eq
            ph, mh = mv | ~(xh | pv) & full, pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            if score < best:
                best, end = score, j + 1
                if not best:
                    break
            left -= 1
            if score - left >= best:  # each later character saves one at most
                break
            ph, mh = ph << 1, mh << 1
            pv, mv = (mh | ~(xv | ph)) & full, ph & xv
        return (best, end) if best <= k else None


class Index:
    """Automaton over the pieces of items, and the search of one text."""

    def __init__(self, items: list[tuple[object, str]], rate: float = ERROR_RATE):
        import ahocorasick

        self.items = [(i, t, int(len(t) * rate)) for i, t in items]
        self.patterns: dict[int, Pattern] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for x, (_, t, _k) in enumerate(self.items):
            for at, piece in pieces(t, rate)[1]:
                owners.setdefault(piece, []).append((x, at))
        self.auto = ahocorasick.Automaton()
        for piece, own in owners.items():
            self.auto.add_word(piece, (len(piece), own))
        self.auto.make_automaton()

    def search(self, text: str) -> list[tuple[object, int, int]]:
        """(item, distance, end in the normalised text) of every item within its budget: its best place, the first of equals."""
        if not self.items:
            return []
        places: dict[int, set[int]] = {}
        for end, (n, own) in self.auto.iter(text):
            for x, at in own:
                places.setdefault(x, set()).add(end + 1 - n - at)
        out = []
        for x, starts in places.items():
            name, item, k = self.items[x]
            best = None
            exact = [s for s in starts if s >= 0 and text.startswith(item, s)]
            if exact:
                best = (0, min(exact) + len(item))
            else:
                if x not in self.patterns:
                    self.patterns[x] = Pattern(item)
                low = high = None
                for s in [*sorted(starts), None]:
                    if low is not None and (s is None or s - k > high):
                        if (hit := self.patterns[x].within(text[low:high], k)) and (best is None or hit[0] < best[0]):
                            best = (hit[0], low + hit[1])
                        low = None
                    if s is not None:
                        low, high = (max(0, s - k), high) if low is None else (low, high)
                        high = s + len(item) + k
            if best:
                out.append((name, *best))
        return out


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance and end_char for every document and item of which a part of the text is within the item's budget.

    Items and texts are compared as lower-cased words with single spaces, an item at word boundaries. The budget is
    ``rate`` edits a character of the item, rounded down; every part of a text that lies within it holds one of the
    budget-plus-one pieces unchanged, so none is missed. distance is the least over the text; end_char is where the
    first such part ends in the normalised text. Null, empty and wordless texts and items match nothing. Repeated rows
    of docs give repeated matches, and equal rows of benchmark count once; null ids stay null, ids may be of any type;
    an empty table on either side gives no rows; other columns are ignored. Items are read on the driver in slices of
    SCAN_CHARS characters, one automaton each; a scan of the documents takes the slices of PASS_CHARS characters, so
    neither an automaton nor what is broadcast grows with the benchmark.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    docs = C.columns(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    items = C.columns(benchmark, "item_id", "text").withColumn("text", F.col("text").cast("string"))
    key, item_key = C.kind(docs, "doc_id"), C.kind(items, "item_id")
    id_type = to_arrow_type(items.schema["item_id"].dataType)

    def scan(slices: list[list]) -> DataFrame:
        shared = spark.sparkContext.broadcast(slices)

        def found(index: Index, ids: list, texts: list[str]) -> pa.RecordBatch:
            at, hits = [], []
            for i, t in enumerate(texts):
                for hit in index.search(t):
                    at.append(i)
                    hits.append(hit)
            cols = [pa.concat_arrays(ids).take(pa.array(at, pa.int64())), pa.array([x[0] for x in hits], id_type), pa.array([x[1] for x in hits], pa.int32()), pa.array([x[2] for x in hits], pa.int64())]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "distance", "end_char"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one = Index(shared.value[0], rate) if len(shared.value) == 1 else None
            ids, texts, size = [], [], 0

            def all_slices() -> Iterator[pa.RecordBatch]:
                for own in shared.value:
                    yield found(one or Index(own, rate), ids, texts)

            for b in batches:
                ids.append(b.column(0))
                new = [normalise(t) for t in b.column(1).to_pylist()]
                texts += new
                size += sum(map(len, new))
                if one or size >= HELD_CHARS:
                    yield from all_slices()
                    ids, texts, size = [], [], 0
            if ids:
                yield from all_slices()

        return docs.mapInArrow(run, f"doc_id {key}, item_id {item_key}, distance int, end_char long")

    out, slices, own, size, total = None, [], [], 0, 0
    for r in items.distinct().orderBy("item_id", "text").toLocalIterator():
        if t := normalise(r.text):
            own.append((r.item_id, t))
            size, total = size + len(t), total + len(t)
            if size >= SCAN_CHARS:
                slices.append(own)
                own, size = [], 0
            if total >= PASS_CHARS:
                slices += [own] if own else []
                out = scan(slices) if out is None else out.union(scan(slices))
                slices, own, size, total = [], [], 0, 0
    slices += [own] if own or not slices else []
    return scan(slices) if out is None else out.union(scan(slices))


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """docs without the documents that hold a benchmark item.

    Null and empty texts stay, as do rows of a null doc_id; of a repeated doc_id all rows go if one holds an item; empty
    tables change nothing; all columns stay, whatever their names.
    """
    hit = C.cut(matches(docs, benchmark, rate).select("doc_id").where("doc_id is not null").distinct())
    return C.without(docs, "doc_id", hit)
