import random

import numpy as np

from sluice.llm import common as C
from sluice.llm import packing, sharding


def brute_pack(sizes, limits):
    """The same heuristic, one plain loop."""
    out, live, b = [None] * len(sizes), [i for i, s in enumerate(sizes) if all(x <= m for x, m in zip(s, limits, strict=True))], 0
    alone = [i for i in range(len(sizes)) if i not in live]
    while live:
        left = list(limits)
        while fits := [i for i in live if all(x <= r for x, r in zip(sizes[i], left, strict=True))]:
            dot = lambda i: sum(x / m * (r / m) for x, r, m in zip(sizes[i], left, limits, strict=True))  # noqa: B023, E731
            best = max(fits, key=lambda i: (round(dot(i), 12), -i))
            out[best] = b
            live.remove(best)
            left = [r - x for r, x in zip(left, sizes[best], strict=True)]
        b += 1
    for i in alone:
        out[i], b = b, b + 1
    return out


def test_pack_equals_brute():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 60):
        sizes = np.stack([rng.integers(0, 70, n), rng.integers(1, 5, n), rng.integers(0, 40, n)], axis=1).astype(np.int64)
        assert packing.pack(sizes, (64, 6, 48)).tolist() == brute_pack(sizes.tolist(), (64, 6, 48))


def test_packs_hold_all_within_limits(spark):
    rng = random.Random(2)
    rows = [(i, t, "assistant" if t % 2 else "User", " ".join("w" for _ in range(rng.randint(0, 60)))) for i in range(60) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "assistant", "x"), (None, 1, None, None), (7, 0, "ASSISTANT ", "again " * 10), (100, 0, "assistant", "long " * 20_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as tokens", "'x' as pack_id")
    limits = (200, 8, 120)
    out = packing.conversation_packs(turns, limits, cell=16).collect()
    assert sorted(x for r in out for x in r.ids if x is not None) == [*range(60), 100] and sum(x is None for r in out for x in r.ids) == 1
    enc = C.encoder()
    want = {}
    for c, _, role, text in rows:
        n = len(enc.ids(text))
        w = want.setdefault(c, [0, 0, 0])
        w[0], w[1], w[2] = w[0] + n, w[1] + 1, w[2] + (n if (role or "").strip().lower() == "assistant" else 0)
    for r in out:
        assert [r.tokens, r.segments, r.loss_tokens] == [sum(want[i][k] for i in r.ids) for k in range(3)]
        assert r.oversize == (len(r.ids) == 1 and any(a > b for a, b in zip((r.tokens, r.segments, r.loss_tokens), limits, strict=True)))
        assert r.oversize or all(a <= b for a, b in zip((r.tokens, r.segments, r.loss_tokens), limits, strict=True))
    assert len({r.pack_id for r in out}) == len(out)
    assert packing.conversation_packs(turns.limit(0), limits).count() == 0


def test_document_packs(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (None, "c"), (1, "a b"), (4, "w " * 500)], "doc_id long, text string")
    out = packing.document_packs(docs, (100, 3, 100)).collect()
    assert sorted((x is None, x or 0) for r in out for x in r.ids) == sorted((x is None, x or 0) for x in (1, 2, 3, None, 1, 4))
    assert [r.ids for r in out if r.oversize] == [[4]]


def test_packed_keeps_ids_of_any_type(spark):
    import decimal

    big = [2**53 + 1, 2**53 + 3, 2**63 - 1, None, -5]
    rows = [(i, n, s, x) for i in big for n, s, x in ((3, 1, 1), (None, None, -4))]
    for kind, cast in (("long", int), ("string", str), ("decimal(20,0)", decimal.Decimal)):
        df = spark.createDataFrame([(None if i is None else cast(i), *x) for i, *x in rows], f"id {kind}, tokens int, segments int, loss_tokens int").selectExpr("*", "1 as cell", "2 as hot", "3 as `a.b`")
        out = packing.packed(df, "id", (10, 4, 10)).collect()
        assert sorted((x for r in out for x in r.ids), key=str) == sorted((None if i is None else cast(i) for i, *_ in rows), key=str)
        assert sum(r.tokens for r in out) == 15 and sum(r.loss_tokens for r in out) == 5 and max(r.tokens for r in out) <= 10


def test_packed_spreads_a_hot_id(spark):
    df = spark.range(900).selectExpr("if(id < 600, 7, id) as id", "1 as tokens", "1 as segments", "1 as loss_tokens")
    out = packing.packed(df, "id", (10, 10, 10), cell=50).collect()
    assert sorted(x for r in out for x in r.ids) == sorted([7] * 600 + [*range(600, 900)])
    cells = {r.pack_id[:8]: 0 for r in out}
    for r in out:
        cells[r.pack_id[:8]] += len(r.ids)
    assert len(cells) == 18 and max(cells.values()) < 120 and len(out) < 90 + 18


def brute_capacity(sizes, shards):
    """Least largest sum over all ways to cut, by dynamic programming."""
    n, inf = len(sizes), float("inf")
    best = [0] + [inf] * n
    for _ in range(shards):
        best = [0] + [min(max(best[j], sum(sizes[j:i])) for j in range(i)) for i in range(1, n + 1)]
    return best[n]


def test_least_capacity(spark):
    rng = random.Random(4)
    for shards in (1, 3, 8):
        sizes = [rng.choice([0, 1, 5, 9, 40]) for _ in range(30)]
        df = spark.createDataFrame(list(enumerate(sizes)), "k int, size long")
        for held in (sharding.HELD, 0):
            cut, capacity = sharding.partition(df, ["k"], shards, held)
            rows = cut.orderBy("k").collect()
            assert capacity == brute_capacity(sizes, shards) and [r.k for r in rows] == list(range(30))
            nth = [r.shard for r in rows]
            assert nth == sorted(nth) and max(nth) < shards
            assert max(sum(s for s, x in zip(sizes, nth, strict=True) if x == y) for y in set(nth)) == capacity


def test_document_shards(spark):
    rows = [(i, "b" if i < 300 else "a", "x" * (i % 50)) for i in range(600)] + [(None, None, "é"), (5, "b", None), (5, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "0 as shard", "1 as size")
    out = sharding.document_shards(docs, 4, 64).collect()
    assert len(out) == len(rows)
    groups = {}
    for r in out:
        groups.setdefault((r.source, None if r.doc_id is None else r.doc_id // 64), set()).add(r.shard)
    assert all(len(s) == 1 for s in groups.values()) and max(r.shard_bytes for r in out) == out[0].capacity
    assert sharding.document_shards(docs.limit(0)).count() == 0
    named = docs.selectExpr("concat('d', doc_id) as doc_id", "source", "text", "1 as `a.b`", "2 as g_source")
    assert sharding.document_shards(named, 4, 64).count() == len(rows)
