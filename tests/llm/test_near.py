import random

import numpy as np
import pytest

from sluice.llm import common as C
from sluice.llm import near
from sluice.llm.graph import components


def corpus(seed, groups=12, copies=5, words=120):
    """Distinct texts, each with copies of which a few words differ."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    out, n = [], 0
    for _ in range(groups):
        base = rng.choices(vocab, k=words)
        for c in range(copies):
            own = [w if c == 0 or rng.random() > 0.03 * c else rng.choice(vocab) for w in base]
            out.append((n, " ".join(own)))
            n += 1
    return out


def brute(rows, idf, threshold):
    """Components of all pairs compared."""
    vecs = {d: near.weights(C.Words([t or ""]).hash, idf) for d, t in rows}
    ids, root = [d for d, _ in rows], {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = set()
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if near.jaccard(vecs[a], vecs[b]) >= threshold or (len(vecs[a][0]) and vecs[a][0].tolist() == vecs[b][0].tolist() and vecs[a][1].tolist() == vecs[b][1].tolist()):
                pairs.add((a, b))
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}, pairs


def test_jaccard_and_samples_agree():
    rng = np.random.default_rng(3)
    near.np.seterr(over="ignore")
    for share in (0.3, 0.6, 0.9):
        both = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.int64).astype(np.uint64))
        cut = int(len(both) * share)
        a, b = both[: (len(both) + cut) // 2], both[(len(both) - cut) // 2 :]
        wa, wb = rng.random(len(a)).astype(np.float32) + 0.5, None
        at = dict(zip(a.tolist(), wa.tolist(), strict=True))
        wb = np.array([at.get(x, 1.0) for x in b.tolist()], np.float32)
        least = sum(min(at.get(x, 0), y) for x, y in zip(b.tolist(), wb.tolist(), strict=True))
        true = least / (wa.sum() + wb.sum() - least)
        assert abs(near.jaccard((a, wa), (b, wb)) - true) < 1e-5
        assert abs((near.sample(a, wa, 1500) == near.sample(b, wb, 1500)).mean() - true) < 0.06
        wa[::2] = 1.0  # the common weight has a short cut
        wb = np.array([dict(zip(a.tolist(), wa.tolist(), strict=True)).get(x, 1.0) for x in b.tolist()], np.float32)
        assert (near.sample(a, wa, 300, 1.0) == near.sample(a, wa, 300)).mean() > 0.99 and (near.sample(b, wb, 300, 1.0) == near.sample(b, wb, 300)).mean() > 0.99


def test_samples_are_independent():
    rng = np.random.default_rng(8)
    hits = []
    for _ in range(40):
        s = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.int64).astype(np.uint64))
        a, b = s[:2000], s[1000:]
        hits.append((near.sample(a, np.ones(len(a)), 144, 1.0) == near.sample(b, np.ones(len(b)), 144, 1.0)).sum())
    p = 1000 / 3000
    assert abs(np.mean(hits) / 144 - p) < 0.03 and np.var(hits) < 1.8 * 144 * p * (1 - p)


def test_document_frequencies_are_exact_where_frequent(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices([f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(60)], k=40))) for i in range(200)] + [(900, None), (901, ""), (902, "...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [np.unique(C.shingles(C.Words([t or ""]).hash, near.SHINGLE)) for _, t in rows]
    keys, df = np.unique(np.concatenate(sets), return_counts=True)
    for frequent in (1 << 17, 300):
        least = max(1, -(-int(df.sum()) // frequent))
        got = near.document_frequencies(docs, frequent=frequent)
        assert np.allclose(got.of(keys), np.log(201 / (1 + np.maximum(df, least))) + 1, atol=1e-5)
        assert sorted(got.keys.tolist()) == sorted(keys[df >= least].tolist()) and len(got.keys) <= frequent
        assert np.isclose(got.of(np.array([12345], np.uint64))[0], np.log(201 / (1 + least)) + 1, atol=1e-5)
    assert not len(near.document_frequencies(docs.limit(0)).keys)


@pytest.mark.parametrize("hot", [C.HOT, 3])
def test_groups_against_all_pairs(spark, hot, monkeypatch):
    monkeypatch.setattr(C, "HOT", hot)
    monkeypatch.setattr(near, "BLOCK", 512 if hot > 3 else 4)
    rows = corpus(1)
    if hot == 3:  # boilerplate that all share, so that unlike documents meet in the same buckets
        shared = " ".join(f"s{i}" for i in range(60))
        rows = [(d, f"{shared} {t}") for d, t in rows] + [(500 + i, rows[0][1]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as band", "2 as whole", "3 as id")
    idf = near.document_frequencies(docs)
    want, pairs = brute(rows, idf, near.THRESHOLD)
    got = {r.doc_id: (r.group_doc_id, r.keep) for r in near.groups(docs).collect()}
    found = sum(got[a][0] == got[b][0] for a, b in pairs)
    assert len(pairs) > 60 and found >= 0.9 * len(pairs)
    # nothing is joined that the pairs don't join
    assert all(want[d] == want[g] for d, (g, _) in got.items())
    assert all(k == (d == g) for d, (g, k) in got.items())


def test_recall_at_the_threshold(spark):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        both = [f"x{rng.randrange(10**6)}" for _ in range(100)]
        rows += [(2 * i, " ".join([*both, *(f"y{rng.randrange(10**6)}" for _ in range(45))])), (2 * i + 1, " ".join([*both, *(f"z{rng.randrange(10**6)}" for _ in range(45))]))]
    got = {r.doc_id: r.group_doc_id for r in near.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * i] == got[2 * i + 1] for i in range(150)) >= 0.88 * 150


def test_edge_rows(spark):
    long = " ".join(f"token{i}" for i in range(120_000))
    rows = [(5, "Alpha beta gamma delta"), (3, "alpha, BETA gamma - delta!"), (9, None), (8, ""), (7, "..."), (None, "alpha beta gamma delta"), (5, "Alpha beta gamma delta"), (20, long), (21, long), (30, "one"), (31, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as n", "'x' as root", "'y' as gone", "'z' as c0", "1 as `a.b`")
    got = {r.doc_id: r.group_doc_id for r in near.groups(docs).collect()}
    assert got == {5: 3, 3: 3, 9: 9, 8: 8, 7: 7, 20: 20, 21: 20, 30: 30, 31: 30}
    kept = near.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "9", "8", "7", "None", "20", "30"])
    assert near.groups(docs.limit(0)).count() == 0


def test_thousands_of_copies(spark):
    base = " ".join(f"w{i}" for i in range(150))
    rows = [(i, f"{base} extra{i} more{i}") for i in range(3000)] + [(5000, "something else entirely in here")]
    got = near.groups(spark.createDataFrame(rows, "doc_id long, text string")).where("keep").collect()
    assert {r.doc_id for r in got} == {0, 5000}


def test_components(spark):
    rng = random.Random(1)
    chain = list(range(300))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:], strict=False)) + [(1000, 1001), (1001, 1000), (7, 7), (None, 3), (2000, 2000)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(300), 0), 1000: 1000, 1001: 1000, 2000: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
