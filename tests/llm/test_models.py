import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import classifier as Q
from sluice.llm import common as C
from sluice.llm import lmscore as L
from sluice.llm import urlfilter as U

# ---- quality classifier ----------------------------------------------------------------------------------------------


def test_em_finds_accuracies():
    rng = np.random.default_rng(5)
    truth, right = rng.random(6000) < 0.25, np.array([0.95, 0.8, 0.7])
    votes = np.stack([np.where(rng.random(6000) < p, truth, ~truth).astype(int) for p in right], axis=1)
    votes[rng.random(votes.shape) < 0.3] = -1
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, acc, prior = Q.em(patterns, counts.astype(float))
    assert np.abs(acc - right).max() < 0.05 and abs(prior - 0.25) < 0.05
    assert ((post[inverse.ravel()] > 0.5) == truth).mean() > 0.85
    post, _, _ = Q.em(np.zeros((0, 3), int), np.zeros(0))
    assert not len(post)


def test_em_equals_plain_loops():
    rng = np.random.default_rng(9)
    votes, counts = rng.integers(-1, 2, (12, 3)), rng.integers(1, 40, 12).astype(float)
    guess = [[0.4, 0.55, 0.05], [0.4, 0.1, 0.5]]
    theta, prior = [[list(c) for c in guess] for _ in range(3)], 0.15
    for _ in range(7):
        post = []
        for v in votes:
            good, bad = 1 - prior, prior
            for k in range(3):
                good, bad = good * theta[k][0][v[k] + 1], bad * theta[k][1][v[k] + 1]
            post.append(bad / (good + bad))
        for k in range(3):
            for c in (0, 1):
                n = [sum((p if c else 1 - p) * m for p, m, v in zip(post, counts, votes) if v[k] == x) + 0.5 * guess[c][x + 1] for x in (-1, 0, 1)]
                theta[k][c] = [x / sum(n) for x in n]
        prior = min(0.5, (sum(p * m for p, m in zip(post, counts)) + 0.15) / (counts.sum() + 1))
    got, _, share = Q.em(votes, counts, rounds=7)
    assert np.allclose(got, post) and np.isclose(share, prior)


def test_linear_scorer_equals_plain_ftrl():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 40, 6)).astype(np.int32) for _ in range(30)]
    target = rng.random(30)
    alpha, l1, l2, size = 0.3, 0.05, 1.0, 1 << Q.BITS
    z, s, w = {}, {}, {}
    mixed = np.random.default_rng(7)
    for _ in range(3):
        order = mixed.permutation(30)
        for i in range(0, 30, 8):
            g = {}
            for d in order[i : i + 8]:
                own = [*rows[d].tolist(), size]
                p = 1 / (1 + np.exp(-sum(w.get(f, 0) for f in own)))
                for f in own:
                    g[f] = g.get(f, 0) + p - target[d]
            for f, x in g.items():
                sigma = (np.sqrt(s.get(f, 0) + x * x) - np.sqrt(s.get(f, 0))) / alpha
                z[f] = z.get(f, 0) + x - sigma * w.get(f, 0)
                s[f] = s.get(f, 0) + x * x
                pen = 0 if f == size else l1
                w[f] = 0 if abs(z[f]) <= pen else -(z[f] - np.sign(z[f]) * pen) / ((1 + np.sqrt(s[f])) / alpha + l2)
    got = Q.fit_linear(rows, target, epochs=3, batch=8, alpha=alpha, l1=l1, l2=l2)
    assert np.allclose(got[[*range(40), size]], [w.get(f, 0) for f in [*range(40), size]]) and np.count_nonzero(got) <= 41


def test_stage_keeps_odd_rows(spark):
    docs, labels = quality_rows(5, 60)
    rows = [*docs, (None, "a b c"), (300, None), (301, ""), (302, "long word " * 40_000), (2, docs[2][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as gone", "2 as c0", "3 as `a.b`", "4 as toxic")
    lab = spark.createDataFrame([*labels, (300, None, None)], "doc_id long, quality int, toxic int").selectExpr("*", "1 as text")
    kept, scores = Q.accepted(df, lab), Q.scored(df, lab).collect()
    bad = {r.doc_id for r in scores if not r.keep and r.doc_id is not None}
    assert kept.columns == df.columns and len(scores) == len(rows) and bad
    assert sorted((str(r[0]), str(r[1])) for r in kept.collect()) == sorted((str(d), str(t)) for d, t in rows if d not in bad)
    assert Q.accepted(df.limit(0), lab).count() == 0


def quality_rows(seed, n=500):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) + ("." if j % 9 == 8 else "") for j in range(rng.randint(30, 90))]
        junk, toxic = i % 7 == 0, i % 5 == 1
        if junk:
            words = [w + "%%%" for w in words] if i % 2 else [w for w in words[:12] for _ in range(6)]
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), "grobnak" + rng.choice(["", "ian", "o", "est"]))
        docs.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, int(not junk), int(toxic)))
    return docs, labels


def test_classifier_held_out(spark):
    docs, labels = quality_rows(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as junk", "2 as toxic", "3 as code")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in Q.scored(df, lab).collect()}
    assert len(out) == len(docs)
    held = [i for i in range(len(docs)) if i % 2 == 0]
    for name, bad in (("junk", lambda i: i % 7 == 0), ("toxic", lambda i: i % 5 == 1)):
        hit = [(out[i][name] >= Q.REJECT) == bad(i) for i in held]
        assert np.mean(hit) > 0.95, name
    clean = [i for i in held if i % 7 and i % 5 != 1]
    assert np.mean([out[i].keep for i in clean]) > 0.98
    kept = Q.accepted(df, lab)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.keep}


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "some words here"), (3, "..."), (4, "word " * 60_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.scored(docs, none).count() == 6 and Q.scored(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, None, None), (None, 0, 1), (2, 1, 0), (2, 0, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    assert Q.scored(docs, odd).count() == 6


# ---- URL filter ------------------------------------------------------------------------------------------------------


def urls(seed, n=600):
    rng = random.Random(seed)
    word = lambda a: "".join(rng.choices(a, k=rng.randint(3, 9)))
    good = lambda: f"https://{word('aeioulmnrst')}.org/{word('abcdeil')}/{word('abcdeil')}.html"
    bad = lambda: f"http://{word('0123456789xz')}-{word('0123456789xz')}.biz/{word('0123456789')}?a={rng.randint(0, 99)}&b=1&c=2"
    return [(i, bad() if i % 3 == 0 else good(), int(i % 3 == 0)) for i in range(n)]


def test_url_filter_held_out(spark):
    rows = urls(1)
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").selectExpr("*", "1 as label", "'s' as suffix", "2 as n")
    labelled = spark.createDataFrame([(u, y) for i, u, y in rows if i % 2], "url string, label int")
    out = {r.page_id: r for r in U.filtered(pages, labelled).collect()}
    held = [(i, y) for i, _, y in rows if i % 2 == 0]
    assert len(out) == len(rows) and np.mean([out[i].keep == (y == 0) for i, y in held]) > 0.97


def test_url_filter_edges(spark):
    pages = spark.createDataFrame([(1, None), (2, " "), (3, "not a url"), (None, "http://x.y/"), (3, "not a url"), (4, "http://" + "a" * 100_000 + ".com/é?&&#f"), (5, "//")], "page_id long, url string")
    none = spark.createDataFrame([(None, 1), ("http://q.r", None)], "url string, label int")
    got = [(r.page_id, r.score, r.keep) for r in U.filtered(pages, none).collect()]
    assert len(got) == 7 and all((s is None and not k) == (i in (1, 2)) for i, s, k in got)
    assert U.filtered(pages.limit(0), none).count() == 0
    assert U.split_url("HTTP://u@Host.COM:80/P?q=1#f") == ("http", "host.com", "/P", "q=1", "f") and U.entropy("aabb") == 1.0
    odd = ["a.b.co.uk/x", "http://u@x.Example.com:8080/p", "http://10.0.0.1/", "localhost", "https://www.q.org?x", "//", "http://m.a-b.net#f"]
    df = U.placed(spark.createDataFrame([(u,) for u in odd], "url string"))
    assert [r.suffix for r in df.collect()] == [U.suffix(u) for u in odd] and [U.suffix(u) for u in odd][:5] == ["co.uk", "com", "ip", "localhost", "org"]
    hosts = spark.createDataFrame([("http://www.cheap-pills.com/a",), ("m.cheap-pills.com",), ("https://pillsbury.com",), ("http://x.org/casino",), (None,)], "url string")
    got = U.placed(hosts).select("fold", U.blocked(F.col("url")).alias("b")).collect()
    assert [r.b for r in got] == [1, 1, 0, 0, None] and got[0].fold == got[1].fold


def test_no_url_is_scored_by_labels_of_its_host(spark):
    rows = urls(4, 400)
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labelled = spark.createDataFrame([(u, y) for _, u, y in rows], "url string, label int")
    fold = {r.page_id: r.fold for r in U.placed(pages).collect()}
    turned = spark.createDataFrame([(u, 1 - y if fold[i] == 0 else y) for i, u, y in rows], "url string, label int")
    a, b = ({r.page_id: r.score for r in U.filtered(pages, x).collect()} for x in (labelled, turned))
    assert all(abs(a[i] - b[i]) < 1e-12 for i in fold if fold[i] == 0) and all(abs(a[i] - b[i]) > 0.5 for i in fold if fold[i] == 1)


def plain_trees(x, y, trees, depth):
    """Raw scores of the same boosting, one split at a time by trying all."""
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, U.BINS + 1)[1:-1])) for i in range(x.shape[1])]
    binned = np.array([[sum(v > e for e in edges[i]) for i, v in enumerate(r)] for r in x])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    raw = np.full(len(y), np.log(rate / (1 - rate)))

    def grow(own, g, h, d, out):
        best = (1e-6, None)
        part = lambda s: g[s].sum() ** 2 / (h[s].sum() + U.L2)
        if d and len(own) >= 2 * U.LEAF:
            for f in range(x.shape[1]):
                for c in range(U.BINS):
                    low = own[binned[own, f] <= c]
                    high = own[binned[own, f] > c]
                    if len(low) >= U.LEAF and len(high) >= U.LEAF and (gain := part(low) + part(high) - part(own)) > best[0] + 1e-12:
                        best = (gain, (low, high))
        if best[1]:
            for s in best[1]:
                grow(s, g, h, d - 1, out)
        else:
            out[own] = -U.RATE * g[own].sum() / (h[own].sum() + U.L2)

    for _ in range(trees):
        p, out = 1 / (1 + np.exp(-raw)), np.zeros(len(y))
        grow(np.arange(len(y)), p - y, p * (1 - p), depth, out)
        raw = raw + out
    return raw


def test_trees_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(U, "TREES", 5)
    monkeypatch.setattr(U, "DEPTH", 2)
    rng = np.random.default_rng(3)
    x = np.round(rng.random((90, 3)), 2)
    y = ((x[:, 0] > 0.4) & (x[:, 1] < 0.7) ^ (rng.random(90) < 0.1)).astype(float)
    assert np.allclose(U.fit(x, y).raw(x), plain_trees(x, y, 5, 2), atol=1e-9)


def test_trees_learn_what_no_single_cut_can():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = U.fit(x[:2000], y[:2000])
    assert ((model.chances(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert abs(U.fit(x[:0], y[:0]).chances(x[:1])[0] - 0.5) < 1e-9


# ---- language-model scores -------------------------------------------------------------------------------------------


def vocabulary(seed, n=300):
    counts = np.random.default_rng(seed).integers(0, 50, n).astype(float)
    counts[:5] = 4000, 900, 0, 1, 700
    return L.Vocabulary(counts)


def test_bands_hold_neighbours_in_rank():
    voc = vocabulary(3)
    assert voc.lo[0] == 0 and voc.hi[-1] == voc.size and (voc.lo[1:] == voc.hi[:-1]).all() and voc.rank[2] == -1 and voc.rank[0] == 0
    assert (voc.hi - voc.lo).max() <= L.BAND_IDS and np.isclose(np.exp(voc.bias).sum(), 1, atol=1e-5)
    assert all(np.isclose(np.exp(voc.inside[a:b]).sum(), 1, atol=1e-5) for a, b in zip(voc.lo, voc.hi))
    assert L.Vocabulary(np.zeros(9)).size == 0


def test_gradient_is_the_numeric_one():
    rng = np.random.default_rng(1)
    voc = vocabulary(1)
    flat = voc.initial().astype(np.float64)
    flat += rng.normal(0, 0.1, len(flat))
    rows, ranks = rng.integers(0, voc.size + 1, (3, L.WINDOW)), rng.integers(0, voc.size, (3, L.WINDOW))
    real = np.ones((3, L.WINDOW), bool)
    real[1, 20:] = False
    loss = lambda x: L.gradient(voc.unpack(x), voc, rows, ranks, real)[0]
    _, g, dx, inner = L.gradient(voc.unpack(flat), voc, rows, ranks, real)
    whole = voc.unpack(np.zeros(len(flat)))
    for k, x in g.items():
        whole[k][...] = x
    np.add.at(whole["emb"], rows.ravel(), dx)
    for lo, hi, x in inner:
        whole["inner"][lo:hi] += x
    dense = np.concatenate([whole[k].ravel() for k in voc.shapes])
    at = 0
    for k, shape in voc.shapes.items():
        own = at + np.flatnonzero(dense[at : at + int(np.prod(shape))])
        assert len(own), k
        for i in rng.choice(own, 8):
            up, down = flat.copy(), flat.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            num = (loss(up) - loss(down)) / 2e-5
            assert abs(num - dense[i]) < 1e-6 + 1e-4 * abs(num), k
        at += int(np.prod(shape))


def test_windows_score_each_id_once():
    for n in [0, 1, L.WINDOW - 1, L.WINDOW, L.WINDOW + 1, 200, 1000]:
        text, first, scored = L.windows(np.array([n, 5]))
        seen = np.zeros(n, int)
        for t, f, s in zip(text, first, scored, strict=True):
            if t == 0:
                seen[s : min(f + L.WINDOW, n)] += 1
        assert (seen == 1).all() and (text == 1).sum() == 1


def brute_score(m, ids, voc):
    """One id at a time, by a plain loop over what it may see."""
    step, total = L.WINDOW - L.OVERLAP, 0.0
    for i in range(len(ids)):
        w = 0 if i < L.WINDOW else 1 + (i - L.WINDOW) // step
        own = [0 if j == 0 else int(voc.rank[ids[j - 1]]) + 1 for j in range(w * step, i + 1)]
        x = m["emb"][own] + m["pos"][: len(own)]
        q, k, v = (x @ m["qkv"][:, n * L.WIDTH : (n + 1) * L.WIDTH] for n in range(3))
        a = np.exp(np.clip(k @ q[-1] / np.sqrt(L.WIDTH), -L.MOST, L.MOST))
        h = np.append(x[-1] + (a / a.sum()) @ v @ m["o"], 1)
        rank = int(voc.rank[ids[i]])
        band = int(voc.band[rank])
        for z, at in ((h @ m["out"], band), (m["inner"][voc.lo[band] : voc.hi[band]] @ h, rank - voc.lo[band])):
            total += z[at] - z.max() - np.log(np.exp(z - z.max()).sum())
    return total


@pytest.mark.parametrize("scale", [1, 40])
def test_scores_equal_brute(scale):
    rng = np.random.default_rng(4)
    voc = vocabulary(4)
    flat = voc.initial() + rng.normal(0, 0.1, len(voc.initial())).astype(np.float32)
    m = voc.unpack((flat * scale).astype(np.float32))  # by 40, logits leave the range of exp
    used = np.flatnonzero(voc.rank >= 0)
    ids = [rng.choice(used, n).astype(np.uint16) for n in (0, 1, 31, 32, 33, 56, 57, 200)]
    got = L.scores(m, ids, voc, batch=3)
    assert np.allclose(got, [brute_score(m, x, voc) for x in ids], rtol=2e-3, atol=1e-2)


def brute_train(flat, ids, voc, seed):
    """The same pass with a dense gradient for all parameters."""
    flat, sq = flat.astype(np.float64), np.full(len(flat), 1e-3)
    work = [(x, i) for x in ids for i in range(0, len(x), L.WINDOW)]
    mixed = np.random.default_rng(seed).permutation(len(work))
    for b in range(0, len(mixed), L.BATCH):
        own = [work[i] for i in mixed[b : b + L.BATCH]]
        rows, ranks, real = (np.zeros((len(own), L.WINDOW), k) for k in (int, int, bool))
        for n, (x, i) in enumerate(own):
            seen = [0 if j == 0 else voc.rank[x[j - 1]] + 1 for j in range(i, min(len(x), i + L.WINDOW))]
            rows[n, : len(seen)], ranks[n, : len(seen)], real[n, : len(seen)] = seen, voc.rank[x[i : i + len(seen)]], True
        _, g, dx, inner = L.gradient(voc.unpack(flat), voc, rows, ranks, real)
        dense = voc.unpack(np.zeros(len(flat)))
        for k, x in g.items():
            dense[k][...] = x
        np.add.at(dense["emb"], rows[real], dx.reshape(*rows.shape, -1)[real])
        for lo, hi, x in inner:
            dense["inner"][lo:hi] += x
        dense = np.concatenate([dense[k].ravel() for k in voc.shapes])
        sq += dense**2
        flat = flat - L.RATE * dense / np.sqrt(sq)
    return flat


def test_training_equals_the_dense_one(monkeypatch):
    monkeypatch.setattr(L, "BATCH", 4)
    rng = np.random.default_rng(6)
    voc = vocabulary(6)
    ids = [rng.choice(np.flatnonzero(voc.rank >= 0), n).astype(np.uint16) for n in (0, 1, 31, 32, 33, 160, 160, 700)]
    got, n = L.train_pass(voc.initial(), ids, voc, 5)
    assert n == sum(map(len, ids)) and np.abs(got - brute_train(voc.initial(), ids, voc, 5)).max() < 2e-2


def test_training_sees_every_id_once_and_not_the_partitions(spark, monkeypatch):
    rng = np.random.default_rng(7)
    voc = vocabulary(7)
    monkeypatch.setattr(L, "FAN", 2)
    texts = [rng.choice(np.flatnonzero(voc.rank >= 0), n).astype("<u2") for n in rng.integers(1, 90, 60)]
    total = sum(map(len, texts))
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(texts)], "doc_id long, ids binary").selectExpr("ids", "xxhash64(doc_id, ids) as h")
    a, b = (L.trained(df.repartition(k), voc, total, np.dtype("<u2"), 1, group_ids=500) for k in (1, 7))
    assert np.array_equal(a, b)
    # the average of the groups' models, by ids
    flat, rows, groups = voc.initial(), df.collect(), -(-total // 500)
    seen = 0
    for r in range(L.ROUNDS):
        parts = []
        for g in range(groups):
            own = sorted((x for x in rows if x.h % groups == g and (x.h >> 40) % L.ROUNDS == r), key=lambda x: (x.h, bytes(x.ids)))
            parts += [L.train_pass(flat, [np.frombuffer(bytes(x.ids), "<u2") for x in own], voc, r)] if own else []
        n = sum(p[1] for p in parts)
        seen += n
        flat = sum(p[0].astype(float) * p[1] for p in parts).astype(float) / n
        flat = flat.astype(np.float32)
    assert seen == total and np.abs(a - flat).max() < 1e-4


@pytest.mark.parametrize(("kind", "scale"), [("<u2", 1), ("<u4", 1), ("<u2", 40)])
def test_jvm_trains_and_scores_as_numpy_does(spark, kind, scale):
    rng = np.random.default_rng(8)
    voc = vocabulary(8, 900)
    assert L._in_jvm(spark) and len(voc.lo) % 4 and (voc.hi - voc.lo).max() > 32
    ids = [rng.choice(np.flatnonzero(voc.rank >= 0), n).astype(kind) for n in (0, 1, 7, 31, 32, 33, 56, 57, 160, 160, 2000)]
    flat = (voc.initial() + rng.normal(0, 0.1, len(voc.initial())) * scale).astype(np.float32)
    packed = L.K.pack(flat, voc, np.dtype(kind).itemsize)
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(ids)], "i long, ids binary").coalesce(1)
    score = L.K.function(spark, packed, 4, L.CHUNK, "double")
    got = [r.s for r in df.selectExpr("i", f"{score}(ids, 0L) as s").sort("i").collect()]
    assert got[0] == 0 and np.allclose(got, L.scores(voc.unpack(flat), ids, voc), rtol=1e-4, atol=1e-3)
    if scale == 1:
        learn = L.K.function(spark, packed, L.BATCH, 1 << 10, "array<binary>")
        parts = df.sort("i").selectExpr("collect_list(ids) as all").selectExpr(f"{learn}(all, 3L) as p").first().p
        got = np.frombuffer(b"".join(map(bytes, parts)), np.float32)
        want, _ = L.train_pass(flat, ids, voc, 3, L.mixed_order)
        assert np.abs(want - flat).max() > 0.1 and np.abs(got - want).max() < 1e-4
        assert not np.array_equal(L.mixed_order(99, 3), L.mixed_order(99, 4)) and sorted(L.mixed_order(99, 3)) == list(range(99))


def test_numpy_does_it_where_the_jvm_cannot(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words of text {i} and {i * i} more") for i in range(40)] + [(90, None)], "doc_id long, text string")
    jvm = L.scored(docs)
    assert "MapInArrow" not in jvm._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(L.K, "ready", lambda *_: False)
    a, b = (sorted(x.collect()) for x in (jvm, L.scored(docs)))
    assert [r[:2] for r in a] == [r[:2] for r in b] and jvm.schema == L.scored(docs).schema
    assert np.allclose([r.logprob for r in a], [r.logprob for r in b], rtol=1e-4)
    assert np.allclose([r.perplexity for r in a[:-1]], [r.perplexity for r in b[:-1]], rtol=1e-3) and a[-1].perplexity is None is b[-1].perplexity


def test_training_beats_counts(spark):
    rng = random.Random(2)
    pairs = {f"left{i}": f"right{i}" for i in range(30)}
    say = lambda: " ".join(x for _ in range(40) for x in rng.choice(list(pairs.items())))
    rows = [(i, say()) for i in range(150)] + [(900, None), (901, ""), (None, say()), (0, None), (902, "long text " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n", "3 as part")
    out = L.scored(docs, epochs=8).collect()
    assert len(out) == len(rows)
    enc = C.encoder()
    assert all(r.n_tokens in {len(enc.ids(t)) for d, t in rows if d == r.doc_id} for r in out)
    for r in out:
        assert (r.perplexity is None) == (r.n_tokens == 0) and (r.n_tokens or r.logprob == 0)
    assert sum(r.n_tokens for r in out if r.doc_id == 902) == len(enc.ids("long text " * 30_000))
    flat = np.concatenate([enc.ids(t) for _, t in rows[:150]])
    counts = np.bincount(np.concatenate([enc.ids(t) for _, t in rows]), minlength=enc.size)
    unigram = np.log(counts[flat] / counts.sum()).mean()
    own = [r for r in out if r.doc_id is not None and 0 < r.doc_id < 150]
    assert sum(r.logprob for r in own) / sum(r.n_tokens for r in own) > unigram + 0.3
    assert L.scored(docs.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stage_contract(spark, stage, tmp_path):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"]
    docs, labels = quality_rows(8, 60)
    item = " ".join(f"benchword{i}" for i in range(25))
    base = "first line of the shared text with enough words to count"
    docs += [(100, docs[2][1]), (101, f"{base}\nown words of one hundred and one"), (102, f"{base}\nother words of one hundred and two and more besides these"), (103, f"before {item} after")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    name, run = P.STAGES[stage]
    out = run(spark, df, str(tmp_path))
    rows = out.collect()
    if stage == 4:
        assert sorted(x for r in rows for x in r.ids) == sorted(d for d, _ in docs)
        return
    assert out.columns == df.columns and out.dtypes == df.dtypes
    ids, text = {r.doc_id for r in rows}, {r.doc_id: r.text for r in rows}
    if name == "near_dedup":
        assert 2 in ids and 100 not in ids
    if name == "substring_dedup":
        assert text[101].startswith(base) and text[102] == "other words of one hundred and two and more besides these" and text.get(100) is None
        assert all(r.n_chars == len(r.text) for r in rows)
    if name == "decontamination":
        assert ids == {d for d, _ in docs} - {103}


def test_pipeline_runs_whole(spark, tmp_path):
    import corpus_pipeline as P

    docs, labels = quality_rows(8, 80)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = [x for r in P.run(spark, str(tmp_path)).collect() for x in r.ids]
    assert len(got) == len(set(got)) and set(got) <= {d for d, _ in docs} and len(got) > 40
