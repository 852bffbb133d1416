import math
import random
import struct

import numpy as np

from sluice.llm import common as C
from sluice.llm import orderminhash, pfor


def test_encoder_equals_library(spark):
    enc = C.encoder()
    for t in ["Hello world's end, it's  two\n\n spaces ", "naïve — “q” x²y ½ 12_34 ''s", "", "\t\n", "a" * 5000, "漢字 と 12", " 's 'll've"]:
        assert enc.ids(t).tolist() == enc._whole.encode_ordinary(t)


def test_encoding_together_equals_library():
    enc, rng = C.encoder(), random.Random(1)
    letters = list("abcdesdmtlvrABZ 0123  ''' .,-_!\n\n\t\r") + list("\u00e9\u00df\u00f1\u024f\u00ab\u2013\u2019\u20ac\u00d7\u00b2\u6f22")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2000)] + ["don't they're we've I'll 'tis 's ''s x'sy \n 'll\n\n  end  ", "'", " ", "'s", "\n'd a", None, "", "x" * 300_000]
    for i in range(0, len(texts), 7):
        for t, ids in zip(texts[i : i + 7], enc.many(texts[i : i + 7]), strict=True):
            assert ids.tolist() == enc._whole.encode_ordinary(t or "")
    assert enc.many([]) == []


def test_words_hash_is_by_content():
    w = C.Words(["Alpha beta. alpha", "", "ALPHA, x-y", "é"])
    assert w.at.tolist() == [0, 3, 3, 6, 7]
    assert w.hash[0] == w.hash[2] == w.hash[3] and w.hash[0] != w.hash[1]


def test_pfor_round_trip():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 50000, n) for n in (0, 1, 127, 128, 129, 1000)] + [np.full(300, 7), np.array([0, 4_000_000_000] * 70), np.where(rng.random(500) < 0.05, 49999, 3)]
    for (payload, starts), a in zip(pfor.encode(arrays), arrays, strict=True):
        assert pfor.decode(payload, starts).tolist() == a.tolist()
        if len(starts) > 1:
            assert pfor.decode_block(payload, int(starts[1])).tolist() == a[128:256].tolist()


def plain_payload(ids, block=pfor.BLOCK, share=pfor.SHARE):
    """The same bytes, one id and one bit at a time, and the places of the blocks."""
    out, starts = b"", []
    for at in range(0, len(ids), block):
        own = [int(x) for x in ids[at : at + block]]
        starts.append(len(out))
        diff = [x - min(own) for x in own]
        width = sorted(diff)[math.ceil(len(diff) * share) - 1].bit_length()
        far = [i for i, d in enumerate(diff) if d >> width]
        bits = [d >> b & 1 for d in diff for b in range(width)]
        bits += [0] * (-len(bits) % 8)
        packed = bytes(sum(b << i for i, b in enumerate(bits[j : j + 8])) for j in range(0, len(bits), 8))
        out += struct.pack("<IBBH", min(own), width, len(far), len(own)) + packed + bytes(far) + b"".join(struct.pack("<I", diff[i]) for i in far)
    return out, starts


def test_pfor_bytes_equal_plain_ones():
    rng = np.random.default_rng(5)
    arrays = [rng.integers(0, 50000, n) for n in (1, 9, 127, 128, 129, 700)] + [np.full(200, 7), np.array([3, 4_000_000_000] * 70), np.where(rng.random(400) < 0.07, 49999, 3), np.arange(300)]
    for (payload, starts), a in zip(pfor.encode(arrays), arrays, strict=True):
        assert (payload, starts.tolist()) == plain_payload(a)
    assert any(np.frombuffer(p, pfor.HEAD, 1, int(s))["out"][0] for p, starts in pfor.encode(arrays) for s in starts)
    assert pfor.encode([np.zeros(0, np.int64)])[0][0] == b""


def test_token_blocks_edges(spark):
    rows = [(1, "hello hello world", "x"), (1, "hello hello world", "x"), (None, "a b", "y"), (3, None, None), (4, "", "z"), (5, "word " * 60000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, starts string")
    out = {(r.doc_id, r.n_tokens): pfor.decode(bytes(r.payload), np.array(r.starts)).tolist() for r in pfor.token_blocks(docs).collect()}
    enc = C.encoder()
    for d, t, _ in rows:
        ids = enc.ids(t).tolist()
        assert out[(d, len(ids))] == ids
    assert pfor.token_blocks(docs.limit(0)).count() == 0


def brute_omh(words, k, size, sketches):
    """The same choice by a plain sort over numbered k-mers."""
    kmers = C.shingles(np.array(words, np.uint64), k)
    seen, num = {}, []
    for x in kmers.tolist():
        num.append(seen.get(x, 0))
        seen[x] = num[-1] + 1
    out = []
    for m in range(sketches):
        h = [int(C.mix(C.mix(np.array([x], np.uint64) + np.uint64(0x632BE59BD9B4E019) * np.uint64(o)) ^ C.BYTES[m] + np.uint64(m))[0]) for x, o in zip(kmers, num, strict=True)]
        pick = sorted(sorted(range(len(h)), key=lambda i: h[i])[:size])
        t = np.array([m + 1], np.uint64)
        for i in pick:
            t = C.mix(t * np.uint64(C._P) + kmers[i])
        out.append(int(t.view(np.int64)[0]))
    return out


def test_order_minhash_brute_and_order(spark):
    w = C.Words(["a b c a b c a b d e f g a b"]).hash
    assert orderminhash.signature(w).tolist() == brute_omh(w.tolist(), orderminhash.K, orderminhash.TUPLE, orderminhash.SKETCHES)
    base = [f"w{i}" for i in range(200)]
    one, swapped = list(base), base[100:] + base[:100]
    one[50] = "other"
    rows = [(1, " ".join(base)), (2, " ".join(one)), (3, " ".join(swapped)), (4, None), (5, ""), (6, "..."), (None, "one"), (1, " ".join(base)), (7, "again and again " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as signature", "'x' as n_kmers")
    sig = {r.doc_id: r for r in orderminhash.fingerprints(docs).collect()}
    same = lambda a, b: np.mean(np.array(sig[a].signature) == np.array(sig[b].signature))
    assert same(1, 2) > 0.7 > same(1, 3)
    assert sig[4].signature == sig[5].signature == sig[6].signature == [] and sig[None].n_kmers == 1 and len(sig[7].signature) == orderminhash.SKETCHES
    assert orderminhash.fingerprints(docs.limit(0)).count() == 0
