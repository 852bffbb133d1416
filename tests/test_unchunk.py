import random

import pytest

from sluice.operators import unchunk
from sluice.operators.unchunk import Options
from sluice.sources import sinks

SCHEMA = "doc_id string, text string, chunk_index int, chunk_total int, title string, token_count int, split string"
CHARS = (lambda t: [ord(c) for c in t], lambda ids: "".join(map(chr, ids)))


def run(spark, rows, schema=SCHEMA, **k):
    docs, bad = unchunk.reconstructed(spark.createDataFrame(rows, schema), Options(**({"group_id": "doc_id"} | k)))
    return {r.reconstructed_group_id: r for r in docs.collect()}, {r.group_id: (r.reason, r.error, r.rows) for r in bad.collect()}


def test_cases(spark):
    rows = [
        ("one", "only", 0, 1, "A", 9, "train"), ("two", "beta gamma", 1, 2, "A", 1, "test"), ("two", "alpha beta", 0, 2, "B", 1, "test"),
        ("gap", "x", 0, 3, None, 1, None), ("gap", "y", 2, 3, None, 1, None), ("tot", "x", 0, 2, None, 1, None), ("tot", "y", 1, 3, None, 1, None), ("no", "abc", 0, 2, None, 1, None), ("no", "xyz", 1, 2, None, 1, None),
        ("null", None, 0, 1, None, 1, None), ("dup", "a", 0, 2, None, 1, None), ("dup", "a", 0, 2, None, 1, None), (None, "lost id", 0, 1, None, 1, None), ("bad", "q", None, 1, None, 1, None),
    ]
    docs, bad = run(spark, rows, max_overlap=4)
    assert docs["one"].text == "only" and docs["one"].title == "A" and docs["one"].source_chunk_count == 1 and "token_count" not in docs["one"].asDict() and docs["null"].text == "" and docs["None"].text == "lost id"
    two = docs["two"]
    assert two.text == "alpha beta gamma" and two.overlaps == [4] and two.title is None and two.conflicts == {"title": ['{"v":"B"}', '{"v":"A"}']} and two.split == "train"
    assert bad["gap"] == ("unsafe_reconstruction", "chunk indexes are incomplete or duplicated: expected [0, 1, 2], got [0, 2]", 2)
    assert "inconsistent" in bad["tot"][1] and "text overlap" in bad["no"][1] and "duplicated" in bad["dup"][1] and "integer" in bad["bad"][1]
    assert run(spark, [])[0] == {}


def test_tokens_and_concat(spark):
    docs, _ = run(spark, [("t", "abcdef", 0, 2, None, 1, None), ("t", "defghi", 1, 2, None, 1, None)], tokenizer=CHARS, max_overlap=3)
    assert docs["t"].text == "abcdefghi" and docs["t"].reconstructed_token_count == 9 and docs["t"].overlaps == [3]
    docs, _ = run(spark, [("t", "abc", 0, 2, None, 1, None), ("t", "def", 1, 2, None, 1, None)], strategy="concat-no-overlap", expected_overlap=0)
    assert docs["t"].text == "abcdef"
    docs, bad = run(spark, [("t", "abc", 0, 2, None, 1, None), ("t", "cde", 1, 2, None, 1, None)], expected_overlap=2)
    assert "t" in bad and not docs


def merge(texts, most):
    out, found = texts[0], []
    for t in texts[1:]:
        n = next((n for n in range(min(most, len(out), len(t)), 0, -1) if out[-n:] == t[:n]), None)
        if n is None:
            return None
        found.append(n)
        out += t[n:]
    return out, found


def test_merge_equals_plain(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for g in range(80):
        texts = ["".join(rng.choices("abé", k=rng.randint(0, 9))) for _ in range(rng.randint(1, 5))]
        want[str(g)] = merge(texts, 4)
        rows += [(str(g), t, i, len(texts), None, 1, None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs, bad = run(spark, rows, max_overlap=4)
    assert {g for g, w in want.items() if w is None} == set(bad)
    assert {g: (r.text, r.overlaps) for g, r in docs.items()} == {g: w for g, w in want.items() if w}


def test_policies_and_limits(spark):
    rows = [("a", "x", 0, 3, None, 1, "test"), ("a", "x", 1, 3, None, 1, "train"), ("a", "x", 2, 3, None, 1, "test"), ("b", "x", 0, 1, None, 1, "dev"), ("c", "x", 0, 1, None, 1, None)]
    split = lambda p: {g: r.split for g, r in run(spark, rows, split_policy=p)[0].items()}
    assert split("train") == {"a": "train", "b": "train", "c": "train"} and split("majority") == {"a": "test", "b": "dev", "c": "train"}
    assert split("original-if-consistent") == {"a": "train", "b": "dev", "c": "train"} and set(split("hash").values()) <= {"train", "validation"}
    assert set(run(spark, rows, max_groups=1, arrival="text")[0]) == {"a"}
    assert set(run(spark, rows, group_id=None, group_by=("doc_id", "title"))[0]) == {"a|None", "b|None", "c|None"}
    docs, bad = unchunk.reconstructed(spark.createDataFrame([("q",)], "doc_id string"), Options(group_id="doc_id"))
    assert docs.count() == 0 and bad.first().reason == "missing_required_columns" and "chunk_index, chunk_total, text" in bad.first().error
    for wrong in ({}, {"group_id": "a", "group_by": ("b",)}, {"group_id": "a", "max_overlap": -1}, {"group_id": "a", "strategy": "concat-no-overlap"}, {"group_id": "a", "strategy": "token-overlap"}, {"group_id": "a", "split_policy": "z"}, {"group_id": "a", "max_groups": 1}):
        with pytest.raises(ValueError):
            Options(**wrong)


def test_sink(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 0, 1, "T", 1, "dev"), ("b", "x", 0, 2, "T", 1, "dev")], SCHEMA)
    docs, bad = unchunk.reconstructed(rows, Options(group_id="doc_id"))
    sinks.unchunked(docs.drop("conflicts", "overlaps"), bad, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o/data")).count() == 1
    r = unchunk.report(rows, docs, bad)
    assert (r["input_rows"], r["groups_seen"], r["reconstructed_groups"], r["quarantined_groups"]) == (2, 2, 1, 1)
