import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import decontaminate as D
from sluice.llm import substring as S


def clauses(text):
    """(start, end, words, weight, line) of each clause of a text."""
    n = text.translate(str.maketrans(S.FROM, S.TO)).lower()
    assert len(n) == len(text)
    ends, run = [], r"[.,;:!?\n\x1f \t\r\x0b\x0c]+"
    for m in re.finditer(run, n):
        marks, blanks = set(m[0]) & set(".,;:!?\n\x1f"), set(m[0]) & set(" \t\n\r\x0b\x0c\x1f")
        if marks and blanks:
            ends.append(m.end())
    at = [0, *(e for e in ends if e < len(text)), len(text)] if text else [0]
    out = []
    for a, b in zip(at, at[1:]):
        words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", n[a:b])
        out.append((a, b, words, len(words) + sum(c >= "\u0800" for c in n[a:b]) // 2, n[:a].count("\n")))
    return out


def brute_clean(rows):
    """First occurrences in the order of doc_id and place, by one set."""
    seen, out = {}, {}
    for d, t in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        c, units = clauses(t), []
        for i, x in enumerate(c):
            j = next((j for j in range(i, min(len(c), i + 500)) if sum(y[3] for y in c[i : j + 1]) >= S.RUN_WORDS), None)
            if x[3] and j is not None:
                units.append((i, 0, j))
        lines = {}
        for i, x in enumerate(c):
            lines.setdefault(x[4], []).append(i)
        for own in lines.values():
            if sum(c[i][3] for i in own) >= S.MIN_WORDS:
                units.append((own[0], 1, own[-1]))
        gone = set()
        for i, kind, j in sorted(units):
            if seen.setdefault((kind, tuple(w for x in c[i : j + 1] for w in x[2])), (d, i)) != (d, i):
                gone |= {*range(i, j + 1)}
        spans = []
        for i in sorted(gone):
            spans = [*spans[:-1], (spans[-1][0], c[i][1])] if spans and spans[-1][1] == c[i][0] else [*spans, c[i][:2]]
        out[d] = ("".join(t[x[0] : x[1]] for i, x in enumerate(c) if i not in gone), spans)
    return out


def made_rows():
    rng = random.Random(6)
    word = lambda: rng.choice(["alpha", "B\u00e9ta", "x", "\u00df-", "1", "\u6f22\u5b57", "don\u2019t", "\u2026", "3.14", "\u0130\u03a3"])
    clause = lambda: " ".join(word() for _ in range(rng.randint(1, 9))) + rng.choice([". ", ", ", ".", "\u3002", "!\n", "\n", " ;", "; "])
    pool = ["".join(clause() for _ in range(rng.randint(1, 9))) for _ in range(25)]
    rows = [(i, "".join(rng.choices([*pool, "", "\n\n", " . ", clause()], k=rng.randint(0, 7)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, pool[0] + "\n" + "\n".join(f"{i} line of a very long text with words enough" for i in range(2_000)))]
    return [*rows, (203, "th. " * 90), (204, " .\n"), (205, "\u6f22" * 90 + "\u3002"), (206, "\u6f22" * 90 + "\u3002"), (None, pool[1]), (None, None)]


def test_cleaned_equals_brute(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as removed", "3 as pos", "4 as codes", "5 as `a.b`", "6 as c0")
    want = brute_clean(rows)
    assert sum(bool(x[1]) for x in want.values()) > 30
    got, stage = S.cleaned(docs).collect(), S.without_repeats(docs)
    assert stage.columns == docs.columns and len(got) == len(rows)
    for r in got:
        if r.doc_id is None or r.doc_id == 200:
            assert not r.removed and (r.doc_id, r.text) in rows
        else:
            assert (r.text, [(s.start, s.end) for s in r.removed]) == want[r.doc_id]
    assert sorted(((r[0], r[1]) for r in stage.collect()), key=str) == sorted(((r.doc_id, r.text) for r in got if not r.removed or r.text.strip()), key=str)
    assert S.cleaned(docs.limit(0)).count() == S.without_repeats(docs.limit(0)).count() == 0


def test_sql_equals_brute():
    duckdb = pytest.importorskip("duckdb")
    import pandas as pd

    rows = [r for r in made_rows() if r[0] is not None]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    got = {d: (t, r) for d, t, r in con.sql(S.SQL).fetchall()}
    want = {d: (t, ",".join(f"{a}-{b}" for a, b in s)) for d, (t, s) in brute_clean(rows).items()}
    assert got == want | {200: (None, "")}


def test_translation_and_lower_case_keep_the_places():
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000).translate(S._TABLE)
    assert len(every.lower()) == len(every)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a b c d e. ", "f g, ", "h\n", "i j k l m n o p. ", "q r s t u v w; "]), max_size=14).map("".join), max_size=6))
def test_what_goes_stays_somewhere(texts):
    out = brute_clean(list(enumerate(texts)))
    u, first, late = S.Units(texts), {}, [[] for _ in texts]
    for t, code, d1, again in zip(u.text.tolist(), u.codes().tolist(), u.d1.tolist(), u.again.tolist()):
        if first.setdefault(d1, t) != t or again:
            late[t].append(code)
    left, _ = S.cut(texts, late)
    assert left == [out[i][0] for i in range(len(texts))]
    kept = {tuple(c[2]) for t in left for c in clauses(t)}
    assert all(tuple(c[2]) in kept for t in texts for c in clauses(t))


def test_a_passage_inside_lines_goes(spark):
    rng = random.Random(1)
    say = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) + (", " if i % 7 == 6 else ". " if i % 11 == 10 else "") for i in range(n))
    passage = say(70)
    rows = [(i, f"{say(40)} {passage} {say(40)}") for i in range(4)]
    got = {r.doc_id: r.text for r in S.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    words = passage.split()
    for i in (1, 2, 3):
        left = got[i].split()
        assert sum(w in left for w in words) < 20 and sum(w in left for w in rows[i][1].split() if w not in words) == 80


def test_spans_are_of_the_original():
    t = "a b c d e f g h\nbb\nA b c d e f, g h\ndd"
    u = S.Units([t])
    out, spans = S.cut([t, None, t], [u.codes()[u.again].tolist(), [0], None])
    assert out == ["a b c d e f g h\nbb\ndd", None, t] and spans[0] == [(19, 36)] and t[19:36] == "A b c d e f, g h\n"


def test_repeated_ids_and_ties(spark):
    line = "one two three four five six seven eight nine"
    rows = [(1, line), (1, line), (2, line + "!"), (3, line + "\n" + line.upper() + "\nshort one"), (4, "keep me"), (5, None), (None, line), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "length(text) as n_chars", "1 as __id", "2 as __lines", "3 as gone", "4 as `x.y`", "5 as id")
    out = S.without_repeats(docs)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got = sorted(((r[0], r[1], r[3]) for r in out.collect()), key=str)
    assert got == sorted([(1, line, len(line)), (1, line, len(line)), (3, "short one", 9), (4, "keep me", 7), (5, None, None), (None, line, len(line)), (6, "", 0)], key=str)


def levenshtein_within(item, text):
    """Least distance of item to any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row), row.index(min(row))


@settings(max_examples=150, deadline=None)
@given(st.text("abc é", min_size=1, max_size=80), st.text("abc é", max_size=120), st.integers(0, 9))
def test_myers_equals_the_table(item, text, k):
    k = min(k, len(item) - 1)  # a budget is always below the length
    d, end = levenshtein_within(item, text)
    got = D.Pattern(item).within(text, k)
    assert got == ((d, end) if d <= k else None) or (got and got[0] == d)


def edited(rng, s, k):
    for _ in range(k):
        i = rng.randrange(len(s))
        s = rng.choice([s[:i] + s[i + 1 :], s[:i] + "q" + s[i:], s[:i] + "z" + s[i + 1 :]])
    return s


def brute_matches(docs, items, rate):
    out = []
    for d, t in docs:
        for i, x in items:
            a, b = D.normalise(x), D.normalise(t)
            if a and b and (m := levenshtein_within(a, b))[0] <= int(len(a) * rate):
                out.append((d, i, m[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("slice_chars", "pass_chars", "held"), [(D.SCAN_CHARS, D.PASS_CHARS, D.HELD_CHARS), (40, 400, 700)])
def test_matches_equal_brute(spark, slice_chars, pass_chars, held, monkeypatch):
    for name, value in (("SCAN_CHARS", slice_chars), ("PASS_CHARS", pass_chars), ("HELD_CHARS", held)):
        monkeypatch.setattr(D, name, value)
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 7)))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [(i, say(rng.randint(3, 20))) for i in range(12)] + [(50, None), (51, ""), (52, "..."), (53, "one")]
    docs = [(i, f"{say(15)} {edited(rng, rng.choice(items[:12])[1], rng.randint(0, 5))}, {say(15)}") for i in range(40)]
    docs += [(90, None), (91, ""), (92, " ".join(say(200) for _ in range(3)) + " One. " + say(20)), (None, items[0][1].upper()), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as distance")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = sorted([(r.doc_id, r.item_id, r.distance) for r in D.matches(df, bench).collect()], key=str)
    assert got == brute_matches(docs, items, D.ERROR_RATE) and len(got) > 15
    kept = D.decontaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == ({d for d, _ in docs} - {g[0] for g in got if g[0] is not None})
    assert {len(D.matches(df, bench.selectExpr(f"cast(item_id as {k}) as item_id", "text", "text as distance")).collect()) for k in ("tinyint", "decimal(9,2)", "string")} == {len(got)}
    odd = D.decontaminated(df.selectExpr("*", "1 as `a.b`", "2 as gone", "3 as c0"), bench)
    assert odd.columns[-3:] == ["a.b", "gone", "c0"] and odd.count() == kept.count()
    assert D.matches(df, bench.limit(0)).count() == 0 and D.matches(df.limit(0), bench).count() == 0
