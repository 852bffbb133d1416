import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import chunking, eligibility, planning
from sluice.sources import readers

PARAGRAPH = "Uma frase em português que se repete para encher o parágrafo até o fim. " * 8


def test_pieces():
    own = chunking.pieces("A" * 600 + " " + "B" * 600 + " " + "C" * 600, 800, 100)
    assert len(own) == 3 and max(map(len, own)) <= 800
    assert [len(p) for p in chunking.pieces("A" * 1300, 500, 0)] == [500, 500, 300]
    assert chunking.pieces("   ") == [""] and chunking.pieces(" x ") == ["x"]
    text = "One sentence here. " * 100
    assert all(p.endswith(".") for p in chunking.pieces(text, 200, 30))
    assert chunking.pieces("a" * 300 + "\n\n" + "b" * 300, 400, 0)[0] == "a" * 300


def docs(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, title string, sections array<struct<id:string,text:string,title:string>>")


def test_chunked(spark):
    rows = [("a", "A" * 1300, "T", None), ("b", None, "U", []), ("c", "x", None, [("9", "  ", "s"), ("7", "B" * 600, "s"), ("7", "tail", "q")])]
    out = {r.id: [(s.id, len(s.text), s.title) for s in r.sections] for r in chunking.chunked(docs(spark, rows), 500, 0).collect()}
    assert out["a"] == [("0", 500, "T"), ("1", 500, "T"), ("2", 300, "T")]
    assert out["b"] == [("0", 0, "U")]
    assert out["c"] == [("0", 500, "s"), ("1", 100, "s"), ("2", 4, "q")]
    assert chunking.chunked(docs(spark, rows).limit(0)).count() == 0


def test_pick(spark):
    df = chunking.chunked(docs(spark, [("a", "A" * 1300, "T", None)]), 500, 0)
    pick = lambda c, k: df.select(chunking.pick(F.col("sections"), F.lit(c).cast("string"), F.lit(k))).first()[0]
    assert pick("1", 0).id == "1" and pick("8", 4).id == "1" and pick(None, 0) is None


def test_profiles(spark):
    rows = [
        ("ok", PARAGRAPH, "Livro/Capitulo", "0"), ("ns", PARAGRAPH, "Livro", "102"), ("bad", PARAGRAPH, "Livro", "x"), ("none", PARAGRAPH, "Livro", None), ("short", "curto", "Livro", "0"),
        ("cat", PARAGRAPH, " Categoria : X", "0"), ("wiki", PARAGRAPH, "WIKIPÉDIA:Y", "0"), ("redir", "# REDIRECT [[x]]\n\n" + PARAGRAPH, "L", "0"), ("dis", "Desambiguação\n\n" + PARAGRAPH, "L", "0"), ("blank", "  ", "L", "0"),
    ]
    df = spark.createDataFrame(rows, "id string, text string, title string, ns string")
    kept = lambda p: {r.id for r in df.where(eligibility.eligible(F.col("text"), F.col("title"), F.col("ns"), p)).collect()}
    assert kept("wikipedia_ptbr") == {"ok"}
    assert kept("wikibooks_ptbr") == {"ok", "ns", "bad", "none"}
    assert kept(None) == kept("unheard of") == {r[0] for r in rows} - {"blank"}


def test_filters_and_strata(spark):
    df = spark.createDataFrame([("a", ("x", 1)), ("b", ("y", None)), ("c", (None, 2))], "id string, metadata struct<d:string,n:int>")
    keep = lambda f: {r.id for r in df.where(eligibility.matches(f, eligibility.resolver(df))).collect()}
    assert keep({"metadata.d": ["x", "y"]}) == {"a", "b"} and keep({"metadata.d": None}) == {"c"} and keep({"metadata.q": None}) == {"a", "b", "c"}
    assert keep({"metadata.d": "x", "metadata.n": 2}) == set() and keep({}) == {"a", "b", "c"}
    assert [r[0] for r in df.orderBy("id").select(eligibility.stratum(df, ["metadata.d", "metadata.zz"])).collect()] == [["x", "<missing>"], ["y", "<missing>"], ["None", "<missing>"]]


def test_readers(spark, tmp_path):
    lines = tmp_path / "a.jsonl"
    lines.write_text("".join(json.dumps({"id": f"doc-{i}", "text": f" Text {i} ", "domain": "d", "title": ""}) + "\n\n" for i in range(8)))
    out = readers.documents(readers.with_index(readers.read(spark, str(lines)))).orderBy("metadata.raw_index").collect()
    assert [r.id for r in out] == [f"doc-{i}" for i in range(8)] and out[3].text == "Text 3" and out[0].title == "" and out[2].metadata.domain == "d" and out[5].metadata.raw_index == 5
    (tmp_path / "b.json").write_text(json.dumps({"records": [{"page_id": 7, "body": "x", "heading": "h"}]}))
    r = readers.documents(readers.with_index(readers.read(spark, str(tmp_path / "b.json"))), {"id": "page_id", "text": "body", "title": "heading"}).first()
    assert (r.id, r.text, r.title) == ("7", "x", "h")
    (tmp_path / "c.json").write_text('[{"text": "one"}, {"text": null}]')
    out = readers.documents(readers.with_index(readers.read(spark, str(tmp_path / "c.json"))), {"id": "__row_index__"}).collect()
    assert sorted((r.id, r.text) for r in out) == [("0", "one"), ("1", "")]
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"a": 1}\n[2]\n')
    with pytest.raises(readers.SourceError, match=r"bad.jsonl:2"):
        readers.read(spark, str(bad))
    with pytest.raises(readers.SourceError, match="unsupported"):
        readers.read(spark, "x.csv")
    with pytest.raises(readers.SourceError, match="remote"):
        readers.remote()
    spark.createDataFrame([("p1", "Parquet text.")], "id string, text string").write.parquet(str(tmp_path / "d.parquet"))
    assert readers.read(spark, str(tmp_path / "d.parquet")).first().id == "p1"
    both = readers.read_splits(spark, {"train": str(tmp_path / "d.parquet"), "test": str(tmp_path / "c.json")})
    assert both.count() == 3 and both.where("__source_split = 'test'").count() == 2


def test_sections(spark):
    item = "struct<id:int,section_id:string,text:string,content:string,title:string,heading:string>"
    rows = [("a", [(0, "s9", "", " body ", None, "H"), (3, None, " ", None, None, None), (4, None, "t", None, "T", "H")]), ("b", None)]
    df = spark.createDataFrame(rows, f"id string, sections array<{item}>")
    out = {r.id: [(s.id, s.text, s.title) for s in r.s] for r in df.select("id", readers.sections(df, "sections").alias("s")).collect()}
    assert out == {"a": [("s9", "body", "H"), ("4", "t", "T")], "b": []}
    df = spark.createDataFrame([("x",), (None,)], "sections string")
    assert [[s.text for s in r[0]] for r in df.select(readers.sections(df, "sections")).collect()] == [["x"], []]
    df = spark.createDataFrame([(["u", " ", "v"],)], "sections array<string>")
    assert [(s.id, s.text) for s in df.select(readers.sections(df, "sections")).first()[0]] == [("0", "u"), ("2", "v")]


def test_preflight(spark):
    df = spark.createDataFrame([(PARAGRAPH, i % 2) for i in range(8)], "text string, ns int")
    take = eligibility.eligible(F.col("text"), None, F.col("ns"), "wikipedia_ptbr")
    run = lambda **k: planning.preflight(df, take, **k).first().asDict()
    got = run(minimum=14, maximum=14)
    assert (got["total_rows"], got["eligible_documents"], got["recommended_examples"]) == (8, 4, 56)
    got = run(fraction=0.25, minimum=14, maximum=14)
    assert (got["selected_documents"], got["recommended_examples"]) == (1, 14)
    assert run(count=9, minimum=1, maximum=2)["recommended_examples"] is None
    for bad in ({"count": 1, "fraction": 0.5}, {"fraction": 0.0}, {"minimum": 3, "maximum": 2}):
        with pytest.raises(planning.PlanError):
            run(**bad)


def test_index_takes_lengths_not_chunks(spark):
    """The index is the one of the chunks, but Python gives their lengths alone."""
    rows = [("a", "A" * 1300, "T", None), ("b", "One. Two.\n\n" * 90, "T", None), ("c", " ", None, None), ("d", None, None, None), ("e", "é\U0001d400 " * 400, None, None)]
    df = docs(spark, rows).withColumns({"source": F.lit("s"), "license": F.lit(None).cast("string")})
    own, ready = chunking.corpus_index(df, ["source"], 500, 50), chunking.corpus_index(chunking.chunked(df, 500, 50), ["source"], ready=True)
    assert sorted(map(str, own.collect())) == sorted(map(str, ready.collect()))
    assert df.select(chunking.chunk_lengths(df).alias("n")).schema["n"].dataType.simpleString() == "array<int>"


def test_plans_read_an_index_without_chunk_texts(spark, tmp_path, monkeypatch):
    """Whatever the plan, Python gives the index no nested texts: chunks themselves aren't asked for."""
    from sluice.plans import catalog

    spark.createDataFrame([(i, "A sentence of it. " * (i % 9 * 40 + 1), "en", "s", 0) for i in range(80)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(chunking, "chunked", None)
    got = catalog.roles_primary_reserve_active(spark, str(tmp_path)).collect()
    assert len(got) == 40 and {r.role for r in got} == {"primary", "reserve"}
