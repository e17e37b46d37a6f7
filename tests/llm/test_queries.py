"""Registered queries against their SQL and against each other, on given tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillmark.llm import decontaminate, near_dup, packing, pii, quality, queries

SF = "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = queries.queries(), queries.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_names():
    assert list(QUERIES) == [
        "op1_topk", "op2_sharding", "op3_packing", "op4_decontaminate", "op5_html_text", "op6_pii",
        "op7_warc", "op8_near_dup", "op9_quality", "op10_url_rules", "op11_centroids", "op12_lexical",
        "op13_line_dedup", "pipeline",
    ]
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    described = {c[0]: str(c[1]) for c in database.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = database.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL and n != "pipeline"])
def test_one_row_per_document_or_page(spark, database, name):
    df = QUERIES[name](spark, SF)
    source, key = ("pages", "page_id") if name.startswith("op5") else ("documents", "doc_id")
    expected = {r[0] for r in database.execute(f"SELECT {key} FROM {source}").fetchall()}
    got = [r[0] for r in df.select(key).collect()]
    assert set(got) == expected
    if name != "op3_packing":
        assert len(got) == len(expected)


def test_pages_give_their_articles(spark, database):
    articles = dict(database.execute(
        "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html,"
        " '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) FROM pages"
    ).fetchall())
    for row in QUERIES["op5_html_text"](spark, SF).collect():
        text = articles[row.page_id].replace("&quot;", '"').replace("&amp;", "&")
        assert row.text == text and row.n_chars == len(text)


def test_pipeline_equals_its_parts(spark):
    """Each stage alone, on the rows that the plain report of its operator keeps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "pii", "packing"]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    good = stages["quality"](spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(good) == ids(quality.report(docs, labels).filter("predicted = 1"))
    unique = stages["near_duplicates"](spark, good, SF)
    assert ids(unique) == ids(near_dup.report(good).filter("kept"))
    clean = stages["decontamination"](spark, unique, SF)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(clean) == ids(decontaminate.report(unique, benchmark).filter("not contaminated"))
    private = stages["pii"](spark, clean, SF)
    for part in (good, unique, clean, private):
        assert part.columns == docs.columns
    before = {r.doc_id: r.text for r in clean.collect()}
    for row in private.collect():
        assert row.text == pii.redacted(before[row.doc_id], pii.find(before[row.doc_id]))
        assert row.n_chars == len(row.text)
        assert pii.detect(row.text) == []
    pieces = stages["packing"](spark, private, SF).collect()
    ids_of = packing.encoder(queries.TOKENIZER)
    totals = {r.doc_id: len(ids_of(r.text)) + 1 for r in private.collect()}
    assert {p.doc_id: p.doc_tokens for p in pieces} == totals
    assert sum(p.length for p in pieces) == sum(totals.values())
    whole = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    totals_of = F.sum("length").alias("n"), F.countDistinct("doc_id").alias("docs")
    assert set(key) <= set(whole.columns)
    assert whole.agg(*totals_of).first() == (sum(totals.values()), len(totals))


def test_stages_take_odd_documents(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and columns that clash with the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, score int"
    rows = [(None, None, None, None, None, 1, 2), (1, "", "en", "s", 0, 1, 2), (2, None, "en", "s", 0, 1, 2),
            (3, "long " * 30000, "en", "s", 150000, 1, 2), (4, "a@b.example same", "en", "s", 16, 1, 2),
            (4, "a@b.example same", "en", "s", 16, 1, 2)]
    sf = str(tmp_path)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{sf}/{name}.parquet")
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf)
            out.write.parquet(f"{sf}/{len(table)}-{name}")
            out = spark.read.parquet(f"{sf}/{len(table)}-{name}")
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
                docs = out
        found = {r.doc_id for r in out.collect()}
        assert found == ({None, 1, 2, 3, 4} if table else set())
