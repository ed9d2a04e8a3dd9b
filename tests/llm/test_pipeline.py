"""The pipeline against plain versions of its stages, each on the stage's own input."""

import duckdb
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_lines_and_licenses import brute as without_boilerplate
from test_near_dedup import brute as classes
from test_quality import brute as judged
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from silverlode.job import Job
from silverlode.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first and after each stage."""
    job = Job(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit("own"))
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = job.stage(stage(spark, docs, SF), "stage")
        found.append(docs.collect())
    return found


def texts(rows):
    return sorted((r.doc_id, r.text) for r in rows)


def test_stage_order_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        assert all(r.n_chars == len(r.text) and r.kept == "own" for r in rows)


def test_rules(stages):
    expected = [(r.doc_id, judged(r.text)) for r in stages[0]]
    assert texts(stages[1]) == sorted((name, j[8]) for name, j in expected if j[7])


def test_a_phrase_in_a_long_line_fails_nothing(spark, documents):
    long = " ".join(f"word{k}" for k in range(150))
    article = f"{long} and their privacy policy says so, page not found or not, {long[::-1]}."
    banner = "This site uses cookies, as our privacy policy and our terms of use tell you at length."
    small = " ".join(f"w{k}" for k in range(200)) + "."
    other = " ".join(f"v{k}" for k in range(200)) + "."
    wide = "privacy policy | " * 20 + "terms of use and all rights reserved"
    found = corpus_pipeline.quality_rules(spark, documents([
        article, f"{banner}\n{article}\nAll rights reserved.", f"{small}\n{wide}\n{other}",
        "page not found " * 20,
    ]), SF)
    assert texts(found.collect()) == [(0, article), (1, article), (2, f"{small}\n{other}")]


def test_lines(stages):
    rows = [(r.doc_id, r.source, r.text) for r in stages[1]]
    assert texts(stages[2]) == sorted(r[:2] for r in without_boilerplate(rows, 0.1, 5, copies_once=True))


def test_one_of_each_class(stages):
    rows = [(r.doc_id, r.text) for r in stages[2]]
    of = dict(zip((name for name, _ in rows), classes(rows)))
    assert sorted(of[r.doc_id] for r in stages[3]) == sorted(set(of.values()))


def test_benchmark_passages_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in stages[3]]
    clean = {r[0] for r in contaminated(rows, items) if not r[5]}
    assert {r.doc_id for r in stages[4]} == clean


def test_all_ids_are_packed(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {}
    for piece in sorted(stages[5], key=lambda p: (p.doc_id, p.start)):
        ids.setdefault(piece.doc_id, []).append(piece.ids)
    for row in stages[4]:
        own = np.frombuffer(b"".join(ids.pop(row.doc_id)), "<u4").tolist()
        assert own == [*library.encode(row.text, add_special_tokens=False).ids, 2]
    assert not ids


def test_run_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF).count() > 0
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {"pipeline", *(f"op{k}" for k in range(1, 14))}
    assert set(oracle.oracle_sql()) < names


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_queries_like_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.sql(oracle.oracle_sql()[name])
    found = queries.queries()[name](spark, SF).select(*expected.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected.fetchall(), key=repr)
