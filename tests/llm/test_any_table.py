"""What every operator owes to any table: nulls, empty and long texts, repeated rows, no rows,
and columns named like its own."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from silverlode.llm.decontamination import contamination
from silverlode.llm.language_id import language_mixtures
from silverlode.llm.license_scan import license_scan
from silverlode.llm.line_dedup import drop_boilerplate
from silverlode.llm.near_dedup import near_duplicates
from silverlode.llm.packing import pack
from silverlode.llm.quality_model import quality
from silverlode.llm.quality_rules import clean_lines
from silverlode.llm.token_counts import token_counts
from silverlode.llm.toxicity import toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def operators(spark, benchmark, labels):
    items = benchmark(["one two three four five six seven eight nine ten eleven", "", None])
    marks = labels([(n, n % 2, (n + 1) % 2) for n in range(8)] + [(None, 1, 1), (1, None, None)])
    return {
        "line_dedup": lambda docs: drop_boilerplate(spark, docs),
        "language_id": lambda docs: language_mixtures(spark, docs),
        "decontamination": lambda docs: contamination(spark, docs, items),
        "quality_model": lambda docs: quality(spark, docs, marks),
        "quality_rules": clean_lines,
        "license_scan": lambda docs: license_scan(docs),
        "token_counts": lambda docs: token_counts(spark, docs, PIECE),
        "toxicity": lambda docs: toxicity(spark, docs, marks),
        "packing": lambda docs: pack(docs, WORD),
        "near_dedup": lambda docs: near_duplicates(spark, docs),
    }


NAMES = [
    "line_dedup", "language_id", "decontamination", "quality_model", "quality_rules",
    "license_scan", "token_counts", "toxicity", "packing", "near_dedup",
]
BY_ROW = [name for name in NAMES if name not in ("license_scan", "packing")]


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(name, operators, documents):
    assert operators[name](documents([])).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_nulls_empty_long_and_repeated(name, operators, documents, spark):
    docs = documents([
        None, "", "\n\n", "one two", (1, ""), (None, "one two"), (None, None),
        "word " * 30_000, "x" * 100_000, ("é́ 日本 " * 50)[:200], "a\x00b ퟿",
    ]).union(spark.createDataFrame([(0, "one two", None, None, None)] * 3, documents([]).schema))
    result = operators[name](docs)
    collected = result.collect()
    if name in BY_ROW:
        assert len(collected) == docs.count()
        assert sorted(r.doc_id for r in collected if r.doc_id is not None) == sorted(
            r.doc_id for r in docs.select("doc_id").collect() if r.doc_id is not None
        )
    repeated = [tuple(r) for r in collected if r.doc_id == 0 and getattr(r, "lang", 1) is None]
    if name in BY_ROW and name != "near_dedup":
        assert len(repeated) == 3 and len(set(map(repr, repeated))) == 1


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns(name, operators, documents):
    more = (
        "_row string, _id string, _text string, k1 string, hits string, kept string, "
        "score string, node string, label string, words string, n_words string, title string"
    )
    values = tuple("x" * 12)
    docs = documents(["one two three", "four five six\nseven"], more=more, values=values)
    result = operators[name](docs)
    assert len(result.columns) == len(set(result.columns))
    assert result.count() in (0, 2)
    if name in BY_ROW:
        assert [r.title for r in result.select("title").collect()] == ["x", "x"]
        assert "_row" in result.columns and result.filter(F.col("_row") == "x").count() == 2
