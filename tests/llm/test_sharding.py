"""Shards against running sums in Python."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverlode.llm.sharding import contiguous_shards, text_size, write_shards


def brute(rows, shards):
    """(key, size, shard, slot) of (key, size) rows, nulls first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or 0))
    total, before, slots, result = sum(size or 0 for _, size in rows), 0, {}, []
    for key, size in rows:
        own = size or 0
        shard = min((2 * before + own) * shards // (2 * total), shards - 1) if total else 0
        result.append((key, size, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        before += own
    return sorted(result, key=repr)


def found(spark, rows, shards):
    frame = spark.createDataFrame(rows, "doc_id long, size long")
    result = contiguous_shards(spark, frame, order=["doc_id", "size"], shards=shards)
    return sorted(map(tuple, result.select("doc_id", "size", "shard", "slot").collect()), key=repr)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_like_running_sums(spark, shards):
    random.seed(shards)
    rows = [(k, int(random.paretovariate(1) * 50)) for k in range(500)]
    random.shuffle(rows)
    result = found(spark, rows, shards)
    assert result == brute(rows, shards)
    sizes = [0] * shards
    for _, size, shard, _ in result:
        sizes[shard] += size
    most = max(size for _, size in rows)
    assert all(abs(own - sum(sizes) / shards) <= most for own in sizes)


def test_one_key_with_most_rows(spark):
    rows = [(5, 10)] * 400 + [(k, 10) for k in range(100)]
    assert found(spark, rows, 7) == brute(rows, 7)


def test_nulls_zeros_and_one_huge_row(spark):
    rows = [(None, 3), (None, None), (1, 0), (2, 10**15), (3, 1), (3, 1), (4, None)]
    assert found(spark, rows, 5) == brute(rows, 5)
    assert found(spark, [(1, 0), (2, None)], 5) == [(1, 0, 0, 0), (2, None, 0, 1)]


def test_no_rows_and_refused_sizes(spark):
    assert found(spark, [], 4) == []
    with pytest.raises(PySparkException):
        found(spark, [(1, -2)], 4)
    with pytest.raises(ValueError):
        found(spark, [(1, 2)], 0)


def test_sizes_of_texts(documents):
    sizes = documents([None, "", "é\n", "x" * 200_000]).select("doc_id", text_size().alias("size"))
    assert sorted(map(tuple, sizes.collect())) == [(0, 16), (1, 16), (2, 19), (3, 200_016)]


def test_clashing_columns_and_written_shards(spark, tmp_path):
    frame = spark.range(100).select(
        F.col("id").alias("doc_id"), F.lit(8).alias("size"), F.lit("own").alias("_size"),
        F.lit("own").alias("shard"), F.concat(F.lit("t"), "id").alias("text"),
    )
    sharded = contiguous_shards(spark, frame, shards=5)
    assert sharded.columns == ["doc_id", "size", "_size", "text", "shard", "slot"]
    assert sharded.filter("_size = 'own'").count() == 100
    write_shards(sharded, str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r.shard, r.slot, r.doc_id) for r in read.collect()) == [
        (k // 20, k % 20, k) for k in range(100)]


def test_no_python_in_the_plan(spark):
    sharded = contiguous_shards(spark, spark.createDataFrame([(1, 2)], "doc_id long, size long"))
    plan = sharded._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
