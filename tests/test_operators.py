from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import rows
from silverlode import Job, Limits
from silverlode.operators import (
    add_dense_key,
    balanced_join,
    bottom_k,
    hot_keys,
    latest_per_key,
    long_measures,
    top_dense_ranks,
    top_k,
    top_row_numbers,
    with_grand_total,
    with_group_max,
    with_next_value,
)
from silverlode.operators.joins import is_small
from silverlode.sources import Files


def stored(job, values, schema, parts=3):
    """A table on storage with its rows spread over several files."""
    return job.stage(job.spark.createDataFrame(values, schema).repartition(parts), "test")


@pytest.fixture
def skewed(hot_job):
    """300 rows: a third under one key, a third under NULL, the rest one or two per key."""
    values = [("hot", i % 40, i) for i in range(100)] + [(None, i % 7, 100 + i) for i in range(100)]
    values += [(f"k{i % 60}", i, 200 + i) for i in range(100)]
    return stored(hot_job, values, "k string, v int, id int")


def test_hot_keys(job, hot_job, skewed):
    assert hot_keys(job, skewed, "k") is None
    found = {row.key: row.rows for row in hot_keys(hot_job, skewed, "k").collect()}
    assert found == {"hot": 100, None: 100}


def test_hot_limit_bounds_the_number_of_hot_keys(spark):
    limits = Limits(hot_rows=10, hot_keys=100)
    assert limits.hot_limit(500) == 10
    assert limits.hot_limit(1_000_000) == 10_000


def test_latest_per_key_breaks_ties_by_the_other_columns(job):
    values = [(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (1, "2024-02-01", "c"), (2, None, "d"),
              (2, "2020-01-01", None), (None, "2024-01-01", "e")]
    df = stored(job, values, "k int, at string, x string")
    assert rows(latest_per_key(df, "k", by="at")) == rows(job.spark.createDataFrame(
        [(1, "2024-02-01", "c"), (2, "2020-01-01", None), (None, "2024-01-01", "e")], df.schema
    ))


def test_group_max_is_the_same_for_hot_keys(job, hot_job, skewed):
    greatest = defaultdict(int)
    for key, value, _ in rows(skewed):
        greatest[key] = max(greatest[key], value)
    expected = sorted(((k, greatest[k], i) for k, _, i in rows(skewed)), key=repr)
    assert rows(with_group_max(job, skewed, "k", ["v"])) == expected
    assert rows(with_group_max(hot_job, skewed, "k", ["v"])) == expected


def test_group_max_of_nulls(hot_job):
    df = stored(hot_job, [("a", None, 1), ("a", None, 2), ("a", None, 3), ("b", 5, 4), ("b", None, 5)],
                "k string, v int, id int")
    got = {row.id: row.v for row in with_group_max(hot_job, df, "k", ["v"]).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 5, 5: 5}


def test_next_value_is_the_same_for_hot_keys(job, hot_job, skewed):
    groups = defaultdict(list)
    for key, value, id_ in rows(skewed):
        groups[key].append((value, id_))
    following = {}
    for members in groups.values():
        members.sort()
        for here, there in zip(members, members[1:] + [(None, None)]):
            following[here[1]] = there[1]
    for one_job in (job, hot_job):
        got = with_next_value(one_job, skewed, "k", ["v", "id"], "id", "next")
        assert {row.id: row.next for row in got.collect()} == following
        assert got.count() == 300


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_dense_key_numbers_all_rows_in_order(spark, job, skewed, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = add_dense_key(job, skewed, ["k", "v", "id"], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(rows(skewed), key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert [tuple(row)[1:] for row in sorted(got, key=lambda r: r.n)] == ordered
    assert sorted(row.n for row in got) == list(range(1, 301))


def test_dense_key_splits_copies_of_one_row(spark, job):
    """Identical rows are dealt to several ranges and still get distinct, gapless keys."""
    copies = job.stage(spark.range(0, 4000, 1, 4).select(F.lit("same").alias("k")), "copies")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        keyed = add_dense_key(job, copies, ["k"], "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert keyed.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 4000, 4000)
    ranges = spark.read.parquet(f"{job.folder}/staged/placed-*").groupBy("_range").count().collect()
    assert len(ranges) == 4 and max(row["count"] for row in ranges) < 2000


def test_dense_key_of_nothing(job, skewed):
    assert add_dense_key(job, skewed.filter("false"), ["k"], "n").count() == 0


def brute_join(left, right, how):
    out = []
    for a in left:
        matches = [b for b in right if a[0] is not None and a[0] == b[0]]
        if how == "left_semi":
            out += [a] if matches else []
        else:
            out += [a + b for b in matches]
            if how == "left" and not matches:
                out.append(a + (None,) * len(right[0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("right_values", [
    [("hot", 1), ("k1", 2), ("k2", 3), ("k99", 4)],
    [("hot", i) for i in range(11)] + [("k1", 20), ("k1", 21), (None, 22), (None, 23), (None, 24)],
    [("k3", i) for i in range(9)] + [("absent", i) for i in range(9)],
    [("absent", 1)],
], ids=["one each", "hot on both sides", "hot on the right", "no match"])
def test_joins_give_every_pair_once(job, hot_job, skewed, how, right_values):
    right = stored(hot_job, right_values, "rk string, w int", parts=2)
    expected = brute_join(rows(skewed), rows(right), how)
    assert rows(balanced_join(job, skewed, right, "k", "rk", how)) == expected
    assert rows(balanced_join(hot_job, skewed, right, "k", "rk", how)) == expected


def test_join_is_broadcast_only_below_the_limit(spark, skewed, hot_job):
    right = stored(hot_job, [(f"k{i}", i) for i in range(30)], "rk string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        def plan(limit):
            one = Job(spark, limits=Limits(broadcast_rows=limit), folder=hot_job.folder)
            joined = balanced_join(one, skewed, right, "k", "rk")
            return joined._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan(30)
        assert "SortMergeJoin" in plan(29) and "Broadcast" not in plan(29)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_rows_are_not_small(spark, job):
    df = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("text"))
    assert is_small(Job(spark, limits=Limits(broadcast_bytes=10_010), folder=job.folder), df)
    assert not is_small(Job(spark, limits=Limits(broadcast_bytes=10_009), folder=job.folder), df)
    assert is_small(job, df.filter("id > 99"))


def test_unknown_join_type_is_refused(job, skewed):
    with pytest.raises(ValueError):
        balanced_join(job, skewed, skewed, "k", "k", "full")


def test_hot_rows_are_spread(spark, hot_job, skewed):
    """No join task gets all rows of the hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        right = stored(hot_job, [("hot", 1), ("k1", 2)], "rk string, w int")
        joined = balanced_join(hot_job, skewed, right, "k", "rk")
        tasks = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) == 4 and max(row["count"] for row in tasks) < 60


def test_long_measures(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v int")
    got = long_measures(df, ["a", "b"], "n", {
        ("x", "rows"): F.count("*"), ("x", "distinct"): F.count_distinct("v"), ("y", "sum"): F.sum("v"),
    })
    assert rows(got) == [("x", "distinct", 2), ("x", "rows", 4), ("y", "sum", 5)]
    empty = long_measures(df.filter("false"), ["a"], "n", {("bad",): F.count_if(F.col("v") > 1)})
    assert rows(empty) == [("bad", 0)]


def test_grand_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", None)], "k string, v int")
    assert rows(with_grand_total(df, "v", "t")) == [("a", 1, 6), ("b", 5, 6), ("c", None, 6)]


def test_ranking_with_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 10), ("b", 10), ("c", 8), ("d", 8), ("e", 5), ("f", None)], "k string, v int"
    )
    assert [row.k for row in top_k(df, "v", 3, ["k"]).collect()] == ["a", "b", "c"]
    assert [row.k for row in bottom_k(df, "v", 2, ["k"]).collect()] == ["f", "e"]
    assert rows(top_row_numbers(df, "v", 3, ["k"], "n")) == [("a", 10, 1), ("b", 10, 2), ("c", 8, 3)]
    assert rows(top_dense_ranks(df, "v", 2, "r")) == [("a", 10, 1), ("b", 10, 1), ("c", 8, 2), ("d", 8, 2)]
    assert ("f", None, 4) in rows(top_dense_ranks(df, "v", 4, "r"))


def test_many_rows_are_not_read_to_measure_their_bytes(job):
    class Counted:
        """Only its rows can be asked for."""

        def count(self):
            return job.limits.broadcast_rows + 1

    assert not is_small(job, Counted())


def test_hot_keys_are_looked_up_once(hot_job, skewed):
    first = hot_keys(hot_job, skewed, "k")
    assert hot_keys(hot_job, skewed.select("*"), "k") is first
    assert hot_keys(hot_job, skewed.filter("v > 1"), "k") is not first


def test_stored_rows_are_staged_once_for_a_dense_key(spark, job):
    stored = job.stage(spark.range(100), "given")
    keyed = add_dense_key(job, stored, ["id"], "n", stored=True)
    assert [row.n for row in keyed.orderBy("id").collect()] == list(range(1, 101))
    names = [name.split("-")[0] for name in Files(spark).names(f"{job.folder}/staged")]
    assert sorted(names) == ["given", "placed"]


def test_next_value_of_ties_does_not_depend_on_hot_keys(spark, job):
    rows_ = [("a", 1, k, str(k % 3)) for k in range(40)]
    df = job.stage(spark.createDataFrame(rows_, "k string, o int, v int, w string"), "ties")
    hot = Job(spark, limits=Limits(broadcast_rows=0, hot_rows=2), folder=job.folder)
    got = [rows(with_next_value(one, df, "k", ["o"], "v", "next")) for one in (job, hot)]
    assert got[0] == got[1]
