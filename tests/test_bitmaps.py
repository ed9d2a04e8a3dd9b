import pytest

from helpers import rows
from silverlode import Job, Limits
from silverlode.operators import reduced_join, rolled_up_distinct
from silverlode.operators.bitmaps import CHUNK


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LEFT = [(k % 300, k) for k in range(3000)] + [(7, k) for k in range(2000)] + [(None, 1), (None, 2)]
RIGHT = [(k,) for k in range(0, 500, 3)] * 2 + [(None,)]


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("bits", [CHUNK, 1 << 20])
@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, hot_rows=500)])
def test_reduced_joins_like_plain_ones(spark, how, bits, limits):
    job = Job(spark, limits=limits)
    left = job.stage(spark.createDataFrame(LEFT, "k long, v long"), "left")
    right = spark.createDataFrame(RIGHT, "r long")
    known = {k for k, in RIGHT if k is not None}
    expected = [row for row in LEFT if (row[0] in known) == (how == "left_semi")]
    assert rows(reduced_join(job, left, right, "k", "r", how, bits)) == sorted(expected, key=repr)


def test_a_full_filter_changes_nothing(spark):
    job = Job(spark, limits=Limits(broadcast_rows=0))
    left = job.stage(spark.range(40_000).withColumnRenamed("id", "k"), "left")
    right = spark.range(0, 400_000, 2).withColumnRenamed("id", "r")
    anti = reduced_join(job, left, right, "k", "r", "left_anti", bits=CHUNK)
    assert sorted(r.k for r in anti.collect()) == list(range(1, 40_000, 2))


def test_rows_are_filtered_before_the_shuffle(spark):
    job = Job(spark, limits=Limits(broadcast_rows=0))
    left = job.stage(spark.range(1000).withColumnRenamed("id", "k"), "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        semi = reduced_join(job, left, spark.range(9).toDF("r"), "k", "r", "left_semi")
        lines = plan(semi).splitlines()
        exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)
        below = "\n".join(lines[exchange + 1 :])
        assert "_bits" in below.split("FileScan")[0] and "Filter" in below.split("FileScan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_counts_roll_up(spark, job):
    data = [(k % 3 or None, k % 7, k * 37 % 90_000, k % 5 or None) for k in range(4000)]
    df = spark.createDataFrame(data, "y int, m int, a long, b long")
    found = rows(rolled_up_distinct(job, df, ["y", "m"], {"a_n": "a", "b_n": "b"}))
    expected = []
    for level in (0, 1, 2):
        groups = {}
        for y, m, a, b in data:
            own = groups.setdefault((y, m)[:level], (set(), set()))
            own[0].add(a)
            own[1].add(b)
        expected += [(level, *group, *[None] * (2 - level), len(a - {None}), len(b - {None}))
                     for group, (a, b) in groups.items()]
    assert found == sorted(expected, key=repr)


def test_distinct_counts_of_a_table_read_once(spark, job, tmp_path):
    spark.range(50).selectExpr("id % 4 as y", "id as a").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    none = rolled_up_distinct(job, table.filter("y > 9"), ["y"], {"n": "a"})
    assert rows(none) == [(0, None, 0)]
    found = rolled_up_distinct(job, table, ["y"], {"n": "a"})
    # The result comes from the staged bitmaps alone.
    assert str(tmp_path) not in plan(found) and rows(found)[0] == (0, None, 50)
