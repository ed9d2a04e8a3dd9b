import pytest

from helpers import rows
from silverlode import Job
from silverlode.operators import with_running

# Most rows belong to one group; ties, repeated rows, and NULL in every column.
ROWS = [(1, k % 50, k % 7 - 3, k) for k in range(900)] + \
    [(k % 5, k % 3, None, 0) for k in range(40)] + \
    [(None, k % 4 or None, k, None) for k in range(30)] + [(9, None, None, None)] * 3


def running(data, grouped=True):
    """Brute force: sums of v and counts of w along each group."""
    def low(value):
        return (value is not None, value or 0)

    totals, out = {}, []
    for g, o, v, w in sorted(data, key=lambda row: [low(value) for value in row]):
        total, count = totals.get(g if grouped else 0, (None, 0))
        total = total if v is None else (total or 0) + v
        count += w is not None
        totals[g if grouped else 0] = total, count
        out.append((g, o, v, w, total, count))
    return sorted(out, key=repr)


@pytest.fixture(params=[1, 4, 23])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("data", [ROWS, ROWS[:1], []])
def test_like_brute_force(spark, partitions, data):
    df = spark.createDataFrame(data, "g int, o int, v int, w int")
    found = with_running(Job(spark), df, ["g"], ["o"], {"total": "v"}, {"seen": "w"})
    assert rows(found) == running(data)


def test_over_the_whole_table(spark, partitions):
    # One order for all rows, whatever their group.
    df = spark.createDataFrame(ROWS, "g int, o int, v int, w int")
    found = with_running(Job(spark), df, [], ["g", "o"], {"total": "v"}, {"seen": "w"})
    assert rows(found) == running(ROWS, grouped=False)


def test_names_that_clash(spark, job):
    df = spark.range(3).toDF("v")
    for sums, counts in (({"v": "v"}, {}), ({"n": "v"}, {"n": "v"})):
        with pytest.raises(ValueError, match="taken"):
            with_running(job, df, [], ["v"], sums, counts)


def test_windows_see_a_range_and_the_remainders_alone(spark, job):
    df = job.stage(spark.createDataFrame(ROWS, "g int, o int, v int, w int"), "rows")
    found = with_running(job, df, ["g"], ["o"], {"total": "v"}, stored=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hash" in line]
    assert shuffles and all("(_range" in line for line in shuffles)
