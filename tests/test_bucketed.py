import pytest

from helpers import AS_OF, rows
from silverlode import Job, Limits, Warehouse
from silverlode.schemas import BRONZE, LOAD_TIME
from silverlode.sources.bucketed import Buckets, bucketed_join, read_bucketed, write_bucketed

LEFT = [(k % 40, f"l{k}") for k in range(200)] + [(3, f"h{k}") for k in range(60)] + \
    [(None, f"n{k}") for k in range(30)] + [(5, "l5"), (5, "l5")]
RIGHT = [(k, f"r{k}") for k in range(0, 60, 3)] + [(9, f"m{k}") for k in range(50)] + \
    [(None, "none"), (3, "r3 again")]
WAYS = {
    "broadcast": Limits(),
    "buckets": Limits(broadcast_rows=0),
    "hot": Limits(broadcast_rows=0, hot_rows=20),
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, limits, counts=(4, 4), left=LEFT, right=RIGHT):
    job = Job(spark, limits=limits)
    found = []
    for data, names, count in ((left, ("k", "a"), counts[0]), (right, ("r", "b"), counts[1])):
        df = job.stage(spark.createDataFrame(data, f"{names[0]} long, {names[1]} string"), "given")
        path = job.new_path("bucketed")
        write_bucketed(job, df, path, Buckets(names[0], count))
        found.append(read_bucketed(job, path, df.schema))
    return job, *found


def expected(how, left=LEFT, right=RIGHT):
    out = []
    for k, a in left:
        met = [(k, a, r, b) for r, b in right if k is not None and r == k]
        if how == "left_semi":
            out += [(k, a)] if met else []
        else:
            out += met or ([(k, a, None, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("way", WAYS)
def test_joins_like_plain_ones(spark, how, way):
    job, left, right = tables(spark, WAYS[way])
    assert rows(left.all_rows()) == sorted(LEFT, key=repr)
    assert rows(bucketed_join(job, left, right, how)) == expected(how)


def test_hot_keys_lie_outside_the_buckets(spark):
    _, left, right = tables(spark, WAYS["hot"])
    assert {k for k, in rows(left.hot_keys)} == {3, None}
    assert {row.k for row in left.hot_rows.collect()} == {3, None}
    assert {k for k, in rows(right.hot_keys)} == {9}
    assert not left.rows.filter("k is null or k = 3").count()


def test_buckets_meet_without_an_exchange(spark):
    job, left, right = tables(spark, WAYS["buckets"])
    found = plan(bucketed_join(job, left, right))
    assert "SortMergeJoin" in found and "Exchange" not in found


def test_cold_keys_meet_without_an_exchange_beside_hot_ones(spark):
    job, left, right = tables(spark, WAYS["hot"])
    cold = plan(bucketed_join(job, left, right)).split("SortMergeJoin")[1]
    assert "LeftAnti" in cold and "hashpartitioning" not in cold


def test_different_numbers_of_buckets(spark):
    job, left, right = tables(spark, WAYS["hot"], counts=(8, 3))
    assert rows(bucketed_join(job, left, right)) == expected("left")


@pytest.mark.parametrize("left, right", [([], RIGHT), (LEFT, []), ([], [])])
@pytest.mark.parametrize("way", WAYS)
def test_empty_sides(spark, way, left, right):
    job, one, other = tables(spark, WAYS[way], left=left, right=right)
    assert rows(bucketed_join(job, one, other)) == expected("left", left, right)


def test_what_it_does_not_do(spark):
    job, left, right = tables(spark, WAYS["buckets"])
    with pytest.raises(ValueError, match="join type"):
        bucketed_join(job, left, right, "full")
    with pytest.raises(ValueError, match="no buckets"):
        read_bucketed(job, job.folder, left.rows.schema)
    with pytest.raises(ValueError, match="same name"):
        bucketed_join(job, left, left)
    with pytest.raises(ValueError, match="taken"):
        write_bucketed(job, spark.range(3).toDF("_key"), job.new_path("x"), Buckets("_key", 2))
    with pytest.raises(ValueError, match="laid out"):
        Warehouse(job, layouts={("bronze", "crm_cust_info"): Buckets("cst_id", 2)})


def test_a_layout_is_published_with_its_version(spark):
    job = Job(spark, AS_OF, Limits(broadcast_rows=0))
    layout = Buckets("cid", 3)
    store = Warehouse(job, layouts={("silver", "erp_cust_az12"): layout})
    plain = spark.createDataFrame([("NASAW01", None, "F"), ("AW02", None, "M")], BRONZE["erp_cust_az12"])
    empty = {name: spark.createDataFrame([], BRONZE[name]) for name in BRONZE}
    store.load_bronze(empty | {"erp_cust_az12": plain})
    store.load_silver()
    other = Warehouse(Job(spark, AS_OF), store.root)
    found = other.bucketed("silver", "erp_cust_az12")
    assert found.layout == layout
    assert rows(found.all_rows().select("cid", "gen")) == [("AW01", "Female"), ("AW02", "Male")]
    assert other.silver("erp_cust_az12").columns == [*BRONZE["erp_cust_az12"].fieldNames(), LOAD_TIME]
    before = store.versions("silver")["erp_cust_az12"]
    store.load_silver()
    assert store.versions("silver")["erp_cust_az12"] != before
    assert other.silver("erp_cust_az12").count() == 2
