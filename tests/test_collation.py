import pytest
from pyspark.sql import functions as F

from helpers import rows
from silverlode import Job, Limits
from silverlode.functions import strip_prefix, text_equals, text_like
from silverlode.operators import balanced_join

SERVER = "UTF8_LCASE_RTRIM"
LEFT = [("Ab ", 1), ("AB", 2), ("cd", 3), (None, 4), (" ab", 5), ("é", 6)] + [("hot", k) for k in range(10, 20)]
RIGHT = [("aB", 10), ("CD  ", 20), (None, 30), ("É ", 40), ("HOT ", 50), ("Hot", 60)]


def sides(spark):
    return (spark.createDataFrame(LEFT, "k string, v int"),
            spark.createDataFrame(RIGHT, "k2 string, w int"))


def brute(how):
    def key(text):
        return None if text is None else text.rstrip(" ").lower()

    found = []
    for k, v in LEFT:
        met = [(k2, w) for k2, w in RIGHT if k is not None and key(k) == key(k2)]
        if how == "left_semi":
            found += [(k, v)] * bool(met)
        else:
            found += [(k, v, *m) for m in met or ([(None, None)] if how == "left" else [])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, hot_rows=2)])
def test_joins_follow_the_collation(spark, how, limits):
    job = Job(spark, limits=limits, collation=SERVER)
    left, right = (job.stage(df, "side") for df in sides(spark))
    joined = balanced_join(job, left, right, "k", "k2", how)
    assert rows(joined) == brute(how)
    assert joined.schema["k"].dataType == left.schema["k"].dataType


def test_joins_are_exact_without_one(spark, job):
    left, right = sides(spark)
    assert rows(balanced_join(job, left, right, "k", "k2", "inner")) == []


def test_numbers_meet_as_they_are(spark):
    job = Job(spark, collation=SERVER)
    left, right = sides(spark)
    assert rows(balanced_join(job, left, right, "v", "w", "left_semi").select("v")) == [(10,)]


def test_patterns(spark):
    texts = spark.createDataFrame([("NASx ",), ("nasX",), (" nas",), (None,), ("na",)], "t string")
    t = F.col("t")
    found = texts.select(
        text_like(t, "NAS%", SERVER), text_like(t, "%X", SERVER), text_like(t, "%x"),
        text_equals(t, "NASX", SERVER), text_equals(t, "nasX"), strip_prefix(t, "NAS", SERVER),
        strip_prefix(t, "NAS"),
    )
    assert [tuple(r) for r in found.collect()] == [
        (True, True, False, True, False, "x ", "x "), (True, True, False, True, True, "X", "nasX"),
        (False, False, False, False, False, " nas", " nas"), (None,) * 7,
        (False, False, False, False, False, "na", "na"),
    ]
