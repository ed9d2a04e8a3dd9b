import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import near_dedup as nd
from silverlode.llm.graph import components
from silverlode.job import Job, Limits

# Nothing is broadcast, and buckets, pivots and nodes of more than three rows are spread.
SPREAD = Limits(broadcast_rows=0, hot_rows=3)
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bag(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    runs = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    return runs


def similar(a, b):
    x, y = bag(a), bag(b)
    if a == b:
        return True
    return bool(x and y) and 5 * sum((x & y).values()) >= 4 * sum((x | y).values())


def brute(docs):
    """Class (least place) of each row by comparing all pairs."""
    parent = list(range(len(docs)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            a, b = docs[i][1], docs[j][1]
            if a is not None and b is not None and similar(a, b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(k) for k in range(len(docs))]


def sample():
    draw = random.Random(3)

    def text(n):
        return [f"w{draw.randrange(5000)}" for _ in range(n)]

    docs = []
    for size in (40, 150, 400):
        base = text(size)
        docs += [" ".join(base)] * 3
        for edits in (1, 1, 2, 3, 5, 8, 12):
            copy = list(base)
            for place in draw.sample(range(size), edits):
                copy[place] = f"x{draw.randrange(10**6)}"
            docs.append(" ".join(copy))
    common = text(30)
    docs += [" ".join(common + text(20)) for _ in range(12)]
    docs += ["a b c a b c " * n for n in (5, 6, 30, 31, 32)]
    docs += ["one two", "One, two!", "one", "", "", "!!!", "???", None, None, "spam " * 300]
    draw.shuffle(docs)
    return [(1000 - k, text) for k, text in enumerate(docs)]


@pytest.mark.parametrize("limits", [None, SPREAD])
def test_like_brute_force(spark, limits):
    docs = sample()
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    result = nd.near_duplicates(spark, frame, limits=limits).collect()
    of = brute(docs)
    named, rows = {}, Counter(of)
    for (name, _), place in zip(docs, of):
        named[place] = min(named.get(place, name), name)
    expected = sorted(
        (name, named[place], rows[place], place == k)
        for k, ((name, _), place) in enumerate(zip(docs, of))
    )
    assert sorted((r.doc_id, r.class_id, r.class_rows, r.class_first) for r in result) == expected


@pytest.mark.parametrize("limits", [None, SPREAD])
def test_large_group_of_near_copies_is_one_class_without_all_pairs(spark, limits):
    draw = random.Random(5)
    base = [f"w{draw.randrange(5000)}" for _ in range(200)]
    docs = []
    for k in range(300):
        copy = list(base)
        for place in draw.sample(range(200), draw.randrange(1, 9)):
            copy[place] = f"x{draw.randrange(10**6)}"
        docs.append((k, " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    result = nd.near_duplicates(spark, frame, limits=limits)
    of = {r.doc_id: r.class_id for r in result.collect()}
    assert [of[k] for k in range(300)] == brute(docs)


def test_signatures_estimate_weighted_similarity():
    row = np.repeat([0, 1], [60, 70])
    shingle = nd.tx.mix(np.concatenate([np.arange(60), np.arange(30, 100)]).astype(np.uint64))
    draw = np.random.default_rng(1)
    weight = draw.integers(1, 40, 130)
    a = dict(zip(shingle[:60].tolist(), weight[:60]))
    b = dict(zip(shingle[60:].tolist(), weight[60:]))
    keys = set(a) | set(b)
    truth = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(
        max(a.get(k, 0), b.get(k, 0)) for k in keys
    )
    found = nd.signatures(row, shingle, weight, 2, 20_000)
    assert abs((found[0] == found[1]).mean() - truth) < 0.015


def test_signatures_do_not_depend_on_the_bound_or_neighbours():
    shingle = nd.tx.mix(np.arange(25).astype(np.uint64))
    weight = np.arange(1, 26)
    alone = nd.signatures(np.zeros(25, int), shingle, weight, 1)
    row = np.repeat([0, 1], 25)
    both = nd.signatures(row, np.tile(shingle, 2), np.tile(weight, 2), 2)
    assert (both[0] == alone[0]).all() and (both[1] == alone[0]).all()


@pytest.mark.parametrize("limits", [Limits(), SPREAD])
def test_components(spark, limits):
    draw = random.Random(2)
    links = [(draw.randrange(120), draw.randrange(120)) for _ in range(80)]
    links += [(k, k + 1) for k in range(200, 240)] + [(500, k) for k in range(300, 340)]
    found = components(Job(spark, limits=limits), spark.createDataFrame(links, "a long, b long"))
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert {r.node: r.label for r in found.collect()} == {k: root(k) for k in list(parent)}
    assert found.groupBy("node").count().filter(F.col("count") > 1).isEmpty()
