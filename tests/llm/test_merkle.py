"""The manifest against a plain tree built in Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from silverlode.llm.merkle import fold, leaf_hash, manifest, proof_hash


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def tree(nodes, arity):
    """The root, and for each node its siblings level by level."""
    place, levels = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[k : k + arity] for k in range(0, len(nodes), arity)]
        for own, at in enumerate(place):
            run, k = runs[at // arity], at % arity
            levels[own].append(("".join(run[:k]), "".join(run[k + 1 :])))
        place = [at // arity for at in place]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], levels


def brute(rows, arity=2):
    """(key, group, leaf, subroot, root, steps) of (key, group, leaf) rows."""
    groups = {}
    for key, group, leaf in rows:
        groups.setdefault(group, []).append((key is not None, key, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    grown = []
    for group in order:
        own = sorted(groups[group], key=lambda r: (r[0], r[1] or 0, r[2]))
        grown.append((own, *tree([leaf for _, _, leaf in own], arity)))
    root, tops = tree([subroot for _, subroot, _ in grown], arity)
    return sorted((
        (key, group, leaf, subroot, root, [*path, *top])
        for group, (own, subroot, paths), top in zip(order, grown, tops)
        for (_, key, leaf), path in zip(own, paths)
    ), key=repr)


def found(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, "doc_id long, lang string, leaf string")
    result = manifest(spark, frame, **sizes).collect()
    return sorted((
        (r.doc_id, r.lang, r.leaf, r.subroot, r.root, [tuple(step) for step in r.path])
        for r in result
    ), key=repr)


@pytest.mark.parametrize("sizes", [
    {}, {"block": 2, "fanout": 2}, {"block": 4, "fanout": 4}, {"arity": 3, "block": 3, "fanout": 3},
])
def test_like_a_plain_tree(spark, sizes):
    # Groups of 1 to 71 leaves: whole and ragged trees, one round to six.
    rows = [
        (k, None if group == 1 else f"g{group}", sha(f"{group} {k}"))
        for group in (1, 2, 3, 5, 16, 17, 71) for k in range(group)
    ]
    assert found(spark, rows, **sizes) == brute(rows, sizes.get("arity", 2))


def test_many_groups(spark):
    rows = [(k, f"g{k:02d}", sha(str(k))) for k in range(37)]
    assert found(spark, rows, block=4, fanout=4) == brute(rows)


def test_null_and_repeated_keys(spark):
    rows = [(None, "a", sha("x")), (None, None, sha("y")), (3, "a", sha("z")), (3, "a", sha("z")),
            (3, "a", sha("w")), (2, "", sha("v")), (9, "é", sha("u")), (9, "z", sha("t"))]
    assert found(spark, rows, block=2, fanout=2) == brute(rows)


def test_no_rows_and_one(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, sha("x"))]) == [(1, None, sha("x"), sha("x"), sha("x"), [])]


def test_leaf_values(spark):
    row = spark.createDataFrame([(7, None, "é\n" * 50_000, "")], "a long, b string, c string, d string")
    text = "é\n" * 50_000
    expected = sha(value(7) + "-" + value(text) + value(""))
    assert row.select(leaf_hash([F.col(name) for name in "abcd"])).first()[0] == expected


def test_a_changed_leaf_shows(spark):
    rows = [(k, "ab"[k % 2], sha(str(k))) for k in range(21)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").withColumn(
        "other", F.when(F.col("doc_id") == 5, F.sha2("leaf", 256)).otherwise(F.col("leaf"))
    )
    proved = manifest(spark, frame, keep=["other"], block=4, fanout=2).withColumns({
        "folded": fold(F.col("other"), F.col("path")), "proof": proof_hash(F.col("path")),
    })
    expected = {key: sha("".join(b + a for b, a in steps)) for key, _, _, _, _, steps in brute(rows)}
    for r in proved.collect():
        assert (r.folded == r.root) == (r.doc_id != 5)
        assert r.proof == expected[r.doc_id]


def test_clashing_names_and_sizes(spark):
    frame = spark.createDataFrame(
        [(1, "a", sha("1"), 5, "x", 7), (2, "a", sha("2"), 6, "y", 8)],
        "doc_id long, lang string, leaf string, tree int, _place string, part int",
    )
    result = manifest(spark, frame, keep=["tree", "_place", "part"])
    assert sorted((r.doc_id, r.tree, r["_place"], r.part) for r in result.collect()) == [
        (1, 5, "x", 7), (2, 6, "y", 8)]
    with pytest.raises(ValueError):
        manifest(spark, frame, block=6)
