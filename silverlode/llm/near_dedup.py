"""Near-duplicate classes by BagMinHash, banding and exact multiset overlap.

A text is the multiset of its runs of five words (digits, ASCII letters lower-cased, code points
beyond ASCII); one of fewer words is a single run. Two texts are linked when the weighted Jaccard
similarity of their multisets is at least 0.8, and a class is everything links connect.

- Signature: each shingle owns Poisson processes over time, one for each dyadic range of weights
  (0-1, 1-2, 2-4, ...); a point lies at a time, at a weight inside the range and in one of the
  components, and belongs to a text if its weight is below the shingle's count there. The first
  point of each component over all shingles is the signature, whose components agree with a
  probability of exactly the weighted similarity. Points are made in order of time and only up to
  a bound that the text's total weight gives, so the cost follows the words plus the components.
- Bands: 24 of 5 components. A pair at 0.8 shares a band with a probability above 0.9999.
- Equal texts are one node from the start. In each bucket every node is compared with one pivot,
  the node that has most company over all its buckets (near-copies resemble their source more
  than each other), so a bucket costs its size. What that leaves open, buckets with nodes that
  are not connected yet, is compared with a second pivot, the node with the least share of
  shingles that no other open node has. Pairs open even then are compared as well, except those
  that these counts prove to be below 0.8.
- Links and components stay distributed tables.

Null texts are never copies of anything. Texts without words are copies only of the same text.
Repeated rows are copies; a class is named by its least doc_id (null ids last), and the row that
the input has first is marked to be kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job, Limits
from silverlode.llm import text as tx
from silverlode.llm.filters import bitmap, probe
from silverlode.llm.graph import components
from silverlode.llm.shipping import in_arrow
from silverlode.operators.joins import ROW_ID, balanced_join, number_rows

SHINGLE = 5
BANDS = 24
ROWS = 5
SIZE = BANDS * ROWS
# Texts of classes of several rows (about 50 bytes each) that may travel to every task.
BROADCAST_TEXTS = 500_000
# Keys of texts that a task remembers having sent, so copies in it are sent once.
REMEMBERED = 200_000
# Points of one shingle made at once.
MOST_POINTS = 1024
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64((1 << 20) - 1)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    keep_text: bool = True, limits: Limits | None = None,
) -> DataFrame:
    """Every row with class_id, class_rows (rows of its class) and class_first (whether it is
    the one row of its class to keep). `limits` says from which size on buckets, and the pairs of
    one pivot, are spread over several tasks."""
    job = Job(spark, limits=limits or Limits())
    row = docs if keep_text else docs.drop(text)
    signed = job.stage(
        tx.map_texts(
            docs.select(
                tx.whole_row(row), F.monotonically_increasing_id().alias("_id"),
                F.col(f"`{doc_id}`").alias("_doc"), *_keys(text), *tx.beside(text, keep_text),
            ),
            [T.StructField("bands", T.ArrayType(T.LongType()))], _bands, limit=400_000,
            inside=text if keep_text else None,
        ),
        "signed",
    )
    nodes = job.stage(
        signed.filter("k1 is not null").groupBy("k1", "k2")
        .agg(F.min("_id").alias("node"), F.min("_doc").alias("first_doc"),
             F.count("*").alias("copies")),
        "nodes",
    )
    work = job.part("near_dedup")
    labels = _labels(work, docs, text, signed, nodes)
    classes = nodes.withColumn("label", F.col("node"))
    if labels is not None:
        named = labels.join(nodes, "node").groupBy("label").agg(
            F.min("first_doc").alias("label_doc"), F.sum("copies").alias("label_rows")
        )
        classes = (
            nodes.join(labels.join(named, "label"), "node", "left")
            .select(
                "k1", "k2", "node", F.coalesce("label", "node").alias("label"),
                F.when(F.col("label").isNull(), F.col("first_doc"))
                .otherwise(F.col("label_doc")).alias("first_doc"),
                F.coalesce("label_rows", "copies").alias("copies"),
            )
        )
    # Rows of classes of one need no join.
    shared = job.stage(classes.filter("copies > 1").drop("node"), "classes")
    work.remove()
    if shared.count() <= BROADCAST_TEXTS:
        shared = F.broadcast(shared)
    placed = signed.join(shared, ["k1", "k2"], "left")
    return tx.unfold(placed, row, {
        "class_id": F.when(F.col("label").isNull(), F.col("_doc")).otherwise(F.col("first_doc")),
        "class_rows": F.coalesce("copies", F.lit(1).cast("long")),
        "class_first": F.coalesce(F.col("label") == F.col("_id"), F.lit(True)),
    })


def _keys(text: str) -> list[Column]:
    """128 bits that stand for a text; null for null."""
    column = F.col(f"`{text}`")
    return [
        F.when(column.isNotNull(), F.xxhash64(F.lit(seed), column)).alias(f"k{seed}")
        for seed in (1, 2)
    ]


def _labels(
    job: Job, docs: DataFrame, text: str, signed: DataFrame, nodes: DataFrame
) -> DataFrame | None:
    """(node, label) of the nodes that are linked to others; None without any link."""
    first_rows = signed.join(nodes.select(F.col("node").alias("_id")), "_id", "left_semi")
    banded = first_rows.select(F.col("_id").alias("node"), F.explode("bands").alias("band"))
    crowded = banded.groupBy("band").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    members = job.stage(banded.join(crowded, "band"), "members")
    if members.isEmpty():
        return None
    bags = job.stage(_bags(docs, text, members, nodes), "bags")

    # First round: the pivot is the node with most company over all its buckets.
    company = members.groupBy("node").agg(F.sum("crowd").alias("rank"))
    ranked = number_rows(members).join(company, "node").select("band", "node", "rank", ROW_ID)
    compared, rest = _round(job, ranked, members)
    labels = _merged(job, None, job.stage(_similar(job, compared, bags), "links"))
    open_members = job.stage(_open(rest, labels), "open")
    if open_members.isEmpty():
        return labels

    # Second round, on what is open: the node with the least share of shingles of its own.
    left, few = _possible(job, open_members, bags)
    ranked = left.select("band", "node", (F.col("shared") / F.col("n")).alias("rank"))
    again, rest = _round(job, ranked, None)
    again = job.stage(again.join(compared, ["a", "b"], "left_anti"), "pairs")
    labels = _merged(job, labels, job.stage(_similar(job, again, bags), "links"))
    left = job.stage(_open(left.drop("label").join(rest, ["band", "node"]), labels), "open")
    if left.isEmpty():
        return labels

    # All pairs still open.
    pairs = _pairs(left, few).join(compared.union(again), ["a", "b"], "left_anti")
    links = job.stage(_similar(job, job.stage(pairs, "pairs"), bags), "links")
    return _merged(job, labels, links)


def _round(
    job: Job, ranked: DataFrame, source: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) of each bucket's node of greatest rank with every other one, and
    the members (band, node) other than those. `source` is the stored table that `ranked` joined,
    if it did. A bucket sends one candidate a task, and its members are spread to meet its pivot."""
    pivots = job.stage(
        ranked.groupBy("band").agg(F.max(F.struct("rank", -F.col("node"))).alias("best"))
        .select(F.col("band").alias("of_band"), (-F.col("best.col2")).alias("pivot")),
        "pivots",
    )
    others = balanced_join(
        job, ranked.drop("rank"), pivots, "band", "of_band", "inner", left_source=source
    ).filter("node <> pivot")
    pairs = others.select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
    ).distinct()
    return job.stage(pairs, "pairs"), others.select("band", "node")


def _merged(job: Job, labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The labels after more links."""
    if links.isEmpty():
        return labels
    if labels is None:
        return job.stage(components(job, links), "labels")
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    lifted = (
        links.join(known, "a", "left")
        .join(known.select(F.col("a").alias("b"), F.col("x").alias("y")), "b", "left")
        .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    )
    fresh = (
        links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
        .join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    )
    step = components(job, job.stage(lifted, "links")).select(
        F.col("node").alias("label"), F.col("label").alias("parent")
    )
    return job.stage(
        labels.union(fresh).join(step, "label", "left")
        .select("node", F.coalesce("parent", "label").alias("label")), "labels",
    )


def _open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members of buckets that hold more than one label, with their labels."""
    if labels is None:
        return _of_several(members.withColumn("label", F.col("node")))
    return _of_several(
        members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    )


def _of_several(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one label."""
    several = members.groupBy("band").agg(
        F.min("label").alias("least"), F.max("label").alias("most")
    ).filter("least < most")
    return members.join(several.select("band"), "band", "left_semi")


def _possible(
    job: Job, open_members: DataFrame, bags: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The open members whose buckets may still hold a link, and (n, nodes) for each item that
    only one to three open nodes hold.

    Of a node's n items, `shared` are held by another open node as well and `common` by three
    others or more. A node overlaps with another one in its shared items at most, so with fewer
    than 0.8 of n it has no link. One sum per item finds its holders: least, greatest and, by
    exclusive or, the one between.
    """
    held = bags.join(open_members.select("node").distinct(), "node", "left_semi")
    between = F.col("all").bitwiseXOR(F.col("least")).bitwiseXOR(F.col("most"))
    few = job.stage(
        held.select("node", F.explode("items").alias("item")).groupBy("item")
        .agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"),
             F.bit_xor("node").alias("all"))
        .filter("n <= 3")
        .select("n", F.when(F.col("n") == 1, F.array("least"))
                .when(F.col("n") == 2, F.array("least", "most"))
                .otherwise(F.array("least", between, "most")).alias("nodes")),
        "few_holders",
    )
    counts = few.select("n", F.explode("nodes").alias("node")).groupBy("node").agg(
        F.count_if(F.col("n") == 1).alias("alone"), F.count_if(F.col("n") > 1).alias("few")
    )
    size, none = F.size("items"), F.lit(0)
    sizes = held.join(counts, "node", "left").select(
        "node", size.alias("n"), (size - F.coalesce("alone", none)).alias("shared"),
        (size - F.coalesce("alone", none) - F.coalesce("few", none)).alias("common"),
    )
    left = job.stage(
        _of_several(open_members.join(sizes.filter("5 * shared >= 4 * n"), "node")), "open_left"
    )
    return left, few.filter("n > 1")


def _pairs(left: DataFrame, few: DataFrame) -> DataFrame:
    """Pairs (a, b) in one bucket, not connected yet, whose similarity can reach 0.8, that is
    whose overlap can be 4/9 of the sum of both sizes.

    Two nodes that no item of few holders joins overlap in common items only, at most in the
    lesser count of both; such pairs are listed once, in their first bucket. For two nodes that
    such items join, these are counted and add to that.
    """
    nodes = left.groupBy("node", "label", "n", "common").agg(F.collect_set("band").alias("bands"))
    columns = ("node", "label", "n", "common", "bands")
    a = nodes.select(*(F.col(name).alias(f"{name}_a") for name in columns))
    b = nodes.select(*(F.col(name).alias(f"{name}_b") for name in columns))
    by_band = (
        a.withColumn("band", F.explode("bands_a")).join(b.withColumn("band", F.explode("bands_b")),
                                                        "band")
        .filter("node_a < node_b and label_a <> label_b "
                "and 9 * least(common_a, common_b) >= 4 * (n_a + n_b) "
                "and band = array_min(array_intersect(bands_a, bands_b))")
        .select("node_a", "node_b")
    )
    ends = F.array(*(
        F.struct(F.get("nodes", F.lit(i)).alias("node_a"), F.get("nodes", F.lit(j)).alias("node_b"))
        for i, j in ((0, 1), (0, 2), (1, 2))
    ))
    joined = (
        few.select(F.explode(ends).alias("pair")).select("pair.*").filter("node_b is not null")
        .groupBy("node_a", "node_b").agg(F.count("*").alias("between"))
    )
    by_item = (
        joined.join(a.drop("bands_a"), "node_a").join(b.drop("bands_b"), "node_b")
        .filter("label_a <> label_b "
                "and 9 * (least(common_a, common_b) + between) >= 4 * (n_a + n_b)")
        .select("node_a", "node_b")
    )
    return by_band.union(by_item).distinct().toDF("a", "b")


def _bags(docs: DataFrame, text: str, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, items) for the members: shingles as 64-bit hashes, each further copy of a shingle
    as an item of its own, so that overlaps of multisets are overlaps of sets.

    The texts are read again instead of being stored with the signatures; a bitmap of the wanted
    keys lets nearly all other rows end in their task.
    """
    wanted = members.select("node").distinct().join(nodes.select("node", "k1", "k2"), "node")
    known = bitmap(wanted, F.col("k1"))
    result = T.StructType([
        T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
        T.StructField("items", T.ArrayType(T.LongType())),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sent = np.frombuffer(known, np.uint8), set()
        for batch in batches:
            batch = batch.filter(pa.array(probe(table, batch["k1"].to_numpy().view(np.uint64))))
            keys = list(zip(batch["k1"].to_pylist(), batch["k2"].to_pylist()))
            fresh = []
            for place, key in enumerate(keys):
                if key not in sent:
                    fresh.append(place)
                    if len(sent) < REMEMBERED:
                        sent.add(key)
            batch = batch.take(pa.array(fresh, pa.int64()))
            texts = batch["_text"].to_pylist()
            for first, end in tx.slices(texts):
                rows, shingles, _, copy = _shingles(texts[first:end])
                items = tx.mix(shingles + copy.astype(np.uint64) * tx._BASE)
                ends = tx.segments(rows, end - first)
                yield pa.RecordBatch.from_arrays(
                    [batch["k1"].slice(first, end - first), batch["k2"].slice(first, end - first),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.array(items.view(np.int64)))],
                    names=["k1", "k2", "items"],
                )

    column = F.col(f"`{text}`")
    rows = docs.filter(column.isNotNull()).select(*_keys(text), column.alias("_text"))
    # A copy sent by several tasks meets its equals here.
    return in_arrow(rows, work, result).join(wanted, ["k1", "k2"]).groupBy("node").agg(
        F.first("items").alias("items")
    )


def _similar(job: Job, pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs whose multisets overlap in at least 0.8 of their union, in whole numbers. Bags
    are never broadcast; the pairs of one node in very many of them are spread over tasks."""
    moving = replace(job, limits=replace(job.limits, broadcast_rows=0))
    met = number_rows(pairs)
    for end in ("a", "b"):
        side = bags.select(F.col("node").alias(f"of_{end}"), F.col("items").alias(f"items_{end}"))
        met = balanced_join(moving, met, side, end, f"of_{end}", "inner", left_source=pairs)
    overlap = F.size(F.array_intersect("items_a", "items_b"))
    return (
        met.filter(9 * overlap >= 4 * (F.size("items_a") + F.size("items_b")))
        .select("a", "b")
    )


def _shingles(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of each shingle, sorted within rows, whether it differs from the one before,
    and how many equal ones precede it."""
    points, offsets = tx.code_points(texts)
    points = tx.ascii_lower(points)
    words = tx.runs(tx.word_mask(points), offsets)
    hashes = tx.run_hashes(points, words.starts, words.ends)
    first_word = tx.segments(words.row, len(texts))
    counts = np.diff(first_word)
    grams = tx.gram_hashes(hashes, SHINGLE)
    whole = words.row[: len(grams)] == words.row[len(words.row) - len(grams) :]
    rows, shingles = [words.row[: len(grams)][whole]], [grams[whole]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        if len(short):
            rows.append(short)
            shingles.append(tx.gram_hashes(hashes, size)[first_word[short]])
    row, shingle = np.concatenate(rows), np.concatenate(shingles)
    if len(rows) > 1:
        order = np.argsort(row, kind="stable")
        row, shingle = row[order], shingle[order]
    ends = tx.segments(row, len(texts))
    for first, end in zip(ends[:-1], ends[1:]):
        shingle[first:end].sort()
    fresh = np.ones(len(row), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    place = np.arange(len(row))
    copy = place - np.maximum.accumulate(np.where(fresh, place, 0)) if len(row) else place
    return row, shingle, fresh, copy


def _bands(texts) -> list[pa.Array]:
    """The band keys of each text; none for a text without words."""
    row, shingle, fresh, _ = _shingles(texts)
    first = np.flatnonzero(fresh)
    count = np.diff(np.concatenate((first, [len(row)])))
    signature = signatures(row[first], shingle[first], count, len(texts))
    keys = np.zeros((len(texts), BANDS), np.uint64)
    for place in range(ROWS):
        keys = keys * tx._BASE + signature[:, place::ROWS]
    keys = tx.mix(keys + np.arange(BANDS, dtype=np.uint64))
    has = np.bincount(row, minlength=len(texts)) > 0
    ends = np.concatenate(([0], np.cumsum(has * BANDS)))
    return [pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(keys[has].ravel().view(np.int64))
    )]


def signatures(
    row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, size: int = SIZE
) -> np.ndarray:
    """A row of `size` components for each text from its distinct shingles and their counts."""
    result = np.full(rows * size, _EMPTY)
    total = np.bincount(row, weights=weight, minlength=rows)
    bound = (np.log(size) + 3) / np.maximum(total, 1)
    open_rows = total > 0
    while open_rows.any():
        taken = open_rows[row]
        _points(result, row[taken], shingle[taken], weight[taken], bound, size)
        open_rows &= (result.reshape(rows, size) == _EMPTY).any(axis=1)
        bound *= 2  # points up to the old bound come again and change nothing
    return result.reshape(rows, size)


def _points(result, row, shingle, weight, bound, size) -> None:
    """Put each shingle's points up to the bound into the signature, least time first.

    Points come in blocks of about as many as the time left to the bound needs; times are added
    up one by one, so they do not depend on the blocks.
    """
    level, low, width = 0, 0, 1
    while len(row):
        seed = tx.mix(shingle ^ tx.mix(np.full(1, level + 1, np.uint64) * tx._BASE))
        place, time, step = np.arange(len(row)), np.zeros(len(row)), np.zeros(len(row), np.int64)
        while len(place):
            needed = np.minimum(size * width * (bound[row[place]] - time), MOST_POINTS)
            block = np.ceil(np.log2(np.maximum(needed, 1))).astype(np.int64)
            later = []
            for power in np.unique(block):
                own = block == power
                for some in _parts(np.flatnonzero(own), 1 << power):
                    later.append(_block(
                        result, row, weight, bound, size, seed, low, width,
                        place[some], time[some], step[some], 1 << power,
                    ))
            place, time, step = (np.concatenate(part) for part in zip(*later))
        level, low = level + 1, low + width
        width = low
        more = weight > low
        row, shingle, weight = row[more], shingle[more], weight[more]


def _parts(places: np.ndarray, points: int) -> list[np.ndarray]:
    """Parts that make about 16,000 points each, small enough for a processor's cache."""
    return np.array_split(places, max(1, len(places) * points >> 14))


def _block(result, row, weight, bound, size, seed, low, width, place, time, step, points):
    """The next `points` points of some shingles; returns those whose bound is not reached."""
    number = step[:, None] + np.arange(1, points + 1)
    draw = tx.mix(seed[place][:, None] + number.astype(np.uint64) * tx._BASE)
    times = -np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / (size * width)
    times[:, 0] += time
    np.cumsum(times, axis=1, out=times)
    early = times <= bound[row[place]][:, None]
    owner = np.broadcast_to(place[:, None], early.shape)[early]
    draw = tx.mix(draw[early])
    below = low + width * ((draw >> np.uint64(11)) * 2.0**-53) < weight[owner]
    # Time to 32 bits of fraction, then bits of the point: equal only for one point.
    key = (times[early].view(np.uint64) & ~_LOW) | (draw >> np.uint64(44))
    cell = row[owner] * size + (draw % np.uint64(size)).astype(np.int64)
    np.minimum.at(result, cell[below], key[below])
    on = early[:, -1]
    return place[on], times[on, -1], number[on, -1]
