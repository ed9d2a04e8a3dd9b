"""Hard-negative mining by Fagin's threshold algorithm.

Vectors become whole numbers (`floor(SCALE * x)`), and a row's score for an anchor is their inner
product. An anchor's positives are its best rows of its own label; each positive opens a window
of scores, `LOW` to `HIGH` percent of its own, and the best rows of other labels inside it are
its hard negatives. Higher scores come first, ties by the smaller id.

Candidates are dealt into tasks by label and id. A task cuts them into lists of one label, at
most `LIST` rows each, and sorts each list once per dimension. For an anchor it reads these
sorted columns from the end that the anchor's sign in that dimension favours, all dimensions to
the same depth; rows met for the first time are looked up and scored whole. The sum of the
anchor's components times the last values read is a threshold that no unread row of the list can
exceed, so the list is left once the threshold is strictly below each window's kth score (or
its lower bound, while it holds fewer rows). The kth scores are carried from list to list of a
task. The bests of all tasks are merged per anchor: at most k rows a task, anchor and window.

Anchors travel to the tasks in blocks of at most `ANCHORS`, one block at a time, so neither the
driver nor a task holds more of them; every block meets every candidate. A hot label or many
copies of one vector change nothing but the labels of lists.

Rows with a null id, label or vector, or a null or non-finite component, take no part. Shorter
vectors count as filled up with zeros. Scaled components beyond 2**27 either way count as that.
Rows that repeat an id are rows of their own, but no positives of an anchor of that id. An anchor
without positives, or a window without rows (as below zero, where its bounds cross), gives no
row. No rows give no rows. Only id, label and vector are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.llm.shipping import in_arrow
from silverlode.operators import add_dense_key

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score

LIST = 16_384
# Rows of a task: every task sends up to k rows per window, so many small ones send more.
TASK_ROWS = 65_536
LEAST_ROWS = 4_096
ANCHORS = 20_000
_FIRST_DEPTH = 32
_MOST = 1 << 27

_FOUND = "anchor long, window int, id long, score long"


def hard_negatives(
    spark: SparkSession, vectors: DataFrame, is_anchor: Column, id: str = "vec_id",
    vector: str = "embedding", label: str = "label", positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    list_rows: int = LIST, block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), rank from 1;
    `is_anchor` tells which rows of `vectors` are anchors."""
    job = Job(spark).part("negatives")
    x, size = F.col(f"`{vector}`"), F.lit(float(_MOST))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.greatest(F.least(
        F.floor(c.cast("double") * scale).cast("double"), size), -size).cast("int"))
    rows = job.stage(
        vectors.filter(
            F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & x.isNotNull() & usable
        ).select(
            F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"),
            scaled.alias("x"), is_anchor.alias("anchor"),
        ), "vectors",
    )
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims")).first()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-facts.n // TASK_ROWS), min(parallel, -(-facts.n // LEAST_ROWS)), 1)
    candidates = rows.select("id", "label", "x").repartitionByRange(tasks, "label", "id")
    candidates = candidates.sortWithinPartitions("label", "id")
    anchors = job.stage(add_dense_key(
        job, rows.filter("anchor").select("id", "label", "x"), ["id", "label", "x"], "anchor"
    ), "anchors")
    numbers = anchors.agg(F.max("anchor")).first()[0] or 0

    blocks = []
    for first in range(0, numbers, block):
        own = anchors.filter(f"anchor > {first} and anchor <= {first + block}")
        asked = _read(own, facts.dims)
        best = _search(candidates, _Positives(asked, positives, list_rows))
        met = job.stage(_merged(best, positives), "positives")
        # At most `positives` rows for each anchor of the block.
        windows = _windows(met, asked, low, high)
        found = _search(candidates, _Negatives(asked, windows, negatives, list_rows))
        met = met.withColumnsRenamed({"id": "positive_id", "score": "positive_score", "rank": "w"})
        blocks.append(job.stage(
            _merged(found, negatives).join(met.drop("window"), "anchor")
            .filter(F.col("w") == F.col("window"))
            .join(own.select("anchor", F.col("id").alias("anchor_id")), "anchor"), "negatives",
        ))
    if not blocks:
        none = spark.createDataFrame([], _FOUND + ", rank int, positive_id long, "
                                     "positive_score long, anchor_id long")
        blocks.append(none)
    result = blocks[0]
    for more in blocks[1:]:
        result = result.unionByName(more)
    return result.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first k of what all tasks found for each anchor and window, with their rank."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class _Asked(NamedTuple):
    """A block of anchors: numbers, ids, labels and vectors, ascending by number."""

    number: np.ndarray
    id: np.ndarray
    label: list
    x: np.ndarray


def _read(anchors: DataFrame, dims: int) -> _Asked:
    table = anchors.orderBy("anchor").toArrow()
    return _Asked(
        table["anchor"].to_numpy(), table["id"].to_numpy(), table["label"].to_pylist(),
        _matrix(table["x"].combine_chunks(), dims),
    )


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """The vectors as rows of doubles, in which whole numbers this small are exact."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims).astype(np.float64)
    matrix = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return matrix


def _windows(met: DataFrame, asked: _Asked, low: int, high: int) -> list[list[tuple]]:
    """Per anchor of the block its windows (rank of the positive, least and greatest score)."""
    windows = [[] for _ in asked.number]
    first = int(asked.number[0])
    table = met.select("anchor", "rank", "score").toArrow()
    for number, rank, score in zip(*(column.to_pylist() for column in table.columns)):
        # The least and greatest whole scores within the percentages.
        least, greatest = -(-low * score // 100), high * score // 100
        if least <= greatest:
            windows[number - first].append((rank, least, greatest))
    return windows


class _Columns(NamedTuple):
    """A list of rows of one label: ids, vectors, each dimension's row numbers in ascending order
    of its values, and those values."""

    id: np.ndarray
    x: np.ndarray
    order: np.ndarray
    sorted: np.ndarray

    def thresholds(self, anchors: np.ndarray, depths: list[int]) -> np.ndarray:
        """For each anchor and depth, what no row can exceed that is not read by then."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return np.stack([
            _exact(up, self.sorted[len(self.id) - depth]) + _exact(down, self.sorted[depth - 1])
            for depth in depths
        ], axis=1)

    def unread(self, anchor: np.ndarray, first: int, depth: int, read: np.ndarray) -> np.ndarray:
        """Rows that are met between two depths for the first time; they count as read."""
        up, down = anchor > 0, anchor < 0
        if not (up.any() or down.any()):
            up = ~up
        size = len(self.id)
        met = np.zeros(size, bool)
        met[self.order[size - depth : size - first, up].ravel()] = True
        met[self.order[first:depth, down].ravel()] = True
        met &= ~read
        read |= met
        return np.flatnonzero(met)


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y in whole numbers: by floating point where that is exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(x.shape[-1], 1)
    if most < 2.0**53:
        return (x @ y).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64)


class _Search:
    """What a task looks for: the k best rows of each window of each anchor of a block."""

    def __init__(self, asked: _Asked, k: int, list_rows: int) -> None:
        self.asked, self.k, self.list_rows = asked, k, list_rows

    def windows(self, anchor: int) -> list[tuple]:
        """(name, least, greatest score) of each window of an anchor."""
        raise NotImplementedError

    def wants(self, anchor: int, label: object) -> bool:
        raise NotImplementedError

    def allowed(self, anchor: int, ids: np.ndarray) -> np.ndarray | None:
        """Which of the rows may be found (None: all)."""
        return None

    def over(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for label, ids, x in _lists(batches, self.asked.x.shape[1], self.list_rows):
            order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
            self._scan(label, _Columns(ids, x, order, np.take_along_axis(x, order, 0)), best)
        rows = [
            (int(self.asked.number[anchor]), window, ids, scores)
            for (anchor, window), (ids, scores) in best.items()
        ]
        for first in range(0, len(rows), 10_000):
            part = rows[first : first + 10_000]
            sizes = [len(ids) for _, _, ids, _ in part]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([r[0] for r in part], sizes), pa.int64()),
                pa.array(np.repeat([r[1] for r in part], sizes), pa.int32()),
                pa.array(np.concatenate([r[2] for r in part]), pa.int64()),
                pa.array(np.concatenate([r[3] for r in part]), pa.int64()),
            ], names=["anchor", "window", "id", "score"])

    def _scan(self, label: object, columns: _Columns, best: dict) -> None:
        """Find the rows of one list for all anchors that want its label."""
        size = len(columns.id)
        depths = [min(_FIRST_DEPTH << k, size) for k in range(size.bit_length())]
        depths = sorted({1, *depths, size})
        wanted = [a for a in range(len(self.asked.number)) if self.wants(a, label)]
        if not wanted:
            return
        limits = columns.thresholds(self.asked.x[wanted], depths)
        for anchor, limit in zip(wanted, limits):
            windows, vector = self.windows(anchor), self.asked.x[anchor]
            bounds = {name: self._bound(best, anchor, name, least) for name, least, _ in windows}
            read, first, threshold = np.zeros(size, bool), 0, None
            for depth, next_threshold in zip(depths, limit):
                if threshold is not None and threshold < min(bounds.values()):
                    break
                new = columns.unread(vector, first, depth, read)
                first, threshold = depth, next_threshold
                scores = _exact(columns.x[new], vector)
                ids = columns.id[new]
                own = self.allowed(anchor, ids)
                for name, least, greatest in windows:
                    inside = (scores >= bounds[name]) & (scores <= greatest)
                    if own is not None:
                        inside &= own
                    if inside.any():
                        self._keep(best, anchor, name, ids[inside], scores[inside])
                        bounds[name] = self._bound(best, anchor, name, least)

    def _bound(self, best: dict, anchor: int, name: int, least: int) -> int:
        """The kth score of a window, or its least score while it holds fewer rows."""
        held = best.get((anchor, name))
        return int(held[1][-1]) if held is not None and len(held[1]) == self.k else least

    def _keep(self, best: dict, anchor: int, name: int, ids, scores) -> None:
        if (anchor, name) in best:
            ids = np.concatenate((best[anchor, name][0], ids))
            scores = np.concatenate((best[anchor, name][1], scores))
        first = np.lexsort((ids, -scores))[: self.k]
        best[anchor, name] = ids[first], scores[first]


class _Positives(_Search):
    """One window without bounds, over the rows of the anchor's own label."""

    def windows(self, anchor: int) -> list[tuple]:
        return [(0, -(1 << 62), 1 << 62)]

    def wants(self, anchor: int, label: object) -> bool:
        return self.asked.label[anchor] == label

    def allowed(self, anchor: int, ids: np.ndarray) -> np.ndarray | None:
        return ids != self.asked.id[anchor]


class _Negatives(_Search):
    """The windows of the anchor's positives, over the rows of other labels."""

    def __init__(self, asked: _Asked, windows: list[list[tuple]], k: int, list_rows: int) -> None:
        super().__init__(asked, k, list_rows)
        self.opened = windows

    def windows(self, anchor: int) -> list[tuple]:
        return self.opened[anchor]

    def wants(self, anchor: int, label: object) -> bool:
        return bool(self.opened[anchor]) and self.asked.label[anchor] != label


def _search(candidates: DataFrame, search: _Search) -> DataFrame:
    """What each task finds among its candidates."""
    sent = candidates.sparkSession.sparkContext.broadcast(search)
    return in_arrow(candidates, _work(sent), _FOUND)


def _work(sent) -> Callable:
    return lambda batches: sent.value.over(batches)


def _lists(
    batches: Iterator[pa.RecordBatch], dims: int, most: int
) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
    """(label, ids, vectors) of runs of rows with one label, at most `most` rows each."""
    label, held, size = None, [], 0

    def done():
        return label, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        x = _matrix(batch.column("x"), dims)
        labels = batch.column("label").to_pylist()
        first = 0
        while first < len(ids):
            if size and (labels[first] != label or size >= most):
                yield done()
                held, size = [], 0
            label, end = labels[first], first + 1
            while end < len(ids) and labels[end] == label and size + end - first < most:
                end += 1
            held.append((ids[first:end], x[first:end]))
            size += end - first
            first = end
    if size:
        yield done()
