"""Quality scores by a factorisation machine.

A text is a sparse vector: its words hashed to 4,096 buckets (log counts, scaled to length 1),
structure statistics (shares between 0 and 1) and metadata columns of its row (logs, and a flag
for a missing value). The machine weighs single features and, through vectors of rank `RANK`,
all pairs of them; with the sum-of-squares identity

    sum over pairs <v_i, v_j> x_i x_j = half the sum over f of (sum v_if x_i)^2 - sum (v_if x_i)^2

a score costs the number of features times the rank.

Training takes about `SAMPLE` labelled texts outside the held-out fold, those with the least
hash of the id (all of them if there are fewer); that bound keeps training on the driver small
and whole texts are used. Label, language, source and id are no features.

Null and empty texts are scored by their statistics, which are 0. Without labels, or with one
kind only, every score is 0.5 and as that kind is predicted by the threshold. Equal rows score
alike; a result replaces an input column of its name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm import text as tx
from silverlode.llm.folds import hash_of, held_out, labelled
from silverlode.llm.quality_rules import CLOSING, SEPARATORS, SYMBOLS, repeated_words

BUCKETS = 1 << 12
RANK = 6
SAMPLE = 8000
EPOCHS = 10
BATCH = 128
RATE = 0.1
DECAY = 1e-4
STATISTICS = (
    "some_words", "log_words", "log_lines", "symbols", "digits", "capitals", "other_signs",
    "loud_words", "separators", "word_length", "long_words", "repeats_neighbour", "repeated",
    "distinct", "closed_lines",
)


class Machine(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray


class Sparse(NamedTuple):
    """Features of texts one after another, and where each text begins."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray


def quality(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0,
    threshold: float = 0.3, text: str = "text", doc_id: str = "doc_id",
    metadata: tuple[str, ...] = ("n_chars",), keep_text: bool = True,
) -> DataFrame:
    """Every row with held_out, score and predicted."""
    row = docs if keep_text else docs.drop(text)
    meta = F.array(*(F.col(f"`{name}`").cast("double") for name in metadata)).cast("array<double>")
    learnable = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"),
        meta.alias("_meta"),
    )
    known = labelled(learnable, labels, "quality", folds, fold, SAMPLE)
    machine = train(learn_from(known), size(len(metadata)))
    scored = docs.select(
        tx.whole_row(row), held_out(doc_id, folds, fold).alias("_held"),
        F.struct(F.col(f"`{text}`").alias("text"), meta.alias("meta")).alias("_text"),
    )

    def judge(texts) -> list[pa.Array]:
        features = vectors([t["text"] for t in texts], [t["meta"] for t in texts])
        return [pa.array(1 / (1 + np.exp(-raw_scores(machine, features))), pa.float64())]

    judged = tx.map_texts(
        scored, [T.StructField("_score", T.DoubleType())], judge,
        length=lambda value: len(value["text"] or ""),
    )
    return tx.unfold(judged, row, {
        "held_out": F.col("_held"), "score": F.col("_score"),
        "predicted": (F.col("_score") >= threshold).cast("int"),
    })


def size(metadata: int) -> int:
    return BUCKETS + len(STATISTICS) + 2 * metadata


def learn_from(known: DataFrame) -> tuple[Sparse, np.ndarray]:
    """Features and labels of the training texts, in the order of their hashes."""
    picked = known.select(
        hash_of("doc_id").alias("hash"), "label",
        F.struct(F.col("_text").alias("text"), F.col("_meta").alias("meta")).alias("_text"),
    )

    def features(texts) -> list[pa.Array]:
        made = vectors([t["text"] for t in texts], [t["meta"] for t in texts])
        ends = pa.array(made.first, pa.int32())
        return [pa.ListArray.from_arrays(ends, pa.array(made.index, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(made.value, pa.float32()))]

    table = tx.map_texts(
        picked, [T.StructField("index", T.ArrayType(T.IntegerType())),
                 T.StructField("value", T.ArrayType(T.FloatType()))], features,
        length=lambda value: len(value["text"] or ""),
    ).orderBy("hash", "label").toArrow().combine_chunks()
    if not table.num_rows:
        return Sparse(np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64)), np.zeros(0)
    index = pa.chunked_array([c for c in table["index"].chunks]).combine_chunks()
    value = pa.chunked_array([c for c in table["value"].chunks]).combine_chunks()
    lengths = index.value_lengths().to_numpy()
    return (
        Sparse(index.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy()
               .astype(np.float64), np.concatenate(([0], np.cumsum(lengths)))),
        table["label"].to_numpy().astype(np.float64),
    )


_SYMBOL = [ord(sign) for sign in SYMBOLS]
_CLOSING = [ord(sign) for sign in CLOSING]
_SEPARATOR = [ord(sign) for sign in SEPARATORS]
_CAPITAL = np.array([chr(point).isupper() for point in range(0x600)])


def vectors(texts: list[str | None], metadata: list[list[float | None]]) -> Sparse:
    count = len(texts)
    points, offsets = tx.code_points(texts)
    spaced = tx.runs(tx.spaced_mask(points), offsets)
    words = tx.runs(tx.word_mask(points), offsets)
    hashes = tx.run_hashes(tx.ascii_lower(points), words.starts, words.ends)

    def per_text(row, weights=None):
        return np.bincount(row, weights, count).astype(float)

    def signs(mask):
        return per_text(tx.rows_at(offsets, np.flatnonzero(mask)))

    n = per_text(spaced.row)
    some, size = np.maximum(n, 1), spaced.ends - spaced.starts
    chars = np.maximum(per_text(spaced.row, size), 1)
    last, first = points[spaced.ends - 1], points[spaced.starts]
    small = points < 0x600
    capital = np.zeros(len(points), bool)
    capital[small] = _CAPITAL[points[small]]
    same = np.zeros(len(words.row), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    pairs, times = _buckets(words.row, hashes)
    # A line ends at a feed or the text's end; closed if a closing mark stands before that.
    line_end = np.zeros(len(points) + 1, bool)
    line_end[:-1] = points == 10
    line_end[offsets[1:]] = True
    ended = line_end[spaced.ends]
    word_count = np.maximum(per_text(words.row), 1)
    statistics = [
        (n > 0).astype(float), np.log1p(n) / 10, np.log1p(signs(points == 10)) / 6,
        np.minimum(signs(np.isin(points, _SYMBOL)) / some, 1),
        signs((points >= 48) & (points <= 57)) / chars, signs(capital) / chars,
        signs((points > 32) & (points < 128) & ~tx.word_mask(points)) / chars,
        per_text(spaced.row, (last == 33) | (last == 63)) / some,
        per_text(spaced.row, (size == 1) & np.isin(first, _SEPARATOR)) / some,
        np.minimum(chars / some / 20, 1) * (n > 0), per_text(spaced.row, size > 25) / some,
        per_text(words.row, same) / word_count,
        per_text(spaced.row, repeated_words(points, spaced)) / some,
        per_text(pairs[0]) / word_count,
        per_text(spaced.row, ended & np.isin(last, _CLOSING))
        / np.maximum(per_text(spaced.row, ended), 1),
    ]
    meta = np.array(metadata, float).reshape(count, -1)
    missing = ~np.isfinite(meta)
    logs = np.log1p(np.maximum(np.where(missing, 0, meta), 0)) / 16
    dense = np.concatenate([np.array(statistics).T, logs, missing], axis=1)

    weight = np.log1p(times)
    length = np.sqrt(per_text(pairs[0], weight**2))
    row = np.concatenate([pairs[0], np.repeat(np.arange(count), dense.shape[1])])
    index = np.concatenate([pairs[1], np.tile(BUCKETS + np.arange(dense.shape[1]), count)])
    value = np.concatenate([weight / length[pairs[0]], dense.ravel()])
    order = np.argsort(row, kind="stable")
    return Sparse(index[order], value[order], tx.segments(row, count))


def _buckets(row: np.ndarray, hashes: np.ndarray) -> tuple[tuple, np.ndarray]:
    """Distinct (row, bucket) pairs and how often each comes."""
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    pairs, times = np.unique(row * BUCKETS + bucket, return_counts=True)
    return np.divmod(pairs, BUCKETS), times


def raw_scores(machine: Machine, x: Sparse) -> np.ndarray:
    """Log-odds of each text; every text has features, so no segment is empty."""
    if len(x.first) < 2:
        return np.zeros(0)
    scaled = machine.factors[x.index] * x.value[:, None]
    starts = x.first[:-1]
    sums = np.add.reduceat(scaled, starts, axis=0)
    squares = np.add.reduceat((scaled**2).sum(axis=1), starts)
    linear = np.add.reduceat(machine.weights[x.index] * x.value, starts)
    return machine.bias + linear + ((sums**2).sum(axis=1) - squares) / 2


def train(sample: tuple[Sparse, np.ndarray], features: int) -> Machine:
    """Logistic loss by AdaGrad over small batches, in a fixed order."""
    x, label = sample
    draw = np.random.default_rng(7)
    machine = Machine(0.0, np.zeros(features), draw.normal(0, 0.05, (features, RANK)))
    if not 0 < label.sum() < len(label):
        return Machine(0.0, np.zeros(features), np.zeros((features, RANK)))
    bias = float(np.log(label.mean() / (1 - label.mean())))
    weights, factors = machine.weights, machine.factors
    bias_sum, weight_sum, factor_sum = 1e-8, np.full(features, 1e-8), np.full(factors.shape, 1e-8)
    for _ in range(EPOCHS):
        order = draw.permutation(len(label))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            length = x.first[rows + 1] - x.first[rows]
            ends = np.cumsum(length)
            taken = np.repeat(x.first[rows] - (ends - length), length) + np.arange(ends[-1])
            some = Sparse(x.index[taken], x.value[taken], np.concatenate(([0], ends)))
            wrong = 1 / (1 + np.exp(-raw_scores(Machine(bias, weights, factors), some)))
            wrong = (wrong - label[rows]) / len(rows)
            each = np.repeat(wrong, length) * some.value
            scaled = factors[some.index] * some.value[:, None]
            sums = np.repeat(np.add.reduceat(scaled, some.first[:-1], axis=0), length, axis=0)
            used, place = np.unique(some.index, return_inverse=True)
            step = np.bincount(place, each, len(used)) + DECAY * weights[used]
            pull = each[:, None] * (sums - scaled)
            turn = np.stack(
                [np.bincount(place, pull[:, f], len(used)) for f in range(RANK)], axis=1
            ) + DECAY * factors[used]
            bias_sum += wrong.sum() ** 2
            weight_sum[used] += step**2
            factor_sum[used] += turn**2
            bias -= RATE * wrong.sum() / np.sqrt(bias_sum)
            weights[used] -= RATE * step / np.sqrt(weight_sum[used])
            factors[used] -= RATE * turn / np.sqrt(factor_sum[used])
    return Machine(bias, weights, factors)
