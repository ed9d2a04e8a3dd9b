"""Language mixtures by expectation-maximisation over character n-grams.

The lower-cased text, with everything but letters as a space, is a sample of character 4-grams
from a mixture of languages. Training counts the 4-grams, hashed to 65,536 buckets, of every
training text of a language. For a document, EM finds the proportions pi that maximise

    sum over grams g of n(g) log(sum over languages l of pi(l) P(g | l))

by sharing each gram among the languages and averaging the shares. Languages are ordered by the
proportions of all; then sets of the first 1, 2, 3, ... of them are fitted, and the next language
stays out unless it raises the log-likelihood by more than the penalty of one proportion,
`PENALTY` times half the log of the effective sample (a quarter of the grams: they overlap).

The prediction is the language of the greatest proportion in the chosen set, the score that
proportion. A null text or one without a letter is `und` with score 0, as is everything when
nothing can be learned. Equal proportions go to the language first in order. Repeated rows score
alike; a result replaces an input column of its name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm import text as tx
from silverlode.llm.folds import held_out
from silverlode.llm.shipping import in_arrow

GRAM = 4
BUCKETS = 1 << 16
STEPS = 12
PENALTY = 2.0
SMOOTHING = 0.5


class Model(NamedTuple):
    """Languages in order, and P(bucket | language) as a row per bucket."""

    names: list[str]
    likelihood: np.ndarray


def language_mixtures(
    spark: SparkSession, docs: DataFrame, folds: int = 4, fold: int = 2, text: str = "text",
    doc_id: str = "doc_id", lang: str = "lang", keep_text: bool = True,
) -> DataFrame:
    """Every row with held_out, lang_pred, score and languages: array of (lang, share)."""
    known = docs.filter(
        ~held_out(doc_id, folds, fold) & F.col(f"`{lang}`").isNotNull()
    ).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("_text"))
    model = learn(known)
    row = docs if keep_text else docs.drop(text)
    share = T.StructType([T.StructField("lang", T.StringType()),
                          T.StructField("share", T.DoubleType())])
    judged = tx.map_texts(
        docs.select(tx.whole_row(row), held_out(doc_id, folds, fold).alias("_held"),
                    F.col(f"`{text}`").alias("_text")),
        [T.StructField("_languages", T.ArrayType(share))], lambda texts: _judge(texts, model),
        limit=100_000,
    )
    first = F.get("_languages", F.lit(0))
    return tx.unfold(judged, row, {
        "held_out": F.col("_held"), "lang_pred": F.coalesce(first["lang"], F.lit("und")),
        "score": F.coalesce(first["share"], F.lit(0.0)), "languages": F.col("_languages"),
    })


def learn(known: DataFrame) -> Model:
    """Gram counts of all training texts (lang, _text), summed by language and bucket."""
    counted = T.StructType([T.StructField("lang", T.StringType()),
                            T.StructField("bucket", T.IntegerType()),
                            T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch["lang"].to_pylist(), batch["_text"].to_pylist()
            for first, end in tx.slices(texts):
                bucket, row = grams(texts[first:end])
                ends = tx.segments(row, end - first)
                for place, lang in enumerate(langs[first:end]):
                    total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    own = bucket[ends[place] : ends[place + 1]]
                    if len(own) > BUCKETS // 8:
                        total += np.bincount(own, minlength=BUCKETS)
                    else:
                        np.add.at(total, own, 1)
        for lang, total in totals.items():
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(met), pa.string()), pa.array(met, pa.int32()),
                 pa.array(total[met], pa.int64())], names=counted.names,
            )

    sums = in_arrow(known, count, counted).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # A row per language, its buckets as two arrays: what comes here is the model itself.
    packed = sums.groupBy("lang").agg(
        F.collect_list(F.struct("bucket", "n")).alias("counts")
    ).select("lang", F.col("counts.bucket").alias("bucket"), F.col("counts.n").alias("n"))
    table = packed.toArrow()
    order = np.argsort(np.array(table["lang"].to_pylist(), object).astype(str), kind="stable")
    names = [table["lang"][int(place)].as_py() for place in order]
    likelihood = np.full((BUCKETS, len(names)), SMOOTHING)
    for column, place in enumerate(order):
        likelihood[table["bucket"][int(place)].values.to_numpy(), column] += (
            table["n"][int(place)].values.to_numpy()
        )
    return Model(names, likelihood / likelihood.sum(axis=0, keepdims=True))


def _letters() -> np.ndarray:
    letter = np.zeros(0x110000, bool)
    for point in range(0x110000):
        letter[point] = unicodedata.category(chr(point))[0] == "L"
    return letter


_letter: list[np.ndarray] = []


def grams(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every 4-gram; a text is padded with a space before it and two behind, so
    that a single letter has one as well."""
    if not _letter:
        _letter.append(_letters())
    points, offsets = tx.code_points([f" {text.lower()}  " if text else None for text in texts])
    points = np.where(_letter[0][points], points, np.uint32(32)).astype(np.uint64)
    hashed = np.zeros(max(len(points) - GRAM + 1, 0), np.uint64)
    for place in range(GRAM):
        hashed = hashed * tx._BASE + points[place : place + len(hashed)]
    bucket = ((hashed * tx._BASE) >> np.uint64(48)).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    # Inside one text, and holding a letter: spaces alone say nothing.
    blank = np.cumsum(np.concatenate(([0], points == 32)))
    within = (row[: len(hashed)] == row[len(row) - len(hashed) :]) & (
        blank[GRAM : GRAM + len(hashed)] - blank[: len(hashed)] < GRAM
    )
    return bucket[within], row[: len(hashed)][within]


def _judge(texts, model: Model) -> list[pa.Array]:
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    if not model.names:
        return [pa.array([[] for _ in texts], kind)]
    bucket, row = grams(texts)
    pairs, times = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket = np.divmod(pairs, BUCKETS)
    likelihood = np.ascontiguousarray(model.likelihood.T[:, bucket]).T
    shares = mixtures(row, likelihood, times.astype(float), len(texts))
    results = []
    for text_shares in shares:
        order = [place for place in np.argsort(-text_shares, kind="stable")
                 if text_shares[place] > 0]
        results.append([
            {"lang": model.names[place], "share": float(text_shares[place])} for place in order
        ])
    return [pa.array(results, kind)]


def mixtures(row: np.ndarray, likelihood: np.ndarray, times: np.ndarray, rows: int) -> np.ndarray:
    """Proportions of the chosen languages (0 elsewhere) for each row of grams."""
    languages = likelihood.shape[1]
    total = np.bincount(row, times, rows)
    has = total > 0
    everything = np.full((rows, languages), 1 / languages)
    everything[~has] = 0
    fitted, _ = _fit(row, likelihood, times, total, everything)
    rank = np.argsort(np.argsort(-fitted, axis=1, kind="stable"), axis=1, kind="stable")
    chosen = np.zeros((rows, languages))
    best = np.full(rows, -np.inf)
    open_rows = has.copy()
    for size in range(1, languages + 1):
        start = np.where((rank < size) & open_rows[:, None], fitted + 1e-3, 0.0)
        start /= np.maximum(start.sum(axis=1, keepdims=True), 1e-300)
        taken = np.flatnonzero(open_rows[row])
        some = slice(None) if len(taken) == len(row) else taken
        shares, fit = _fit(row[some], likelihood[some], times[some], total, start)
        # Grams overlap fourfold, so both the likelihood and the sample count a quarter.
        worth = fit / GRAM - PENALTY * size * np.log(np.maximum(total / GRAM, 2)) / 2
        open_rows &= worth > best
        best[open_rows] = worth[open_rows]
        chosen[open_rows] = shares[open_rows]
        if not open_rows.any():
            break
    return chosen


def _fit(row, likelihood, times, total, shares):
    """EM from the given proportions (a language at 0 stays there); proportions and the
    log-likelihood of each row. Works on a line of grams per language."""
    rows = len(total)
    if not len(row):
        return shares, np.zeros(rows)
    ends = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    present = row[ends]
    width = np.diff(np.concatenate((ends, [len(row)])))
    lines = likelihood.T
    shares = shares.T.copy()
    single = (shares > 0).sum(axis=0).max() <= 1
    for _ in range(0 if single else STEPS):
        joint = np.repeat(shares[:, present], width, axis=1)
        joint *= lines
        joint *= times / joint.sum(axis=0)
        shares[:, present] = np.add.reduceat(joint, ends, axis=1) / total[present]
    mixed = (lines * np.repeat(shares[:, present], width, axis=1)).sum(axis=0)
    fit = np.bincount(row, times * np.log(np.maximum(mixed, 1e-300)), rows)
    return shares.T, fit
