"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words (digits, letters, code points beyond ASCII) of the lower-cased text.

1. Counts: for every word, and for the first five and first four characters of longer ones, the
   toxic and the clean training texts that have it. Training takes about `SAMPLE` labelled texts
   outside the held-out fold, those with the least hash of the id, or all if there are fewer.
2. Log-odds with an informative Dirichlet prior: `PRIOR` pseudo-texts split as all texts are,

       delta = log((t + a_t) / (c + a_c)) - log(T / C),  variance 1 / (t + a_t) + 1 / (c + a_c)

   A key enters the lexicon when delta exceeds `MIN_Z` standard deviations and `MIN_ODDS`, so that
   the words of a language or topic that is a little more toxic than others stay out. Every key
   that passes is sent, 16 bytes each: at most those of two toxic texts of the sample. A token
   scores by the most specific key it has there, and every token pays `DRIFT`, so that texts
   score below zero on average.
3. Segments: one linear scan finds all maximal scoring segments of a text (each is the best
   among all that overlap it).
4. Calibration: for clean texts the best of n tokens follows an extreme-value law,
   P(S > s) = 1 - exp(-K n exp(-lambda s)). The lexicon is learned from all toxic training texts
   and three quarters of the clean ones (by a hash of the text, so copies stay together), and the
   law from the clean ones of the last quarter, which it has not seen: lambda from the mean excess of best scores
   over their median, K from how many exceed it. The evidence of a text is -log of the chance
   that a clean text of its length has its r best segments, for the r where that is least likely
   (the sum law of Karlin and Altschul), and the score is the logistic of the evidence plus
   log(`RATE`): at 0.5 about that share of clean texts passes for toxic.

Null, empty and wordless texts have no segment and score as clean. Repeated rows score alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.llm import text as tx
from silverlode.llm.folds import held_out, labelled
from silverlode.llm.shipping import in_arrow

SAMPLE = 50_000
PREFIXES = (5, 4)
PRIOR = 0.5
MIN_Z = 3.5
MIN_ODDS = 2.0
DRIFT = 0.25
RATE = 0.001
# Distinct keys a task collects before it sends their counts on.
COLLECTED = 1_000_000


class Lexicon(NamedTuple):
    """Sorted key hashes and their log-odds; the extreme-value law of clean texts."""

    keys: np.ndarray
    odds: np.ndarray
    decay: float
    scale: float


def toxicity(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0,
    threshold: float = 0.5, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True,
) -> DataFrame:
    """Every row with held_out, score, predicted, and segments: array of (first, end: code
    points, score, excess), the passages beyond chance."""
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = labelled(plain, labels, "toxic", folds, fold, SAMPLE).select(
        "label", F.col("text").alias("_text")
    )
    lexicon = learn(Job(spark), known)
    return score(docs, lexicon, text, keep_text, {
        "held_out": held_out(doc_id, folds, fold)
    }, threshold)


def score(
    docs: DataFrame, lexicon: Lexicon, text: str, keep_text: bool, more: dict, threshold: float
) -> DataFrame:
    row = docs if keep_text else docs.drop(text)
    segment = T.StructType([
        T.StructField("first", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()), T.StructField("excess", T.DoubleType()),
    ])
    fields = [T.StructField("_score", T.DoubleType()),
              T.StructField("_segments", T.ArrayType(segment))]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()),
                               ("score", pa.float64()), ("excess", pa.float64())]))

    def judge(texts) -> list[pa.Array]:
        results = evidence(texts, lexicon)
        return [pa.array([score for score, _ in results], pa.float64()),
                pa.array([found for _, found in results], kind)]

    # The fold is computed beside the text, not from the nested row, and takes no part in it.
    judged = tx.map_texts(
        docs.select(tx.whole_row(row), *(c.alias(f"_{name}") for name, c in more.items()),
                    F.col(f"`{text}`").alias("_text")),
        fields, judge,
    )
    return tx.unfold(judged, row, {
        **{name: F.col(f"_{name}") for name in more}, "score": F.col("_score"),
        "predicted": (F.col("_score") >= threshold).cast("int"), "segments": F.col("_segments"),
    })


def learn(job: Job, known: DataFrame) -> Lexicon:
    """The lexicon of labelled texts (label, _text)."""
    counted = T.StructType([T.StructField(name, T.LongType()) for name in ("key", "t", "c")])
    last_quarter = F.pmod(F.xxhash64("_text"), F.lit(4)) == 0
    taught = known.filter((F.col("label") == 1) | ~last_quarter)
    totals = {row.label: row.n for row in taught.groupBy("label").agg(F.count("*").alias("n"))
              .collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0)
    counts = (
        in_arrow(taught, _count, counted)
        .groupBy("key").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )
    share = toxic / (toxic + clean)
    t, c = F.col("t") + PRIOR * share, F.col("c") + PRIOR * (1 - share)
    surest = (
        counts.filter("t > 1").withColumn("odds", F.log(t / c) - math.log(toxic / clean))
        .withColumn("z", F.col("odds") / F.sqrt(1 / t + 1 / c))
        .filter((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS)).select("key", "odds")
    )
    rows = sorted((row.key & 0xFFFFFFFFFFFFFFFF, row.odds) for row in surest.collect())
    lexicon = Lexicon(np.array([key for key, _ in rows], np.uint64),
                      np.array([odds for _, odds in rows], float), 1.0, 1.0)
    return _calibrated(known.filter(last_quarter & (F.col("label") == 0)), lexicon)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean texts of each key, collected over a task."""

    def merge(parts):
        keys, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return [keys, *(
            np.bincount(which, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64)
            for k in (1, 2)
        )]

    def send(parts):
        keys, t, c = merge(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(t), pa.array(c)], names=["key", "t", "c"]
        )

    parts: list = []
    size = 0
    for batch in batches:
        labels = batch["label"].to_numpy().astype(np.int64)
        texts = batch["_text"].to_pylist()
        for first, end in tx.slices(texts):
            words, levels, _ = _keys(texts[first:end])
            row = np.concatenate([words.row[of] for of, _ in levels])
            key = np.concatenate([hashes for _, hashes in levels])
            # One count per text: the first of its equal keys.
            _, once = np.unique(
                tx.mix(key + row.astype(np.uint64) * tx._BASE), return_index=True
            )
            key, label = key[once], labels[first:end][row[once]]
            parts.append(merge([(key, label, 1 - label)]))
            size += len(parts[-1][0])
            if size > COLLECTED:
                yield send(parts)
                parts, size = [], 0
    if parts:
        yield send(parts)


def _keys(texts):
    """Words, per level (whole, five, four characters) the words that have a key and the key's
    hash, and where texts begin in code points."""
    points, offsets = tx.code_points([text.lower() if text else None for text in texts])
    words = tx.runs(tx.word_mask(points), offsets)
    size = words.ends - words.starts
    levels = [(np.arange(len(size)), tx.run_hashes(points, words.starts, words.ends))]
    for length in PREFIXES:
        of = np.flatnonzero(size > length)
        hashes = tx.run_hashes(points, words.starts[of], words.starts[of] + length)
        levels.append((of, tx.mix(hashes + np.uint64(length))))
    return words, levels, offsets


def _odds(texts, lexicon: Lexicon):
    """Words, their log-odds (0 without a key in the lexicon) and where texts begin."""
    words, levels, offsets = _keys(texts)
    odds = np.zeros(len(words.row))
    if len(lexicon.keys):
        for of, hashes in reversed(levels):  # the most specific last
            place = np.minimum(np.searchsorted(lexicon.keys, hashes), len(lexicon.keys) - 1)
            met = lexicon.keys[place] == hashes
            odds[of[met]] = lexicon.odds[place[met]]
    return words, odds, offsets


def segments(places: list[int], scores: list[float], drift: float) -> list[tuple]:
    """All maximal scoring segments of a text whose tokens score -drift except at `places`:
    (first place, last place, score), by a single scan over the places.

    Each candidate keeps the running total before and after it. A new one is merged with the
    nearest candidate whose total before lies below its own, when that raises the total.
    """
    found: list[list] = []  # first, last, total before, total after
    total, behind = 0.0, -1
    for place, gain in zip(places, scores):
        total -= drift * (place - behind - 1)
        behind = place
        if gain <= drift:
            total += gain - drift
            continue
        one = [place, place, total, total + gain - drift]
        total = one[3]
        while True:
            left = len(found) - 1
            while left >= 0 and found[left][2] >= one[2]:
                left -= 1
            if left < 0 or found[left][3] >= one[3]:
                found.append(one)
                break
            one = [found[left][0], one[1], found[left][2], one[3]]
            del found[left:]
    return [(first, last, after - before) for first, last, before, after in found]


def _scans(texts, lexicon: Lexicon):
    """Per text: its number of tokens, its segments (in words of the text), first word, words."""
    words, odds, offsets = _odds(texts, lexicon)
    begin = tx.segments(words.row, len(texts))
    scored = np.flatnonzero(odds)
    ends = np.searchsorted(scored, begin)
    for row in range(len(texts)):
        own = scored[ends[row] : ends[row + 1]]
        found = []
        if len(own):
            found = segments((own - begin[row]).tolist(), odds[own].tolist(), DRIFT)
        yield int(begin[row + 1] - begin[row]), found, begin[row], words, offsets[row]


def evidence(texts, lexicon: Lexicon) -> list[tuple[float, list[dict]]]:
    """Per text its score and the segments beyond chance."""
    results = []
    for n, found, first_word, words, offset in _scans(texts, lexicon):
        passages = []
        for first, last, total in found:
            excess = lexicon.decay * total - math.log(max(lexicon.scale * n, 1e-9))
            if excess > 0:
                passages.append({
                    "first": int(words.starts[first_word + first] - offset),
                    "end": int(words.ends[first_word + last] - offset),
                    "score": total, "excess": excess,
                })
        strength = unlikely(sorted((p["excess"] for p in passages), reverse=True))
        results.append((1 / (1 + math.exp(min(-strength - math.log(RATE), 700))), passages))
    return results


def unlikely(excesses: list[float]) -> float:
    """-log of the chance of the best r of these (greatest first), for the best r; trying one
    more costs log 2."""
    best, total = 0.0, 0.0
    for r, excess in enumerate(excesses, 1):
        total += excess
        if total > 1:
            chance = (r - 1) * math.log(total) - total - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -chance - (r - 1) * math.log(2))
    return best


def _calibrated(clean: DataFrame, lexicon: Lexicon) -> Lexicon:
    """The extreme-value law from all clean texts of the last quarter, as a histogram of best
    scores to one decimal."""
    result = T.StructType([T.StructField("best", T.DoubleType()), T.StructField("n", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["_text"].to_pylist()
            for first, end in tx.slices(texts):
                scanned = [
                    (round(max((s for _, _, s in found), default=0.0), 1), n)
                    for n, found, *_ in _scans(texts[first:end], lexicon)
                ]
                best, n = zip(*scanned)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best, pa.float64()), pa.array(n, pa.int64())], names=["best", "n"]
                )

    rows = (
        in_arrow(clean, work, result).groupBy("best")
        .agg(F.sum("n").alias("n"), F.count("*").alias("texts")).collect()
    )
    tokens = max(sum(row.n for row in rows), 1)
    beyond = sorted((row.best, row.texts) for row in rows if row.best > 0)
    half, median = sum(texts for _, texts in beyond) / 2, 0.0
    for best, texts in beyond:
        if half <= 0:
            break
        median, half = best, half - texts
    over = [(best - median, texts) for best, texts in beyond if best > median]
    # One more text at an excess of 1 keeps the law defined when no or few texts exceed.
    count = sum(texts for _, texts in over) + 1
    decay = count / (sum(excess * texts for excess, texts in over) + 1)
    return lexicon._replace(decay=decay, scale=count / tokens * math.exp(decay * median))
