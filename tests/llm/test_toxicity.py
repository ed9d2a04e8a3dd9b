import math
import random
import re
import zlib
from collections import Counter

import xxhash

from silverlode.llm import toxicity as tox


def maximal(scores):
    """All maximal scoring segments by their definition, recursively: the best segment (the
    shortest and first of equals), then what lies left and right of it."""
    if not scores:
        return []
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-9 and (
                best is None or total > best[0] + 1e-9
                or (total > best[0] - 1e-9 and j - i < best[2] - best[1])
            ):
                best = (total, i, j)
    if best is None:
        return []
    total, i, j = best
    right = [(a + j + 1, b + j + 1, s) for a, b, s in maximal(scores[j + 1 :])]
    return [*maximal(scores[:i]), (i, j, total), *right]


def test_segments_like_their_definition():
    draw = random.Random(5)
    for _ in range(300):
        n = draw.randrange(1, 25)
        gains = {k: draw.choice([0.1, 1.25, 2.25, 3.5, 0.5]) for k in range(n) if draw.random() < .4}
        places = sorted(gains)
        found = tox.segments(places, [gains[k] for k in places], 0.25)
        scores = [gains.get(k, 0.0) - 0.25 for k in range(n)]
        assert sorted((a, b, round(s, 6)) for a, b, s in found) == sorted(
            (a, b, round(s, 6)) for a, b, s in maximal(scores)
        )


def corpus(seed, n):
    draw = random.Random(seed)
    texts, marks = [], []
    for k in range(n):
        words = [f"w{int(draw.paretovariate(0.6)) % 800}" for _ in range(draw.randrange(20, 120))]
        toxic = k % 8 == 0
        if toxic:
            at = draw.randrange(len(words))
            words[at:at] = [draw.choice(["vileword", "foulstem" + draw.choice("abcdefgh"),
                                         "nastyone"]) for _ in range(4)]
        texts.append(" ".join(words))
        marks.append(int(toxic))
    return texts, marks


def test_held_out_toxic_texts_are_found_and_clean_ones_left_alone(spark, documents, labels):
    texts, marks = corpus(1, 1200)
    found = tox.toxicity(
        spark, documents(texts), labels([(k, 1, mark) for k, mark in enumerate(marks)])
    ).collect()
    held = [r for r in found if r.held_out]
    assert len(held) == sum(zlib.crc32(str(k).encode()) % 5 == 0 for k in range(1200))
    toxic = [r for r in held if marks[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.predicted for r in held) - sum(r.predicted for r in toxic) <= 0.02 * len(held)
    for r in toxic:
        passages = [texts[r.doc_id][s.first : s.end] for s in r.segments]
        assert any("vileword" in p or "foulstem" in p or "nastyone" in p for p in passages)


def test_labels_of_held_out_rows_change_nothing(spark, documents, labels):
    texts, marks = corpus(2, 400)
    runs = []
    for flip in (0, 1):
        rows = [(k, 1, mark ^ (flip and zlib.crc32(str(k).encode()) % 5 == 0))
                for k, mark in enumerate(marks)]
        runs.append(sorted((r.doc_id, r.score) for r in
                           tox.toxicity(spark, documents(texts), labels(rows)).collect()))
    assert runs[0] == runs[1]


def test_more_segments_are_stronger_evidence():
    assert tox.unlikely([]) == 0
    assert tox.unlikely([6.0, 6.0]) > tox.unlikely([6.0]) > 5.9


def brute(texts, marks):
    """The score of every text, from plain counts, sums and definitions."""
    def keys(word):
        return [word, *((word[:n], n) for n in tox.PREFIXES if len(word) > n)]

    words = [re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower()) for text in texts]
    taught, law = [], []
    for k, text in enumerate(texts):
        if zlib.crc32(str(k).encode()) % 5:
            last = xxhash.xxh64(text.encode(), seed=42).intdigest() % 4 == 0
            (law if last and not marks[k] else taught).append(k)
    times = [Counter(), Counter()]
    for k in taught:
        times[marks[k]].update({key for word in words[k] for key in keys(word)})
    toxic = sum(marks[k] for k in taught)
    clean = len(taught) - toxic
    share, odds = toxic / (toxic + clean), {}
    for key, t in times[1].items():
        t, c = t + tox.PRIOR * share, times[0][key] + tox.PRIOR * (1 - share)
        delta = math.log(t / c) - math.log(toxic / clean)
        if times[1][key] > 1 and delta >= tox.MIN_ODDS and delta >= tox.MIN_Z * math.sqrt(1 / t + 1 / c):
            odds[key] = delta
    scores = [[next((odds[key] for key in keys(word) if key in odds), 0.0) - tox.DRIFT
               for word in own] for own in words]
    found = [[s for _, _, s in maximal(own)] if max(own, default=0) > 0 else [] for own in scores]
    best = [(round(max(found[k], default=0.0), 1), len(words[k])) for k in law]
    tokens, over = max(sum(n for _, n in best), 1), sorted(s for s, _ in best if s > 0)
    median = over[math.ceil(len(over) / 2) - 1] if over else 0.0
    over = [s - median for s in over if s > median]
    decay = (len(over) + 1) / (sum(over) + 1)
    scale = (len(over) + 1) / tokens * math.exp(decay * median)
    return [
        1 / (1 + math.exp(-tox.unlikely(sorted((e for e in (
            decay * s - math.log(max(scale * len(own), 1e-9)) for s in segments) if e > 0
        ), reverse=True)) - math.log(tox.RATE)))
        for own, segments in zip(words, found)
    ]


def test_scores_like_brute_force(spark, documents, labels):
    texts, marks = corpus(3, 500)
    # Some clean texts with a toxic word, so that the law has something to learn from.
    draw = random.Random(4)
    for k in range(len(texts)):
        if not marks[k] and draw.random() < 0.1:
            texts[k] += " vileword" * draw.randrange(1, 3)
    found = tox.toxicity(
        spark, documents(texts), labels([(k, 1, mark) for k, mark in enumerate(marks)])
    ).collect()
    expected = brute(texts, marks)
    assert len({round(r.score, 6) for r in found}) > 10
    for r in found:
        assert abs(r.score - expected[r.doc_id]) < 1e-9
