import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from silverlode.llm import language_id as li

SOUNDS = {"aa": ["the", "ing", "and", "ough"], "bb": ["sch", "ein", "ung", "über"],
          "cc": ["eau", "que", "ment", "çon"]}


def word(draw, lang):
    return "".join(draw.choice(SOUNDS[lang]) for _ in range(draw.randrange(1, 4)))


def text(draw, lang, n):
    return " ".join(word(draw, lang) for _ in range(n))


def test_held_out_texts_get_their_language(spark, documents):
    draw = random.Random(3)
    langs = [draw.choice(list(SOUNDS)) for _ in range(200)]
    docs = None
    for lang in SOUNDS:
        part = documents([(k, text(draw, lang, 30)) for k, of in enumerate(langs) if of == lang],
                         lang=lang)
        docs = part if docs is None else docs.union(part)
    extra = documents([(900, None), (901, " 12 - !"), (902, "the and the ing"), (903, "t"),
                       (904, "5 é"), (905, "日")], lang=None)
    found = li.language_mixtures(spark, docs.union(extra)).collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id < 900:
            assert r.lang_pred == r.lang and 0 <= r.score <= 1
    of = {r.doc_id: r for r in found}
    assert of[900].lang_pred == of[901].lang_pred == "und" and of[901].score == 0
    assert of[902].lang_pred == "aa"
    # A single letter is enough for a prediction.
    assert all(of[k].lang_pred in SOUNDS and of[k].score > 0 for k in (903, 904, 905))


def test_mixtures_come_out_with_their_shares(spark, documents):
    draw = random.Random(4)
    docs = None
    for lang in SOUNDS:
        part = documents([text(draw, lang, 300) for _ in range(8)], lang=lang)
        docs = part if docs is None else docs.union(part)
    model = li.learn(docs.select("lang", F.col("text").alias("_text")))
    mixed = text(draw, "aa", 140) + ". " + text(draw, "bb", 60)
    shares = li._judge([mixed, text(draw, "cc", 80)], model)[0].to_pylist()
    assert [s["lang"] for s in shares[0]] == ["aa", "bb"]
    part = len(mixed.split(". ")[0]) / len(mixed)
    assert abs(shares[0][0]["share"] - part) < 0.05
    assert [s["lang"] for s in shares[1]] == ["cc"] and shares[1][0]["share"] > 0.999


def test_fit_like_plain_expectation_maximisation():
    draw = np.random.default_rng(2)
    likelihood = draw.random((40, 3))
    times = draw.integers(1, 5, 40).astype(float)
    row = np.repeat([0, 1], 20)
    start = np.full((2, 3), 1 / 3)
    shares, fit = li._fit(row, likelihood, times, np.bincount(row, times), start)
    for own in (0, 1):
        p, some, n = np.full(3, 1 / 3), likelihood[row == own], times[row == own]
        for _ in range(li.STEPS):
            joint = some * p
            p = (joint / joint.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum()
        assert np.allclose(shares[own], p)
        assert np.isclose(fit[own], (n * np.log((some * p).sum(1))).sum())


def test_without_any_language_everything_is_unknown(spark, documents):
    found = li.language_mixtures(spark, documents(["some text", None], lang=None)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
