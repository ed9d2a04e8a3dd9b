import random
import re
import zlib
from collections import Counter

from silverlode.llm import quality_model as qm
from silverlode.llm import quality_rules as qr

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1
                for j in (k, k + 1, k + 2)}
    seen, dup, lost, kept = set(), 0, 0, []
    for line in text.split("\n"):
        own = WORDS.findall(line)
        again = bool(own) and line in seen
        seen.add(line)
        dup += again
        separators = sum(w in qr.SEPARATORS for w in own)
        failed = bool(own) and (
            again or 5 * sum(c in qr.SYMBOLS for c in line) > len(own)
            or (len(own) >= 3 and 3 * sum(w[-1] in "!?" for w in own) > len(own))
            or (len(own) <= 3 and own[-1][-1] not in qr.CLOSING)
            or (separators >= 2 and 4 * separators >= len(own))
            or any(phrase in line.lower() for phrase in qr.PHRASES)
        )
        if failed:
            lost += sum(map(len, own))
        else:
            kept.append(line)
    chars = sum(map(len, words))
    base = len(words) < 50 or 2 * len(repeated) > len(words)
    return (len(words), chars, sum(c in qr.SYMBOLS for c in text), dup, len(repeated), base, lost,
            not base and 10 * lost <= 3 * chars, "\n".join(kept))


def test_rules_like_brute_force(documents):
    draw = random.Random(6)
    parts = ["one", "two", "three.", "|", "Home", "STOP!!", "#tag", "é", "a|b", "\n", "\n\n", "\t",
             "All rights reserved.", "x", "y", "z", "›", "end."]
    texts = [" ".join(draw.choice(parts) for _ in range(draw.randrange(120))) for _ in range(80)]
    texts += [None, "", "\n", "same line here\nsame line here\n" * 9, "word " * 200,
              " ".join(f"w{k}" for k in range(400)) + ".",
              "a b   c\x1cd\x85e", "all RIGHTS reserved\nLine of four words."]
    found = qr.clean_lines(documents(texts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "lost_chars", "kept", "cleaned",
    )
    expected = [(k, *brute(t)) for k, t in enumerate(texts)]
    got = sorted(tuple(r) for r in found.collect())
    assert [g[:9] for g in got] == [e[:9] for e in expected]
    assert [g[9] or "" for g in got] == [e[9] for e in expected]


def junk(draw, n):
    return " ".join(f"w{draw.randrange(500)}" + draw.choice(["###", "&&&", "***"])
                    for _ in range(n))


def clean(draw, n):
    return ". ".join(" ".join(f"w{draw.randrange(500)}" for _ in range(9)) for _ in range(n // 9))


def test_machine_tells_held_out_junk_from_clean_text(spark, documents, labels):
    draw = random.Random(1)
    marks = [k % 4 != 0 for k in range(600)]
    texts = [clean(draw, 90) if good else junk(draw, 90) for good in marks]
    found = qm.quality(
        spark, documents(texts), labels([(k, int(good), 0) for k, good in enumerate(marks)])
    ).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {
        k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0
    }
    assert all(r.predicted == marks[r.doc_id] and 0 <= r.score <= 1 for r in held)
    assert {r.predicted for r in found} == {0, 1}


def test_labels_of_held_out_rows_change_nothing(spark, documents, labels):
    draw = random.Random(2)
    texts = [clean(draw, 60) if k % 3 else junk(draw, 60) for k in range(200)]
    held = {k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 0}
    runs = []
    for flip in (0, 1):
        marks = labels([(k, int(bool(k % 3)) ^ (flip and k in held), 0) for k in range(200)])
        runs.append(sorted((r.doc_id, r.score) for r in
                           qm.quality(spark, documents(texts), marks).collect()))
    assert runs[0] == runs[1]


def test_pairs_by_the_sum_of_squares():
    import numpy as np

    draw = np.random.default_rng(3)
    machine = qm.Machine(0.3, draw.normal(size=9), draw.normal(size=(9, 4)))
    x = draw.normal(size=9)
    plain = 0.3 + x @ machine.weights + sum(
        machine.factors[i] @ machine.factors[j] * x[i] * x[j]
        for i in range(9) for j in range(i)
    )
    sparse = qm.Sparse(np.arange(9), x, np.array([0, 9]))
    assert abs(qm.raw_scores(machine, sparse)[0] - plain) < 1e-9
