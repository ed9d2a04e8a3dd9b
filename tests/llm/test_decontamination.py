import hashlib
import random
import re

from silverlode.llm import decontamination as dc

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(name)
    result = []
    for name, text in docs:
        w, hit, met = words(text), set(), set()
        for size in {len(window) for window in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    met |= windows[tuple(w[k : k + size])]
        listed = ",".join(sorted(str(m) for m in met if m is not None))
        result.append((name, len(w), len(hit), len([m for m in met if m is not None]),
                       hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(result, key=repr)


def judged(spark, docs, items):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    result = dc.contamination(spark, frame, bench, keep_text=False)
    return sorted((tuple(r) for r in result.collect()), key=repr)


def sample(seed, vocabulary=4):
    draw = random.Random(seed)
    some = [f"w{k}" for k in range(vocabulary)] + ["Straße", "B2"]

    def text(n):
        return draw.choice(" \n-.").join(draw.choice(some) for _ in range(n))

    items = [(k, text(n)) for k, n in enumerate([1, 3, 9, 10, 11, 25, 0, 12])]
    items += [(None, text(14)), (7, None), (3, items[4][1])]
    docs = [(k, text(draw.randrange(60))) for k in range(25)]
    docs += [(100 + k, text(8) + " , " + (t or "").upper() + "; " + text(5))
             for k, (_, t) in enumerate(items)]
    return [*docs, (5, None), (5, ""), docs[3], docs[3]], items


def test_like_brute_force(spark):
    for seed, vocabulary in ((1, 3), (2, 400)):
        docs, items = sample(seed, vocabulary)
        assert judged(spark, docs, items) == brute(docs, items)


def test_large_benchmarks_join_with_salt(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", 0)
    docs, items = sample(3)
    assert judged(spark, docs, items) == brute(docs, items)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(dc, "bitmap", lambda *_: b"\xff" * 64)
    docs, items = sample(4, 30)
    assert judged(spark, docs, items) == brute(docs, items)


def test_empty_benchmark(spark):
    docs, _ = sample(5)
    assert judged(spark, docs, []) == brute(docs, [])
