import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silverlode.llm import packing
from silverlode.llm.word_bpe import PLAIN, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "don't 'tis it's ''s .'s I'll we've y'all's'd 'S 'LL", None, "", "   ", "\n",
    "a<|endoftext|>b <|startoftext|>", "naïve ÉLÈVE İstanbul", "日本語 text", "x²³ 1234 ½",
    "ΑΣ σας", "é", "a_b--c...d!? <|x", " x\u0085y\x1cz", "'", "a'", "l'été qu'il", "x" * 3000,
    "".join(map(chr, range(1, PLAIN + 40))), " ".join(map(chr, range(1, PLAIN))),
    "".join(f"a{chr(c)}b" for c in range(1, PLAIN)),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library):
    draw = random.Random(4)
    signs = "abcABÉß019.,'!-_ \n\t" * 3 + "日σΣ<|"
    texts = ODD + ["".join(draw.choice(signs) for _ in range(draw.randrange(200)))
                   for _ in range(200)]
    for part in (texts, [t for t in texts if t is None or t.isascii()]):
        found = word_bpe(PATH).encode(part)
        for place, text in enumerate(part):
            expected = library.encode(text or "", add_special_tokens=False).ids
            assert found.ids[found.offsets[place] : found.offsets[place + 1]].tolist() == expected


def test_sentence_ends_follow_marks_and_line_ends():
    found = word_bpe(PATH).encode(["one two. three\nfour", "a.b c!"])
    tokens = [word_bpe(PATH).library.id_to_token(int(i)) for i in found.ids]
    assert tokens[:5] == ["one</w>", "two</w>", ".</w>", "three</w>", "four</w>"]
    assert found.sentence_ends.tolist()[:2] == [3, 4]
    assert found.sentence_ends[-1] == len(found.ids)


def test_every_id_once_in_order_with_little_padding(spark, documents, library):
    draw = random.Random(1)
    texts = ODD + [". ".join(" ".join(f"word{draw.randrange(50)}" for _ in range(12))
                             for _ in range(draw.randrange(1, 60))) for _ in range(80)]
    texts.append("stone " * 20_000)
    docs = documents(texts).repartition(2).cache()
    pieces = packing.pack(docs, PATH, block=10_000).collect()
    windows, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
        parts[p.doc_id].append(p)
        assert len(p.ids) == 4 * p.length and p.length > 0
    for some in windows.values():
        some.sort(key=lambda p: p.offset)
        reached = 0
        for p in some:
            assert p.offset == reached
            reached += p.length
        assert reached <= 4096
    for name, text in enumerate(texts):
        own = sorted(parts[name], key=lambda p: p.start)
        ids = np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist()
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    total = sum(p.length for p in pieces)
    assert total > 0.95 * 4096 * (len(windows) - 2)


def least_cost(sentences, docs, length):
    """All cuts by a plain quadratic programme over the same places."""
    places = set(packing_places(sentences, docs, length))
    penalty = {p: packing.INNER_PENALTY for p in places}
    penalty |= {int(p): packing.SENTENCE_PENALTY for p in sentences}
    penalty |= {int(p): 0 for p in docs} | {0: 0}
    order, cost = sorted(places), {0: 0}
    for p in order[1:]:
        cost[p] = penalty[p] + min(
            cost[q] + length - (p - q) for q in order if q < p and p - q <= length
        )
    return cost[order[-1]], penalty


def packing_places(sentences, docs, length):
    known = sorted({0, *map(int, sentences), *map(int, docs)})
    step = min(packing.INNER_STEP, length)
    return known + [p for a, b in zip(known, known[1:]) for p in range(a + step, b, step)]


def test_cuts_cost_the_least(spark):
    draw = random.Random(9)
    for length in (64, 300, 4096):
        sizes = [draw.randrange(1, 900) for _ in range(12)]
        docs = np.cumsum(sizes)
        sentences = np.array(sorted({draw.randrange(1, docs[-1]) for _ in range(60)}))
        cuts = packing.best_cuts(sentences, docs, length)
        best, penalty = least_cost(sentences, docs, length)
        assert all(0 < b - a <= length for a, b in zip(cuts, cuts[1:]))
        assert sum(length - (b - a) + penalty[b] for a, b in zip(cuts, cuts[1:])) == best
    assert packing.best_cuts(np.zeros(0, int), np.zeros(0, int)) == [0]
