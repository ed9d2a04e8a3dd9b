"""Licence scan by conditional compression, with blocks proposed by their wording.

Blocks: every template (notices, headers and whole short licences) is aligned with the words of a
text near its trigger phrases, whatever the lines, blank lines and comment signs between them. A
span of words is a block if at least `AGREEING` of the words of both are common, in order; of
overlapping spans the one with most common less differing words stays, and other words of its line
and sentence join it if it still agrees with them. What else has a trigger phrase makes further
blocks, as runs of such sentences (a line ends a sentence).

Winners: each block is compressed alone and with each template as raw dictionary (zstandard); what
a template saves, as a share of the size alone, ranks it (ties: the earlier template). Of the
`FINALISTS` best, the one whose words differ least from the block's names it (ties: the better
rank). A block from an alignment is `exact` if no word differs from the winner's, `changed` if at
least `AGREEING` of both are common, else a `mention`, as any other block. Blocks with a comma
alone between them are one row, named by the best; `notices` lists each.

Texts without a trigger phrase end in the scan; no text is shortened, and equal blocks are judged
once per task. Null and empty texts have no block. Repeated rows are reported one by one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.license_templates import TEMPLATES, TEXTS, TRIGGERS
from silverlode.llm.shipping import in_arrow

LEVEL = 19
FINALISTS = 5
AGREEING = 0.8
# Distinct blocks whose result a task keeps.
REMEMBERED = 50_000

_SENTENCE = re.compile(r"[^.!?]*(?:[.!?](?!\s)[^.!?]*)*(?:[.!?]+|$)\s*")
_WORD = re.compile(r"\w+(?:[.-]\w+)*")
# Words of a phrase may stand on two lines, behind comment signs.
_SPACED = {phrase: "[^a-z0-9]+".join(map(re.escape, phrase.split())) for phrase in TRIGGERS}
_TRIGGER = re.compile("|".join(_SPACED.values()))
_BREAK = re.compile(r"[.!?][^\w\s]*\s|[\n\r]")
_COMMA = re.compile(r"\s*,\s*")


def license_scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, text: str = "text",
    doc_id: str = "doc_id", texts: Sequence[tuple[str, str]] = TEXTS,
) -> DataFrame:
    """One row per block: doc_id, first and end (characters), license, reduction, missing and
    added (words of the template and of the block that the other lacks), verdict, block, and
    notices: array of (license, first, end, missing, added, verdict), empty for a mention."""
    kind = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema["doc_id"].dataType
    words = T.ArrayType(T.StringType())
    result = T.StructType([
        T.StructField("doc_id", kind), T.StructField("first", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("license", T.StringType()),
        T.StructField("reduction", T.DoubleType()), T.StructField("missing", words),
        T.StructField("added", words), T.StructField("verdict", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("notices", T.ArrayType(T.StructType([
            T.StructField("license", T.StringType()), T.StructField("first", T.LongType()),
            T.StructField("end", T.LongType()), T.StructField("missing", words),
            T.StructField("added", words), T.StructField("verdict", T.StringType()),
        ]))),
    ])
    notice = pa.struct([
        ("license", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
        ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string())),
        ("verdict", pa.string()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(templates, texts)
        for batch in batches:
            found = [
                (name, *row)
                for name, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                for row in judge.rows(text)
            ]
            columns = list(zip(*found)) or [()] * len(result)
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.string(),
                     pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(),
                     pa.string(), pa.list_(notice)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, of) for column, of in zip(columns, kinds)], names=result.names
            )

    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    small = F.lower("text")
    return in_arrow(picked.filter(reduce(lambda a, b: a | b, (
        small.contains(max(phrase.split(), key=len))
        & (small.rlike(_SPACED[phrase]) if " " in phrase else F.lit(True))
        for phrase in TRIGGERS
    ))), work, result)


def blocks(text: str, taken: Sequence[tuple[int, int]] = ()) -> Iterator[tuple[int, int]]:
    """First and past-last character of each run of sentences with a trigger phrase outside the
    `taken` ranges (in order), none of which a run enters."""
    ends, marks = [end for _, end in taken], _marks(text)
    open_first = open_end = None
    for first, end in _units(text, marks):
        for a, b in _outside(first, end, taken, ends):
            if _touches(marks, a, b):
                if open_end is not None and open_end == a:
                    open_end = b
                else:
                    if open_end is not None:
                        yield _trimmed(text, open_first, open_end)
                    open_first, open_end = a, b
    if open_end is not None:
        yield _trimmed(text, open_first, open_end)


def _marks(text: str) -> tuple[list[int], list[int]]:
    """Where trigger phrases begin and end."""
    # The one letter whose lower case is longer would shift all places behind it.
    found = [mark.span() for mark in _TRIGGER.finditer(text.replace("\u0130", "i").lower())]
    return [a for a, _ in found], [b for _, b in found]


def _touches(marks: tuple[list[int], list[int]], first: int, end: int) -> bool:
    place = bisect_left(marks[1], first + 1)
    return place < len(marks[0]) and marks[0][place] < end


def _units(text: str, marks: tuple[list[int], list[int]]) -> Iterator[tuple[int, int]]:
    """The sentences of each line that a phrase touches, each up to the begin of the next one."""
    first = 0
    for line in text.splitlines(keepends=True):
        if _touches(marks, first, first + len(line)):
            for found in _SENTENCE.finditer(line):
                if found.end() > found.start():
                    yield first + found.start(), first + found.end()
        first += len(line)


def _outside(
    first: int, end: int, taken: Sequence[tuple[int, int]], ends: list[int]
) -> Iterator[tuple[int, int]]:
    """The parts of a range that lie in no taken one."""
    place = bisect_left(ends, first + 1)
    while place < len(taken) and taken[place][0] < end:
        if taken[place][0] > first:
            yield first, taken[place][0]
        first = taken[place][1]
        place += 1
    if first < end:
        yield first, end


def _trimmed(text: str, first: int, end: int) -> tuple[int, int]:
    block = text[first:end]
    return first + len(block) - len(block.lstrip()), first + len(block.rstrip())


class Notice(NamedTuple):
    """A template and the words (first, past-last) that agree with it."""

    place: int
    first: int
    end: int
    missing: list[str]
    added: list[str]
    common: int

    def differing(self) -> int:
        return len(self.missing) + len(self.added)

    def worth(self) -> int:
        return self.common - self.differing()


class Aligner:
    """Finds the spans of words that agree with a template.

    With c common words in order out of n of the template and m of the span, `AGREEING` = 0.8 means
    n + m <= 2.5 c, hence m <= 1.5 n and c >= 2 n / 3, and at most c / 2 of the c - 1 steps between
    common words skip any: at least n / 3 - 1 pairs of adjoining words are common too. So places
    with fewer such pairs are left out without losing a notice.
    """

    def __init__(self, wordings: Sequence[list[str]]) -> None:
        self.wordings = wordings
        self.vocabulary: dict[str, int] = {}
        self.numbers = [
            np.array([self.vocabulary.setdefault(word, len(self.vocabulary)) for word in wording])
            for wording in wordings
        ]
        self.pairs: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for place, wording in enumerate(wordings):
            for offset, pair in enumerate(zip(wording, wording[1:])):
                self.pairs[pair].append((place, offset))

    def __call__(self, words: list[str], triggers: list[int]) -> list[Notice]:
        """Notices near the words of `triggers` (in order), none overlapping another one."""
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, pair in enumerate(zip(words, words[1:])):
            for place, offset in self.pairs.get(pair, ()):
                reach = 3 * len(self.wordings[place]) // 2 + 1
                near = bisect_left(triggers, at - reach)
                if near < len(triggers) and triggers[near] <= at + reach:
                    hits[place].append((at - offset, at))
        found = [one for place in hits for one in self._of(place, sorted(hits[place]), words)]
        found.sort(key=lambda one: (-one.worth(), one.first, one.place))
        kept: list[Notice] = []
        firsts: list[int] = []
        for one in found:
            at = bisect_left(firsts, one.first)
            if (at == 0 or kept[at - 1].end <= one.first) and (
                at == len(kept) or one.end <= kept[at].first
            ):
                kept.insert(at, one)
                firsts.insert(at, one.first)
        return kept

    def _of(self, place: int, hits: list[tuple[int, int]], words: list[str]) -> Iterator[Notice]:
        n = len(self.wordings[place])
        slack = n // 2 + 1
        used: set[int] = set()  # words of notices found
        tried: int | None = None  # a begin whose window holds no more
        for at, (start, pair) in enumerate(hits):
            while start != tried:
                group = set()
                for later in range(at, len(hits)):
                    if hits[later][0] > start + slack:
                        break
                    if hits[later][1] not in used:
                        group.add(hits[later][1])
                if pair not in group or 3 * len(group) < n - 3:
                    break
                # The window may cut a notice, so it moves to what it holds while that gains more.
                gain, begin, end = self._best(place, words, used, start - slack, start)
                while gain >= AGREEING * n - 1e-9:
                    more = self._best(place, words, used, begin - slack, begin)
                    if more[0] < gain + 1e-9:
                        break
                    gain, begin, end = more
                one = self.agreeing(place, words[begin:end], begin) if gain > 0 else None
                if one is None:
                    tried = start
                    break
                yield one
                used.update(range(one.first, one.end))

    def _best(
        self, place: int, words: list[str], used: set[int], first: int, start: int
    ) -> tuple[float, int, int]:
        """The gain, begin and end of the best span from `first` on that may begin near `start`."""
        own, first = self.numbers[place], max(first, 0)
        window = np.array([
            -1 if k in used else self.vocabulary.get(words[k], -1)
            for k in range(first, min(start + 2 * len(own) + 2, len(words)))
        ])
        gain, last = _best_end(own, window)
        # The other way round from there; what ends earlier gains less.
        _, length = _best_end(own[::-1], window[: last + 1][::-1])
        return gain, first + last - length, first + last + 1

    def agreeing(self, place: int, span: list[str], first: int) -> Notice | None:
        wording = self.wordings[place]
        missing, added, common = _common(wording, span)
        if not common or 2 * common < AGREEING * (len(wording) + len(span)):
            return None
        return Notice(place, first, first + len(span), missing, added, common)


def _best_end(wording: np.ndarray, window: np.ndarray) -> tuple[float, int]:
    """The most that a span of the window gains, and its last place (the first such).

    A span of c common and x added words agrees if 2 c >= AGREEING (n + c + x), so each common
    word gains 2 - AGREEING, each added one costs AGREEING, and a gain of AGREEING n is enough.
    """
    cost = AGREEING * np.arange(len(window))
    best = np.full(len(window), -np.inf)
    for number in wording:
        met = np.flatnonzero(window == number)
        if len(met):
            before = np.where(met > 0, np.maximum(best[met - 1], 0), 0) + 2 - AGREEING
            best[met] = np.maximum(best[met], before)
            best = np.maximum.accumulate(best + cost) - cost
    end = int(np.argmax(best > best.max() - 1e-9))
    return float(best[end]), end


def _common(template: list[str], span: list[str]) -> tuple[list[str], list[str], int]:
    """Words of each that the other lacks, and how many are common, for the longest common
    subsequence."""
    if template == span:
        return [], [], len(span)
    numbers = {word: number for number, word in enumerate({*template, *span})}
    there = np.array([numbers[word] for word in span], np.int64)
    lengths = np.zeros((len(template) + 1, len(span) + 1), np.int64)
    for i, word in enumerate(template):
        more = lengths[i, :-1] + (there == numbers[word])
        np.maximum.accumulate(np.maximum(lengths[i, 1:], more), out=lengths[i + 1, 1:])
    missing, added, i, j = [], [], len(template), len(span)
    while i or j:
        if i and j and template[i - 1] == span[j - 1]:
            i, j = i - 1, j - 1
        elif j and lengths[i, j] == lengths[i, j - 1]:
            j -= 1
            added.append(span[j])
        else:
            i -= 1
            missing.append(template[i])
    return missing[::-1], added[::-1], int(lengths[-1, -1])


class Judge:
    def __init__(
        self, templates: Sequence[tuple[str, str]], texts: Sequence[tuple[str, str]] = ()
    ) -> None:
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.templates = [
            (name, _words(text), zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard
             .ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
            for name, text in (*templates, *texts)
        ]
        self.aligner = Aligner([wording for _, wording, _ in self.templates])
        self.known: dict[str, tuple] = {}  # of blocks without a notice
        self.ranks: dict[str, list[tuple[float, int]]] = {}

    def rows(self, text: str) -> list[tuple]:
        """The rows of a text without its doc_id, in order."""
        spans = [found.span() for found in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        ends = [b for _, b in spans]
        triggers = sorted({bisect_left(ends, mark + 1) for mark in _marks(text)[0]})
        notices = self.aligner(words, triggers)
        notices = [
            self._rounded(text, spans, words, one, notices[k - 1].end if k else 0,
                          notices[k + 1].first if k + 1 < len(notices) else len(words))
            for k, one in enumerate(notices)
        ]
        notices = [
            self._confirmed(text[spans[one.first][0] : spans[one.end - 1][1]],
                            words[one.first : one.end], one.first) for one in notices
        ]
        joined: list[list[Notice]] = []
        for one in notices:
            behind = joined and text[spans[joined[-1][-1].end - 1][1] : spans[one.first][0]]
            if behind and _COMMA.fullmatch(behind):
                joined[-1].append(one)
            else:
                joined.append([one])
        rows, taken = [], []
        for group in joined:
            first, end = spans[group[0].first][0], spans[group[-1].end - 1][1]
            # Marks up to the next white space belong to the notice.
            while end < len(text) and not text[end].isspace() and not text[end].isalnum():
                end += 1
            taken.append((first, end))
            block = text[first:end]
            best = max(group, key=Notice.worth)
            listed = [
                {"license": self.templates[one.place][0], "first": spans[one.first][0],
                 "end": spans[one.end - 1][1], "missing": one.missing, "added": one.added,
                 "verdict": _verdict(one)} for one in group
            ]
            rows.append((first, end, self.templates[best.place][0], self._saves(best.place, block),
                         best.missing, best.added, _verdict(best), block, listed))
        for first, end in blocks(text, taken):
            rows.append((first, end, *self(text[first:end]), text[first:end], []))
        return sorted(rows, key=lambda row: row[0])

    def _rounded(
        self, text: str, spans: list[tuple[int, int]], words: list[str], one: Notice, low: int,
        high: int,
    ) -> Notice:
        """The notice with the rest of its line and sentence, if it agrees with that as well."""
        # More words than these cannot agree.
        most = 3 * len(self.aligner.wordings[one.place]) // 2
        first, end = one.first, one.end
        while first > low and end - first <= most and not _BREAK.search(
            text, spans[first - 1][1], spans[first][0]
        ):
            first -= 1
        while end < high and end - first <= most and not _BREAK.search(
            text, spans[end - 1][1], spans[end][0]
        ):
            end += 1
        return self.aligner.agreeing(one.place, words[first:end], first) or one

    def _confirmed(self, block: str, words: list[str], first: int) -> Notice:
        """The finalist whose words differ least from those of the block."""
        best = None
        for _, place in self._ranked(block)[:FINALISTS]:
            one = Notice(place, first, first + len(words),
                         *_common(self.templates[place][1], words))
            if best is None or one.differing() < best.differing():
                best = one
        return best

    def _ranked(self, block: str) -> list[tuple[float, int]]:
        """(what it saves as a negative share, template) of all templates, the best first."""
        if block not in self.ranks:
            if len(self.ranks) >= REMEMBERED:
                self.ranks.clear()
            data = block.encode()
            alone = len(self.plain.compress(data))
            self.ranks[block] = sorted(
                ((len(compressor.compress(data)) - alone) / alone, place)
                for place, (_, _, compressor) in enumerate(self.templates)
            )
        return self.ranks[block]

    def _saves(self, place: int, block: str) -> float:
        return next(-saved for saved, other in self._ranked(block) if other == place)

    def __call__(self, block: str) -> tuple:
        """license, reduction, missing, added, verdict of a block without a notice"""
        if block not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            one = self._confirmed(block, _words(block), 0)
            self.known[block] = (self.templates[one.place][0], self._saves(one.place, block),
                                 one.missing, one.added, "mention")
        return self.known[block]


def _verdict(one: Notice) -> str:
    if not one.differing():
        return "exact"
    whole = 2 * one.common + one.differing()  # words of the template and of the block
    return "changed" if 2 * one.common >= AGREEING * whole else "mention"


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())
