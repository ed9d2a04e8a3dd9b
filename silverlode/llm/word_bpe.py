"""Ids of a word-level BPE vocabulary (tokenizers file), each distinct word encoded once a worker.

The file's pre-tokenizer drops white space and splits the rest into contractions, letter runs,
single digits and runs of other signs; each of these is encoded alone. Texts whose code points
all lie below U+0250, where that split and lower-casing are plain tables, are split as arrays and
only words new to the worker reach the library, many at once. Any other text, and one that may
hold a special token's string, goes to the library whole. Both ways give the library's ids.
"""

from __future__ import annotations

import unicodedata
from typing import NamedTuple

import numpy as np

from silverlode.llm import text as tx

# Beyond this many code points a text goes to the library; below, no code point composes.
PLAIN = 0x250
# Distinct words a worker remembers (about 40 bytes each); those it met last stay.
REMEMBERED = 600_000
# New words that reach the library at once.
TOGETHER = 4_000
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_WHITE = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}


class Ids(NamedTuple):
    """Ids of all texts one after another, where each text begins, and (sorted, over all ids)
    the places after which a sentence or line ends."""

    ids: np.ndarray
    offsets: np.ndarray
    sentence_ends: np.ndarray


class Known(NamedTuple):
    """Ids of words by hash: sorted keys, a sign of each word that must agree as well, and where
    in `ids` those of the word begin and how many they are."""

    keys: np.ndarray
    signs: np.ndarray
    first: np.ndarray
    size: np.ndarray
    ids: np.ndarray

    def places(self, keys: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """The place of each word, -1 of those not known."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[place] == keys) & (self.signs[place] == signs), place, -1)

    def with_words(
        self, keys: np.ndarray, signs: np.ndarray, size: np.ndarray, ids: np.ndarray
    ) -> Known:
        """These words too, whose keys are sorted; `ids` holds theirs one after another. A key
        that is held already stays as it is."""
        place = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        fresh[inside] = self.keys[place[inside]] != keys[inside]
        first = len(self.ids) + np.cumsum(size) - size
        return Known(*(
            np.insert(old, place[fresh], new[fresh])
            for old, new in zip(self[:4], (keys, signs, first, size))
        ), np.concatenate([self.ids, ids]))


_NOTHING = Known(
    np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64),
    np.zeros(0, np.uint32),
)


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of every run, one run after another."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(PLAIN, _OTHER, np.uint8)
    lower = np.arange(PLAIN, dtype=np.uint32)
    plain = np.ones(PLAIN, bool)
    for point in range(PLAIN):
        category = unicodedata.category(chr(point))
        if point in _WHITE:
            kind[point] = _SPACE
        elif category[0] == "L":
            kind[point] = _LETTER
        elif category[0] == "N":
            kind[point] = _DIGIT
        small = chr(point).lower()
        plain[point] = len(small) == 1 and ord(small) < PLAIN
        lower[point] = ord(small) if plain[point] else point
    return kind, lower, plain


_KIND, _LOWERED, _PLAIN_POINT = _tables()
_loaded: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The vocabulary of a file, loaded once per worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


class WordBpe:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.marks = {
            number for word, number in self.library.get_vocab().items()
            if word.removesuffix("</w>")[-1:] in (".", "!", "?") and word.endswith("</w>")
        }
        # Ids that end a word: every part of a split text ends with one, and none is inside.
        vocabulary = self.library.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        # Words met lately, and those that were known when the former were begun.
        self.known = self.older = _NOTHING

    def encode(self, texts: list[str | None]) -> Ids:
        points, offsets = tx.code_points(texts)
        usual = np.zeros(len(points), bool)
        below = points < PLAIN
        usual[below] = _PLAIN_POINT[points[below]]
        odd = np.unique(tx.rows_at(offsets, np.flatnonzero(~usual)))
        whole = {int(row) for row in odd} | {
            row for row, text in enumerate(texts) if text and "<|" in text
        }
        if not whole:
            return self._encode_plain(points, offsets)
        plain = self._encode_plain(*tx.code_points(
            [None if row in whole else text for row, text in enumerate(texts)]
        ))
        parts, ends, sizes = [], [], np.diff(plain.offsets)
        place = 0
        for row, text in enumerate(texts):
            if row in whole:
                ids = self._encode(text)
                own = np.flatnonzero(np.isin(ids, list(self.marks))) + 1
                sizes[row] = len(ids)
            else:
                first, end = plain.offsets[row : row + 2]
                ids = plain.ids[first:end]
                low, high = np.searchsorted(plain.sentence_ends, (first, end), side="right")
                own = plain.sentence_ends[low:high] - first
            parts.append(ids)
            ends.append(own + place)
            place += len(ids)
        return Ids(np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes))),
                   np.concatenate(ends))

    def _encode_plain(self, points: np.ndarray, offsets: np.ndarray) -> Ids:
        kind, lowered = _KIND[points], _LOWERED[points]
        solid = kind != _SPACE
        cut = np.zeros(len(points), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        quote = points == 39
        if quote.any():  # contractions span kinds: leave the space-delimited run whole
            spaced = tx.runs(solid, offsets)
            holds = np.add.reduceat(quote, spaced.starts) > 0
            depth = np.zeros(len(points) + 1, np.int8)
            depth[spaced.starts[holds]] = 1
            depth[spaced.ends[holds]] -= 1
            cut &= np.cumsum(depth[:-1], dtype=np.int8) == 0
        words = tx.runs(solid, offsets, np.flatnonzero(cut))
        if not len(words.starts):
            return Ids(np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64),
                       np.zeros(0, np.int64))
        keys, one, which = np.unique(
            tx.run_hashes(lowered, words.starts, words.ends), return_index=True,
            return_inverse=True,
        )
        first, size, pool = self._look_up(keys, lowered, words.starts[one], words.ends[one])
        taken = size[which]
        ends = np.cumsum(taken)
        ids = pool[ragged(first[which], taken)]
        last = points[words.ends - 1]
        after = np.ones(len(points) + 1, bool)
        after[:-1] = ~solid
        after[offsets] = True
        closing = np.isin(last, (33, 46, 63)) | _next_is_line_end(points, words.ends)
        per_text = np.concatenate(([0], ends))[tx.segments(words.row, len(offsets) - 1)]
        return Ids(ids, per_text, ends[closing & after[words.ends]])

    def _look_up(
        self, keys: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word (keys are sorted) where its ids begin and how many they are, and the ids.
        Half of what is remembered is dropped at a time, and of that only words that were not met
        since the last time."""
        if len(self.known.keys) > REMEMBERED // 2:
            self.known, self.older = _NOTHING, self.known
        signs = (points[starts] * 1009 + points[ends - 1]) * 1009 + (ends - starts)
        signs = signs.astype(np.uint32)
        place = self.known.places(keys, signs)
        first, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        held = np.flatnonzero(place >= 0)
        first[held], size[held] = self.known.first[place[held]], self.known.size[place[held]]
        left = np.flatnonzero(place < 0)
        place = self.older.places(keys[left], signs[left])
        again, place, new = left[place >= 0], place[place >= 0], left[place < 0]
        size[again] = self.older.size[place]
        size[new], new_ids = self._spell(tx.strings(points, starts[new], ends[new]))
        from_older = self.older.ids[ragged(self.older.first[place], size[again])]
        added = np.concatenate([from_older, new_ids])
        # The added ids in the order of the words, behind those known before.
        begins = np.zeros(len(keys), np.int64)
        order = np.concatenate([again, new])
        begins[order] = np.cumsum(size[order]) - size[order]
        added = added[ragged(begins[left], size[left])]
        first[left] = len(self.known.ids) + np.cumsum(size[left]) - size[left]
        self.known = self.known.with_words(keys[left], signs[left], size[left], added)
        return first, size, self.known.ids

    def _spell(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all."""
        # A word with a quote can have several parts and goes alone.
        quoted = np.array(["'" in word for word in words], bool)
        order = np.concatenate([np.flatnonzero(~quoted), np.flatnonzero(quoted)])
        plain = len(words) - int(quoted.sum())
        sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for low in range(0, plain, TOGETHER):
            some = [words[place] for place in order[low : min(low + TOGETHER, plain)]]
            found.append(self._encode(" ".join(some)))
            sizes.append(np.diff(np.flatnonzero(self.closing[found[-1]]), prepend=-1))
        for place in order[plain:]:
            found.append(self._encode(words[place]))
            sizes.append([len(found[-1])])
        size, first = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size[order] = np.concatenate(sizes)
        first[order] = np.cumsum(size[order]) - size[order]
        return size, np.concatenate(found)[ragged(first, size)]

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def _next_is_line_end(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    line = np.zeros(len(points) + 1, bool)
    line[:-1] = points == 10
    return line[ends]
