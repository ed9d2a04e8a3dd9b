"""Quality rules, line first: lines that fail a rule go, then texts that lost too much.

Words are runs without white space (space and the ASCII controls 9 to 13); lines end at a line
feed. A line with at least one word fails

- punctuation: if it has more than one symbol of `SYMBOLS` for five words, or if more than a
  third of its words (three at least) end with an exclamation or question mark;
- navigation: if it has at most three words and does not end in a mark of `CLOSING`, or if a
  quarter of its words, two at least, are separators;
- boilerplate: if it holds one of `PHRASES` in any case, or equals an earlier line of the text.

With `short_line`, a phrase fails a line only if that has at most so many words or phrases make up
`PHRASE_SHARE` of them at least; without it, any line, as the SQL of the registered query says.

A text fails the base rules with fewer than 50 words, or if more than half of its words lie in
three-word windows that the text has twice or more. It is kept if it passes them and its failed
lines hold at most 30 % of its word characters.

Null and empty texts have no words and fail. Equal texts get equal results; every input column
is returned (a result replaces a column of its name).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm import text as tx

MIN_WORDS = 50
MAX_LOST = 0.3
SYMBOLS = "#*$%&|<>"
CLOSING = ".!?:;,\"')]»”’…。！？"
SEPARATORS = ("|", "»", "›", "·", "•", ">", "/")
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "javascript is disabled", "enable javascript", "lorem ipsum",
    "subscribe to our newsletter", "click here to", "back to top", "page not found",
)
SHORT_LINE = 20
PHRASE_SHARE = 0.2

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def clean_lines(
    docs: DataFrame, text: str = "text", short_line: int | None = None
) -> DataFrame:
    """Every row with the counts, base_failed, lost_chars (word characters of failed lines),
    kept, and cleaned (the text without its failed lines; null for null)."""
    fields = [
        *(T.StructField(name, T.LongType()) for name in (*_COUNTS, "lost_chars")),
        T.StructField("cleaned", T.StringType()),
    ]
    judged = tx.map_texts(
        docs.select(tx.whole_row(docs)), fields, lambda texts: _judge(texts, short_line),
        inside=text,
    )
    failed = (F.col("n_words") < MIN_WORDS) | (2 * F.col("n_repeat_words") > F.col("n_words"))
    kept = ~failed & (10 * F.col("lost_chars") <= int(10 * MAX_LOST) * F.col("word_chars"))
    return tx.unfold(judged, docs, {
        **{name: F.col(name) for name in _COUNTS}, "base_failed": failed,
        "lost_chars": F.col("lost_chars"), "kept": kept, "cleaned": F.col("cleaned"),
    })


_SYMBOL = np.zeros(129, bool)
_SYMBOL[[ord(sign) for sign in SYMBOLS]] = True


def _judge(texts, short_line: int | None = None) -> list[pa.Array]:
    count = len(texts)
    points, offsets = tx.code_points(texts)
    words = tx.runs(tx.spaced_mask(points), offsets)
    size = words.ends - words.starts
    symbol = _SYMBOL[np.minimum(points, 128)]

    # Lines begin with their text or after a line feed.
    feeds = np.flatnonzero(points == 10)
    heads = np.sort(np.concatenate((offsets[:-1], feeds + 1)))
    row_of_line = np.repeat(
        np.arange(count), 1 + np.bincount(tx.rows_at(offsets, feeds), minlength=count)
    )
    lines = len(heads)
    tails = np.empty(lines, np.int64)
    tails[:-1] = heads[1:] - (row_of_line[1:] == row_of_line[:-1])  # without its line feed
    if lines:
        tails[-1] = len(points)
    line = np.searchsorted(heads, words.starts, side="right") - 1

    def per_line(weights=None):
        return np.bincount(line, weights=weights, minlength=lines).astype(np.int64)

    has = per_line()
    chars = per_line(size)
    signs = np.bincount(
        np.searchsorted(heads, np.flatnonzero(symbol), side="right") - 1, minlength=lines
    )
    last = points[words.ends - 1]
    loud = per_line((last == 33) | (last == 63))
    alone = points[words.starts]
    separators = per_line((size == 1) & np.isin(alone, [ord(sign) for sign in SEPARATORS]))
    last_word = np.searchsorted(line, np.arange(lines), side="right") - 1
    open_end = np.ones(lines, bool)
    if len(last):
        open_end = ~np.isin(last[np.maximum(last_word, 0)], [ord(sign) for sign in CLOSING])

    line_hash = tx.run_hashes(points, heads, tails)
    worded = np.flatnonzero(has > 0)
    key = tx.mix(line_hash[worded] + row_of_line[worded].astype(np.uint64) * tx._BASE)
    order = np.argsort(key, kind="stable")
    again = np.zeros(lines, bool)
    again[worded[order[1:]]] = key[order[1:]] == key[order[:-1]]

    failed = (
        (5 * signs > has) | ((3 * loud > has) & (has >= 3))
        | ((has <= 3) & open_end) | ((separators >= 2) & (4 * separators >= has)) | again
    )
    for row, text in enumerate(texts):
        lowered = text.lower() if text else ""
        if any(phrase in lowered for phrase in PHRASES):
            first = np.searchsorted(row_of_line, row)
            for place, one in enumerate(lowered.split("\n")):
                held = sum(one.count(phrase) * len(phrase.split()) for phrase in PHRASES)
                failed[first + place] |= held > 0 and (
                    short_line is None or has[first + place] <= short_line
                    or held >= PHRASE_SHARE * has[first + place]
                )
    failed &= has > 0

    def per_text(rows, weights=None):
        return pa.array(
            np.bincount(rows, weights=weights, minlength=count).astype(np.int64), pa.int64()
        )

    return [
        per_text(words.row), per_text(words.row, size),
        per_text(tx.rows_at(offsets, np.flatnonzero(symbol))), per_text(row_of_line, again),
        per_text(words.row, repeated_words(points, words)), per_text(row_of_line, chars * failed),
        pa.array(_without(texts, failed, np.searchsorted(row_of_line, np.arange(count + 1))),
                 pa.string()),
    ]


def repeated_words(points: np.ndarray, words: tx.Runs) -> np.ndarray:
    """Which words lie in a three-word window that their text has at least twice."""
    found = np.zeros(len(words.row), bool)
    windows = np.flatnonzero(words.row[2:] == words.row[:-2])
    if len(windows):
        grams = tx.gram_hashes(tx.run_hashes(points, words.starts, words.ends), 3)[windows]
        own = tx.mix(grams + words.row[windows].astype(np.uint64) * tx._BASE)
        _, which, times = np.unique(own, return_inverse=True, return_counts=True)
        twice = windows[times[which] > 1]
        for place in range(3):
            found[twice + place] = True
    return found


def _without(texts, failed: np.ndarray, first: np.ndarray) -> list[str | None]:
    result = list(texts)
    for row in np.unique(np.searchsorted(first, np.flatnonzero(failed), side="right") - 1):
        gone = failed[first[row] : first[row + 1]]
        result[row] = "\n".join(
            line for line, out in zip(texts[row].split("\n"), gone) if not out
        )
    return result
