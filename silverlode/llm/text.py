"""Words of many texts at once, as numpy arrays over their code points.

The operators that work on words in Python tasks share this: a slice of a batch becomes one
array of code points, words are runs of a character class in it, and a word's hash comes from
prefix sums, so no step loops over single words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.shipping import in_arrow

# Code points handled at once; a single longer text is still handled whole.
SLICE = 500_000
# Rows whose texts are taken out of a batch at once.
TOGETHER = 1000

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Runs(NamedTuple):
    """Runs of a character class: first and past-last code point, and the row of the text."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(
    texts: Sequence, limit: int = SLICE, length: Callable = lambda text: len(text or "")
) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` code points each, at least one row each."""
    first = size = 0
    for row, text in enumerate(texts):
        size += length(text)
        if size >= limit:
            yield first, row + 1
            first, size = row + 1, 0
    if first < len(texts):
        yield first, len(texts)


def code_points(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after another, and where each text begins (one more at the end)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text or "") for text in texts], out=offsets[1:])
    joined = "".join(text or "" for text in texts)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), offsets


def ascii_lower(points: np.ndarray) -> np.ndarray:
    upper = (points >= 65) & (points <= 90)
    return points + (upper.astype(np.uint32) << np.uint32(5))


def word_mask(points: np.ndarray) -> np.ndarray:
    """Digits, ASCII letters and everything beyond ASCII, as one lookup."""
    return _WORD[np.minimum(points, 128)]


def spaced_mask(points: np.ndarray) -> np.ndarray:
    """Everything but space and the ASCII controls 9 to 13."""
    return (points != 32) & ((points < 9) | (points > 13))


_WORD = np.zeros(129, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128] = True


def rows_at(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, side="right") - 1


def runs(mask: np.ndarray, offsets: np.ndarray, also: np.ndarray | None = None) -> Runs:
    """Maximal runs of the mask; none crosses the end of a text or a place in `also`."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[offsets] = True
    if also is not None:
        edge[also] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return Runs(starts, np.flatnonzero(last) + 1, rows_at(offsets, starts))


def run_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's code points, alike wherever the run lies."""
    power, inverse = _power_tables(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for place, base in enumerate((_BASE, _INVERSE)):
            table = np.full(max(size, SLICE + 1), base, np.uint64)
            table[0] = 1
            _powers[place] = np.cumprod(table)
    return _powers[0], _powers[1]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes (texts' ends are the caller's)."""
    count = max(len(words) - n + 1, 0)
    grams = np.zeros(count, np.uint64)
    for place in range(n):
        grams = grams * _BASE + words[place : place + count]
    return mix(grams + np.uint64(n))


def segments(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin in an array sorted by row (one more at the end)."""
    return np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))


def map_texts(
    df: DataFrame, fields: Sequence[T.StructField], compute: Callable[[list], list[pa.Array]],
    text: str = "_text", limit: int = SLICE, length: Callable = lambda text: len(text or ""),
    inside: str | None = None,
) -> DataFrame:
    """`df` without its text column, with the fields that `compute` gives for each text. `inside`
    names the column of `_row` that is the text instead, so that it travels once."""
    rest = [field for field in df.schema.fields if field.name != text]
    names = [field.name for field in rest]
    result = T.StructType([*rest, *fields])
    nested = None if inside is None else _place(df.schema["_row"].dataType.names, inside)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in row_groups(whole)):
            if nested is None:
                column = batch.column(batch.schema.get_field_index(text))
            else:
                column = batch.column(batch.schema.get_field_index("_row")).field(nested)
            texts = column.to_pylist()
            for first, end in slices(texts, limit, length):
                kept = [
                    batch.column(batch.schema.get_field_index(name)).slice(first, end - first)
                    for name in names
                ]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *compute(texts[first:end])], names=[*names, *(f.name for f in fields)]
                )

    return in_arrow(df, work, result)


def _place(names: list[str], name: str) -> int:
    """Where a column is, as Spark finds it: by its name, else without regard to case."""
    return names.index(name) if name in names else [n.lower() for n in names].index(name.lower())


def row_groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of a few rows, so that only their texts are Python strings at a time."""
    return (batch.slice(first, TOGETHER) for first in range(0, batch.num_rows, TOGETHER))


def whole_row(df: DataFrame, drop: Sequence[str] = ()) -> Column:
    """All columns as one struct, so that no name of theirs can clash with a working column."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns if name not in drop)).alias("_row")


def beside(text: str, keep_text: bool) -> list[Column]:
    """The text as a column beside `_row`, where that does not hold it."""
    return [] if keep_text else [F.col(f"`{text}`").alias("_text")]


def unfold(df: DataFrame, row: DataFrame, results: dict[str, Column]) -> DataFrame:
    """The columns of `row` from `_row`, then the results; a result replaces an input column
    of its name."""
    kept = [
        F.col("_row").getField(name).alias(name) for name in row.columns if name not in results
    ]
    return df.select(*kept, *(column.alias(name) for name, column in results.items()))


def distinct_runs(
    points: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[list[str], np.ndarray]:
    """The distinct runs as strings, and for each run which of them it is."""
    _, first, which = np.unique(
        run_hashes(points, starts, ends), return_index=True, return_inverse=True
    )
    return strings(points, starts[first], ends[first]), which


def strings(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    joined = points.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[start:end] for start, end in zip(starts.tolist(), ends.tolist())]
