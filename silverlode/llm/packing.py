"""Packing documents into sequences of at most 4,096 tokens, in order, by dynamic programming.

The documents of a partition, in its order, are one run of ids, each document ended by an id.
Window cuts are chosen among places: ends of documents (free), ends of sentences or lines (a
small penalty), and, only inside stretches without either, a place every 64 ids (a larger one).
For places p the least cost of ending a window at p is

    cost(p) = penalty(p) + min over q with p - q <= 4096 of cost(q) + 4096 - (p - q)

and since cost(q) + q decides, the minimum over the sliding range is kept in a monotone queue:
one step per place. A partition streams through in blocks of about a million ids; a block is cut
up to the place of least cost in its last 4096 ids, and the rest goes on into the next block, so
only the end of a partition leaves a window unfilled. No shuffle: sequences never cross partitions, and a sequence id holds
the number of its partition. A repeated task makes the same sequences.

Null and empty texts are documents of the end id alone. Documents of any length are cut as
needed. Repeated rows are packed one by one. An empty table gives no piece.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm import text as tx
from silverlode.llm.shipping import in_arrow
from silverlode.llm.word_bpe import word_bpe

LENGTH = 4096
BLOCK = 1_000_000
# Code points encoded at once.
SLICE = 400_000
SENTENCE_PENALTY = 8
INNER_PENALTY = 48
INNER_STEP = 64


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, text: str = "text", doc_id: str = "doc_id",
    length: int = LENGTH, block: int = BLOCK,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. `tokenizer` is a word BPE file that every executor has."""
    kind = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema["doc_id"].dataType
    result = T.StructType([T.StructField("doc_id", kind), *(
        T.StructField(name, T.BinaryType() if name == "ids" else T.LongType())
        for name in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    )])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), length, block)
        bpe = word_bpe(tokenizer)
        ids_kind = None
        for batch in batches:
            ids_kind = batch.schema.field("doc_id").type
            texts, names = batch["text"].to_pylist(), batch["doc_id"].to_pylist()
            for first, end in tx.slices(texts, SLICE):
                encoded = bpe.encode(texts[first:end])
                for row in range(end - first):
                    low, high = encoded.offsets[row : row + 2]
                    marks = np.searchsorted(encoded.sentence_ends, (low, high), side="right")
                    packer.add(
                        names[first + row], np.append(encoded.ids[low:high], np.uint32(end_id)),
                        encoded.sentence_ends[slice(*marks)] - low,
                    )
                    if packer.full():
                        yield _batch(packer.pieces(False), ids_kind)
        if ids_kind is not None:
            yield _batch(packer.pieces(True), ids_kind)

    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return in_arrow(picked, work, result)


def _batch(pieces: list[tuple], ids_kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*pieces)) or [()] * 7
    kinds = [ids_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )


class Packer:
    """Packs the documents of one partition as they come."""

    def __init__(self, partition: int, length: int = LENGTH, block: int = BLOCK) -> None:
        self.length, self.block = length, block
        self.sequence = itertools.count(partition << 40)
        # Waiting documents: id, ids not yet packed, ids packed before, cut places ahead.
        self.waiting: list[tuple] = []
        self.tokens = 0

    def add(self, name, ids: np.ndarray, sentence_ends: np.ndarray) -> None:
        self.waiting.append((name, ids, 0, sentence_ends))
        self.tokens += len(ids)

    def full(self) -> bool:
        return self.tokens >= self.block

    def pieces(self, all_of_it: bool) -> list[tuple]:
        """Pieces of the windows that are settled; the others wait on unless it is the end."""
        sizes = np.array([len(ids) for _, ids, _, _ in self.waiting], np.int64)
        first = np.cumsum(sizes) - sizes
        marks = [
            ends + low for (_, _, _, ends), low in zip(self.waiting, first) if len(ends)
        ]
        cuts = best_cuts(
            np.concatenate([*marks, np.zeros(0, np.int64)]), first + sizes, self.length, all_of_it
        )
        found, row = [], 0
        for low, high in zip(cuts[:-1], cuts[1:]):
            sequence = next(self.sequence)
            place = low
            while place < high:
                while first[row] + sizes[row] <= place:
                    row += 1
                name, ids, before, _ = self.waiting[row]
                begin = place - first[row]
                end = min(high - first[row], sizes[row])
                found.append((
                    name, int(before + begin), int(end - begin),
                    ids[begin:end].astype("<u4", copy=False).tobytes(), int(before + sizes[row]),
                    sequence, int(place - low),
                ))
                place += end - begin
        left, done = [], cuts[-1]
        for (name, ids, before, ends), low in zip(self.waiting, first):
            cut = max(0, done - low)
            if cut < len(ids):
                left.append((name, ids[cut:], before + cut, ends[ends > cut] - cut))
        self.waiting, self.tokens = left, int(sizes.sum() - done)
        return found


def best_cuts(
    sentence_ends: np.ndarray, doc_ends: np.ndarray, length: int = LENGTH, to_end: bool = True
) -> list[int]:
    """Cuts from 0 to the last document's end that cost least, as the module describes; or, not
    to the end, to the cheapest place of the last `length` ids."""
    total = int(doc_ends[-1]) if len(doc_ends) else 0
    if not total:
        return [0]
    step = min(INNER_STEP, length)
    known = np.unique(np.concatenate(([0], sentence_ends, doc_ends)))
    gaps = np.diff(known)
    inner = [
        np.arange(known[k] + step, known[k + 1], step) for k in np.flatnonzero(gaps > step)
    ]
    places = np.unique(np.concatenate([known, *inner]))
    penalties = np.full(len(places), INNER_PENALTY)
    penalties[np.searchsorted(places, sentence_ends)] = SENTENCE_PENALTY
    penalties[np.searchsorted(places, doc_ends)] = 0
    places, penalties = places.tolist(), penalties.tolist()
    came_from = [0] * len(places)
    keyed = [0] * len(places)  # cost(q) + q
    queue = deque([0])
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0]] < place - length:
            queue.popleft()
        came_from[j] = queue[0]
        key = keyed[j] = keyed[queue[0]] + length + penalties[j]
        while queue and keyed[queue[-1]] > key:
            queue.pop()
        queue.append(j)
    j = len(places) - 1
    if not to_end:
        last = range(bisect_left(places, max(total - length, 1)), len(places))
        j = min(last, key=lambda k: (keyed[k] - places[k], -k))
    cuts = [places[j]]
    while j:
        j = came_from[j]
        cuts.append(places[j])
    return cuts[::-1]
