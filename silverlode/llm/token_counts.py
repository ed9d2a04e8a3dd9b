"""Token counts of a sentencepiece BPE model without making ids.

A merge only ever makes a piece of the vocabulary, so no merge can join two neighbouring
characters that no piece holds side by side. Texts are cut at all such places; what lies between
is a pre-token, and a text's count is the sum of its pre-tokens' counts.

Three passes: the distinct pre-tokens of the corpus with their frequencies; the count of each,
once; and per document the frequencies of its pre-tokens, summed against those counts. The most
frequent pre-tokens, at most `COMMON` of them, travel to every task; the rest of a document's
frequencies meet their counts in a join on the pre-token.

Null texts count as empty ones. Repeated rows are counted one by one; a result replaces an input
column of its name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.llm import text as tx
from silverlode.llm.shipping import in_arrow

# Pre-tokens sent to every task (a few MB); which they are changes no result.
COMMON = 1 << 17
# Distinct pre-tokens a task collects before it sends their frequencies on.
COLLECTED = 300_000
_SPACE = 0x2581  # the model's sign for a space
_models: dict[str, Model] = {}


def token_counts(
    spark: SparkSession, docs: DataFrame, model: str, limit: int = 4096, text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """Every row with n_bytes, n_tokens and over_limit. `model` is a sentencepiece BPE file that
    every executor has."""
    job = Job(spark)
    row = docs if keep_text else docs.drop(text)
    counts = job.stage(_count_distinct(docs, text, model), "pretokens")
    common = _common(counts)
    found = job.stage(
        tx.map_texts(
            docs.select(
                tx.whole_row(row), F.monotonically_increasing_id().alias("_id"),
                F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
                .alias("n_bytes"),
                F.col(f"`{text}`").alias("_text"),
            ),
            [T.StructField("counted", T.LongType()), T.StructField("rest", _FREQUENCIES)],
            lambda texts: load(model).frequencies(texts, common),
        ),
        "frequencies",
    )
    rest = (
        found.select("_id", F.explode("rest").alias("pretoken", "times"))
        .join(counts.select("pretoken", "tokens"), "pretoken").groupBy("_id")
        .agg(F.sum(F.col("times") * F.col("tokens")).alias("more"))
    )
    total = F.col("counted") + F.coalesce("more", F.lit(0))
    return tx.unfold(found.drop("rest").join(rest, "_id", "left"), row, {
        "n_bytes": F.col("n_bytes"), "n_tokens": total, "over_limit": total > limit,
    })


_FREQUENCIES = T.MapType(T.StringType(), T.LongType())


def _count_distinct(docs: DataFrame, text: str, model: str) -> DataFrame:
    """(pretoken, times, tokens), one row per distinct pre-token of all texts."""
    seen = T.StructType([T.StructField("pretoken", T.StringType()),
                         T.StructField("times", T.LongType())])
    counted = T.StructType([*seen.fields, T.StructField("tokens", T.LongType())])

    def send(collected: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(collected), pa.string()), pa.array(list(collected.values()), pa.int64())],
            names=seen.names,
        )

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collected: Counter = Counter()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, end in tx.slices(texts):
                names, which, _ = load(model).pretokens(texts[first:end])
                times = np.bincount(which, minlength=len(names)).tolist()
                for name, many in zip(names, times):
                    collected[name] += many
                if len(collected) > COLLECTED:
                    yield send(collected)
                    collected.clear()
        if collected:
            yield send(collected)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array(load(model).count(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], names=counted.names)

    distinct = (
        in_arrow(docs.select(F.col(f"`{text}`").alias("_text")), collect, seen)
        .groupBy("pretoken").agg(F.sum("times").alias("times"))
    )
    return in_arrow(distinct, count, counted)


def _common(counts: DataFrame) -> dict[str, int]:
    """Counts of the most frequent pre-tokens, by whole powers of two of their frequency."""
    by_power = {
        row.power: row.n for row in counts
        .groupBy(F.floor(F.log2("times")).alias("power")).agg(F.count("*").alias("n")).collect()
    }
    taken, least = 0, 64
    for power in sorted(by_power, reverse=True):
        taken += by_power[power]
        if taken > COMMON:
            break
        least = power
    chosen = counts.filter(F.floor(F.log2("times")) >= least).select("pretoken", "tokens")
    return {row.pretoken: row.tokens for row in chosen.toLocalIterator()}


def load(path: str) -> Model:
    """The model of a file, loaded once per worker process."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


class Model:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pairs = set()
        for number in range(self.library.get_piece_size()):
            if not (self.library.is_byte(number) or self.library.is_control(number)
                    or self.library.is_unknown(number)):
                piece = self.library.id_to_piece(number)
                pairs.update(zip(piece, piece[1:]))
        signs = sorted({sign for pair in pairs for sign in pair})
        # Signs of no pair share number 0, which joins nothing.
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(sign) for sign in signs]] = np.arange(1, len(signs) + 1)
        self.joins = np.zeros((len(signs) + 1, len(signs) + 1), bool)
        for left, right in pairs:
            self.joins[self.number[ord(left)], self.number[ord(right)]] = True

    def pretokens(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pre-tokens, which of them each one is in order, and where each text
        begins. A text that is not empty begins with a space, as the library has it."""
        points, offsets = tx.code_points([" " + text if text else None for text in texts])
        points = np.where(points == 32, np.uint32(_SPACE), points)
        numbers = self.number[points].astype(np.int64)
        apart = ~self.joins.ravel()[numbers[:-1] * len(self.joins) + numbers[1:]]
        pieces = tx.runs(np.ones(len(points), bool), offsets, np.flatnonzero(apart) + 1)
        names, which = tx.distinct_runs(points, pieces.starts, pieces.ends)
        return names, which, tx.segments(pieces.row, len(texts))

    def count(self, pretokens: list[str]) -> list[int]:
        """Tokens of each: encoded behind a line break, which joins nothing, and without the
        two tokens of the leading space and that break."""
        lead = len(self.library.encode("\n"))
        return [len(ids) - lead for ids in self.library.encode(["\n" + p for p in pretokens])]

    def frequencies(self, texts: list[str | None], common: dict[str, int]) -> list[pa.Array]:
        """Per text the tokens of common pre-tokens, and the frequencies of the others."""
        names, which, first = self.pretokens(texts)
        tokens = np.array([common.get(name, -1) for name in names], np.int64)
        each = tokens[which] if len(names) else np.zeros(0, np.int64)
        known = each >= 0
        sums = np.concatenate(([0], np.cumsum(np.where(known, each, 0))))
        row = tx.rows_at(first, np.flatnonzero(~known))
        pairs, times = np.unique(
            row * max(len(names), 1) + which[~known], return_counts=True
        )
        row, name = np.divmod(pairs, max(len(names), 1))
        rest = pa.MapArray.from_arrays(
            pa.array(tx.segments(row, len(texts)), pa.int32()),
            pa.array([names[place] for place in name], pa.string()), pa.array(times, pa.int64()),
        )
        return [pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64()), rest]
