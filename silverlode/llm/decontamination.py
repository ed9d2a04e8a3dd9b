"""Benchmark decontamination by winnowing.

Words are runs of digits, ASCII letters (lower-cased) and code points beyond ASCII. A window is
ten consecutive words of an item; an item of fewer words, but not none, is one window. Of the
six 5-grams in ten words the one with the least hash (the last of equals) is the fingerprint, so
two texts that share ten words share a fingerprint there: none can be missed. Document
fingerprints that no benchmark has are dropped by a bitmap of fixed size, the others are joined,
and each hit is extended to its whole windows, compared as text. Windows of short items are
looked up whole, at each of the (at most nine) lengths that the benchmark has.

Null and empty texts have no words and are clean. An item without words has no window; one
without an id contaminates but is not listed. Repeated rows are judged one by one, and every
input column is returned, whatever its name (a result replaces a column of its name).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.llm import text as tx
from silverlode.llm.filters import bitmap, probe

WINDOW = 10
GRAM = 5
# A join side is broadcast up to this many windows (of 10 words, so tens of MB); beyond it the
# join shuffles, with the windows of each text dealt over SALTS partitions.
BROADCAST_WINDOWS = 200_000
SALTS = 16
# Contaminated documents plus their items that may travel to every task (tens of bytes each).
BROADCAST_ITEMS = 500_000

_HITS = T.ArrayType(T.StructType([
    T.StructField("fingerprint", T.LongType()), T.StructField("first", T.LongType()),
    T.StructField("windows", T.IntegerType()), T.StructField("size", T.IntegerType()),
    T.StructField("words", T.StringType()),
]))


def contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text",
    item_id: str = "item_id", keep_text: bool = True,
) -> DataFrame:
    """Every row of `docs` with n_words, n_hit (words inside any occurrence of a window),
    n_items (items with occurring windows), items_sha256 and contaminated."""
    job = Job(spark)
    windows = job.stage(_benchmark_windows(benchmark, item_id), "benchmark_windows")
    distinct = windows.select("fingerprint", "words", "size").distinct()
    lengths = [row.size for row in windows.select("size").distinct().collect()]
    known = bitmap(windows, F.col("fingerprint"))
    row = docs if keep_text else docs.drop(text)
    found = job.stage(
        tx.map_texts(
            docs.select(tx.whole_row(row), F.monotonically_increasing_id().alias("_id"),
                        *tx.beside(text, keep_text)),
            [T.StructField("n_words", T.LongType()), T.StructField("hits", _HITS)],
            lambda texts: _scan(texts, known, lengths), inside=text if keep_text else None,
        ),
        "document_hits",
    )
    matched = job.stage(_extend(found, windows, distinct), "matched_windows")
    spans = matched.groupBy("_id").agg(
        F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans")
    )
    items = (
        _by_window(matched, windows.filter("item_id is not null"))
        .select("_id", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("_id").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    # Sorted spans overlap only forwards: count what lies beyond the end reached so far.
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda reached, span: F.struct(
            F.greatest(reached.end, span.start + span.size).alias("end"),
            (reached.hit + F.greatest(
                F.lit(0), span.start + span.size - F.greatest(reached.end, span.start)
            )).alias("hit"),
        ),
        lambda reached: reached.hit,
    )
    judged = job.stage(
        spans.join(items, "_id", "left").select("_id", covered.alias("hit"), "items"), "judged"
    )
    # A large number of contaminated documents, or of items in them, meets the rest by shuffle.
    size = judged.agg(F.count("*"), F.sum(F.size(F.coalesce("items", F.array())))).first()
    if size[0] + (size[1] or 0) <= BROADCAST_ITEMS:
        judged = F.broadcast(judged)
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return tx.unfold(found.drop("hits").join(judged, "_id", "left"), row, {
        "n_words": F.col("n_words"),
        "n_hit": F.coalesce("hit", F.lit(0).cast("long")),
        "n_items": F.size(listed).cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", listed), 256),
        "contaminated": F.coalesce(F.col("hit") > 0, F.lit(False)),
    })


def _benchmark_windows(benchmark: DataFrame, item_id: str) -> DataFrame:
    """One row per window of an item: item_id, fingerprint, size in words, its words."""
    scanned = tx.map_texts(
        benchmark.select(F.col(f"`{item_id}`").alias("item_id"),
                         F.coalesce("text", F.lit("")).alias("_text")),
        [T.StructField("n_words", T.LongType()), T.StructField("hits", _HITS)],
        lambda texts: _scan(texts, None, range(1, WINDOW)),
    )
    return _windows(scanned, "item_id").select("item_id", "fingerprint", "size", "words").distinct()


def _scan(texts, known: bytes | None, lengths) -> list[pa.Array]:
    """Word counts, and per text the fingerprints that may be known with the words of all
    windows they stand for. Without a bitmap, the windows of the texts as benchmark items."""
    points, offsets = tx.code_points(texts)
    points = tx.ascii_lower(points)
    words = tx.runs(tx.word_mask(points), offsets)
    hashes = tx.run_hashes(points, words.starts, words.ends)
    first_word = tx.segments(words.row, len(texts))
    counts = np.diff(first_word)
    left = first_word[words.row + 1] - np.arange(len(hashes))  # words to the text's end
    table = None if known is None else np.frombuffer(known, np.uint8)
    found = []  # fingerprint, first word, windows, size
    if len(hashes) >= WINDOW:
        grams = tx.gram_hashes(hashes, GRAM)
        span = WINDOW - GRAM + 1
        sliding = np.lib.stride_tricks.sliding_window_view(grams, span)
        best = np.full(len(sliding), span - 1, np.int64)
        least = sliding[:, -1].copy()
        for place in range(span - 2, -1, -1):
            less = sliding[:, place] < least
            best[less], least[less] = place, sliding[less, place]
        place = np.arange(len(sliding)) + best
        whole = left[: len(sliding)] >= WINDOW
        head = np.flatnonzero(whole & np.concatenate(
            ([True], (place[1:] != place[:-1]) | ~whole[:-1])
        ))
        # Windows of one fingerprint follow each other; the run ends with the next head or text.
        stop = np.concatenate((head[1:], [len(sliding)]))
        text_end = first_word[words.row[head] + 1] - WINDOW + 1
        many = np.minimum(stop, text_end) - head
        if table is not None:
            hit = probe(table, least[head])
            head, many = head[hit], many[hit]
        found.append((least[head], head, many, np.full(len(head), WINDOW)))
    for size in (size for size in lengths if size < WINDOW):
        grams = tx.gram_hashes(hashes, size)
        head = np.flatnonzero(left[: len(grams)] >= size)
        if table is None:
            head = head[counts[words.row[head]] == size]
        else:
            head = head[probe(table, grams[head])]
        found.append((grams[head], head, np.ones(len(head), np.int64), np.full(len(head), size)))
    hits: list[list] = [[] for _ in texts]
    if found:
        lowered = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        for fingerprint, head, many, size in zip(*(np.concatenate(part) for part in zip(*found))):
            row = words.row[head]
            taken = range(head, head + many + size - 1)
            hits[row].append({
                "fingerprint": int(fingerprint.astype(np.int64)),
                "first": int(head - first_word[row]), "windows": int(many), "size": int(size),
                "words": " ".join(lowered[words.starts[k] : words.ends[k]] for k in taken),
            })
    kind = pa.list_(pa.struct([
        ("fingerprint", pa.int64()), ("first", pa.int64()), ("windows", pa.int32()),
        ("size", pa.int32()), ("words", pa.string()),
    ]))
    return [pa.array(counts, pa.int64()), pa.array(hits, kind)]


def _windows(scanned: DataFrame, key: str) -> DataFrame:
    """One row per window: key, fingerprint, start, size, its words joined by spaces."""
    hit = scanned.select(key, F.explode("hits").alias("hit")).select(key, "hit.*")
    return _split(hit, key)


def _split(hit: DataFrame, key: str) -> DataFrame:
    return (
        hit.withColumn("list", F.split("words", " "))
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)))
        .select(key, "fingerprint", (F.col("first") + F.col("place")).alias("start"), "size",
                F.concat_ws(" ", F.slice("list", F.col("place") + 1, F.col("size"))).alias("words"))
    )


def _extend(found: DataFrame, windows: DataFrame, distinct: DataFrame) -> DataFrame:
    """Occurring windows: fingerprints met in the benchmark, extended to equal words."""
    hit = found.select("_id", F.explode("hits").alias("hit")).select("_id", "hit.*")
    prints = distinct.select("fingerprint").distinct()
    if windows.count() <= BROADCAST_WINDOWS:
        met = _split(hit.join(F.broadcast(prints), "fingerprint", "left_semi"), "_id")
        return met.join(F.broadcast(distinct), ["fingerprint", "words", "size"], "left_semi")
    met = _split(hit.join(prints, "fingerprint", "left_semi"), "_id")
    return _salted(met).join(
        _spread(distinct), ["salt", "fingerprint", "words", "size"], "left_semi"
    ).drop("salt")


def _by_window(matched: DataFrame, windows: DataFrame) -> DataFrame:
    """Matched windows with the items that have them."""
    keys = ["fingerprint", "words", "size"]
    if windows.count() <= BROADCAST_WINDOWS:
        return matched.join(F.broadcast(windows), keys)
    return _salted(matched).join(_spread(windows), ["salt", *keys]).drop("salt")


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))


def _spread(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
