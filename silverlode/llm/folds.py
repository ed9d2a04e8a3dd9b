"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves `fold`; a null id is held out."""
    crc = F.crc32(F.col(f"`{doc_id}`").cast("string"))
    return F.coalesce(crc % folds == fold, F.lit(True))


def labelled(
    docs: DataFrame, labels: DataFrame, column: str, folds: int, fold: int, sample: int
) -> DataFrame:
    """Documents (doc_id, ...) outside the held-out fold with their 0 or 1 as `label`.

    At most about `sample` labels are used, those with the least hash of their id, so they travel
    to every task and no text moves. Of rows that repeat an id the greatest label counts.
    """
    known = (
        labels.filter(F.col(column).isin(0, 1) & ~held_out("doc_id", folds, fold))
        .groupBy("doc_id").agg(F.max(column).alias("label"))
    )
    share = sample / max(known.count(), 1)
    if share < 1:
        known = known.filter(hash_of("doc_id") < int(2.0**64 * share - 2.0**63))
    return docs.join(F.broadcast(known), "doc_id")


def hash_of(doc_id: str) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`").cast("string"))
