"""Site-relative line dedup, with DataFrame functions only.

A line (between line feeds) that is on more than `ratio` of the pages of its host, and on at
least `min_pages` of them, is boilerplate there and is dropped from all pages of that host. How
often a page repeats a line does not matter. Lines of white space alone are never dropped.

Counting: each page gives its distinct lines as 128-bit hashes, and hosts' lines are counted with
partial sums before the shuffle, so neither a host with a third of all pages nor a line on all of
them sends more than one row per task. The boilerplate of a host is at most (mean distinct lines
per page) / ratio lines whatever the number of its pages, so it fits a row. These rows are
measured: small enough, they travel to every task; otherwise pages meet them in a join on host
and a salt, so a large host is spread over `SALTS` partitions.

Null hosts form one host. A null text has no lines and stays null; an empty one is one blank
line. Repeated rows are pages of their own. A result replaces an input column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.llm import text as tx

RATIO = 0.1
MIN_PAGES = 5
BROADCAST_LINES = 1_000_000  # 16 bytes each
SALTS = 16


def drop_boilerplate(
    spark: SparkSession, pages: DataFrame, host: str = "source", text: str = "text",
    ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False,
) -> DataFrame:
    """Every row with its text without boilerplate, n_lines before and n_dropped.

    With `copies_once`, pages of a host with the same text count as one page, so that the lines
    of a page with many copies are no boilerplate for that; they are still looked for in all.
    """
    job = Job(spark)
    page = pages.select(F.col(f"`{host}`").alias("_host"), F.col(f"`{text}`").alias("_text"))
    if copies_once:
        page = _once(job, page)
    plates = job.stage(_boilerplate(page, ratio, min_pages), "boilerplate")
    lines = plates.agg(F.sum(F.size("plates"))).first()[0] or 0
    rows = pages.select(tx.whole_row(pages))
    if lines <= BROADCAST_LINES:
        met = rows.join(F.broadcast(plates), F.col("_row")[host].eqNullSafe(F.col("_host")), "left")
    else:
        salt = F.pmod(F.xxhash64(F.col("_row")[text]), F.lit(SALTS)).cast("int")
        spread = plates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.join(
            spread, F.col("_row")[host].eqNullSafe(F.col("_host")) & (salt == F.col("_salt")),
            "left",
        )
    before = F.split(F.col("_row")[text], "\n", -1)
    after = F.filter(before, lambda line: ~_is_plate(line))
    n_lines = F.greatest(F.size(before), F.lit(0))
    # Pages without a dropped line keep their text as it is.
    cleaned = met.withColumn("_after", F.when(F.col("plates").isNotNull(), after).otherwise(before))
    return tx.unfold(cleaned, pages, {
        text: F.array_join("_after", "\n"), "n_lines": n_lines.cast("long"),
        "n_dropped": (n_lines - F.greatest(F.size("_after"), F.lit(0))).cast("long"),
    })


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(1), line).alias("h1"), F.xxhash64(F.lit(2), line).alias("h2"))


def _slot(h1: Column, slots: Column) -> Column:
    return F.pmod(h1, slots.cast("bigint")).cast("int")


def _is_plate(line: Column) -> Column:
    """One slot of the host's plates is looked through, whatever their number."""
    key = _key(line)
    slot = _slot(key["h1"], F.size("plates"))
    return F.array_contains(F.get("plates", slot), key)


def _once(job: Job, page: DataFrame) -> DataFrame:
    """One page of each text of a host. Only the texts of pages with copies move, one of a text
    from each task; the hashes of such texts travel to every task if they are few."""
    key = _key(F.col("_text"))
    keyed = page.select("_host", "_text", key["h1"].alias("h1"), key["h2"].alias("h2"))
    copied = job.stage(
        keyed.groupBy("_host", "h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select(
            F.col("_host").alias("_of"), F.col("h1").alias("k1"), F.col("h2").alias("k2")
        ), "copied",
    )
    if copied.count() <= BROADCAST_LINES:
        copied = F.broadcast(copied)
    same = (F.col("_host").eqNullSafe(F.col("_of")) & (F.col("h1") == F.col("k1"))
            & (F.col("h2") == F.col("k2")))
    first = keyed.join(copied, same, "left_semi").groupBy("_host", "h1", "h2").agg(
        F.first("_text").alias("_text")
    )
    own = keyed.join(copied, same, "left_anti")
    return own.select("_host", "_text").unionByName(first.select("_host", "_text"))


def _boilerplate(page: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(_host, plates) for each host with lines to drop: their keys, dealt by hash to as many slots
    as there are keys. A slot holds one key on average, and can be empty."""
    totals = page.groupBy("_host").agg(F.count("*").alias("pages"))
    line = page.select(
        "_host", F.explode(F.array_distinct(F.split("_text", "\n", -1))).alias("line")
    ).filter(F.col("line").rlike("[^\\x20\\x09-\\x0D]"))
    counts = (
        line.select("_host", _key(F.col("line")).alias("key"))
        .groupBy("_host", F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2"))
        .agg(F.count("*").alias("times")).filter(F.col("times") >= min_pages)
    )
    total = totals.select(F.col("_host").alias("_of"), "pages")
    keys = (
        counts.join(total, F.col("_host").eqNullSafe(F.col("_of")))
        .filter(F.col("times") > F.col("pages") * ratio)
        .groupBy("_host").agg(F.collect_list(F.struct("h1", "h2")).alias("keys"))
    )
    slots = F.size("keys")
    nothing = F.lit(None).cast("struct<h1:bigint,h2:bigint>")
    dealt = F.concat(
        F.transform("keys", lambda key: F.struct(
            _slot(key["h1"], slots).alias("slot"), key.alias("key")
        )),
        F.transform(F.sequence(F.lit(0), slots - 1), lambda slot: F.struct(
            slot.alias("slot"), nothing.alias("key")
        )),
    )
    # collect_list leaves the NULLs out, so a slot without keys is an empty array.
    return (
        keys.select("_host", F.inline(dealt))
        .groupBy("_host", "slot").agg(F.collect_list("key").alias("keys"))
        .groupBy("_host").agg(F.sort_array(F.collect_list(F.struct("slot", "keys"))).alias("found"))
        .select("_host", F.col("found.keys").alias("plates"))
    )
