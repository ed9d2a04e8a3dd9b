"""Records of a quoted extract whose fields may hold line breaks, read by many tasks per file.

A line alone does not tell whether it begins inside a quoted field. But each line acts on that
state in one of a few ways, which compose, so the state before every line is a prefix scan:

1. Every task sums up its byte range of a file: lines with an odd number of quotes either open a
   field, close one, or can do either (and then switch the state), whatever the state before.
2. The sums of a file's ranges are scanned, one row per range, which gives the state at the
   beginning of each range.
3. Ranges without such a line have one state throughout, so their lines stay where they are. In
   the others a running sum inside the range gives the state before each line.
4. Lines of one record share a number, and only records of several lines are put together.

A quote that opens a field stands at its start and one that closes it stands at its end; quotes
in between are doubled. Where lines that should form a record break that rule, or no line closes
it, its lines count as records of their own: a quote left open spoils its own line, not the lines
that follow, and a record is never put together across the whole lines after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.job import Job

SOURCE_FILE = "_source_file"
LINE, WHOLE = "line", "whole"

# A field, and the rest of a quoted one; matched without backtracking.
_REST = '[^"]*+(?:""[^"]*+)*+'
_FIELD = f'(?:"{_REST}"|[^",]*+)'
_WHOLE = f"^{_FIELD}(?:,{_FIELD})*+\\r?\\z"
_OPENS = f'^(?:{_FIELD},)*+"{_REST}\\z'
_CLOSES = f'^{_REST}"(?:,{_FIELD})*+\\r?\\z'
_GOES_ON = f'^{_REST}\\z|^{_REST}"(?:,{_FIELD}(?=,))*+,"{_REST}\\z'


def _odd(line: Column) -> Column:
    return F.length(F.regexp_replace(line, '[^"]', "")) % 2 == 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", LINE)


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a line of the extract is no whole record, as its quotes tell."""
    text = F.col(LINE)
    broken = text.contains('"') & (_odd(text) | ~text.rlike(_WHOLE))
    return bool(_lines(spark, path).agg(F.bool_or(broken)).first()[0])


def records(job: Job, path: str) -> DataFrame:
    """(SOURCE_FILE, line, whole) of every record of the extract's files but their headers: the
    text, and whether its quotes are as they should be."""
    # Staged, so that a line's range and its place in it stay the same in every later scan.
    lines = job.stage(_lines(job.spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), LINE,
    ), "lines")
    ranges = lines.groupBy("file", "range").agg(F.min("at").alias("first"))
    first = ranges.filter("range = 0").select("file", F.col("first").alias("header"))
    lines = lines.join(F.broadcast(first), "file").filter(
        (F.col("range") != 0) | (F.col("at") != F.col("header"))
    ).drop("header")
    text, odd = F.col(LINE), _odd(F.col(LINE))
    opens, closes = odd & text.rlike(_OPENS), odd & text.rlike(_CLOSES)
    acting = lines.withColumns({"opens": opens, "closes": closes})
    placed = _states(acting, ranges)

    inside = F.col("inside") == 1
    opener = F.col("opens") & (~F.col("closes") | ~inside)
    member = inside & ~(F.col("opens") & ~F.col("closes"))
    number = F.when(opener, F.col("opened") + 1).when(member, F.col("opened"))
    ends = member & F.col("closes")
    fits = opener | ends | text.rlike(_GOES_ON)
    parts = placed.select("file", "range", "at", LINE, number.alias("number"), ends.alias("ends"),
                          fits.alias("fits"))
    spans = parts.filter("number is not null").groupBy("file", "number").agg(
        (F.min("fits") & F.max("ends")).alias("joined")
    )
    parts = parts.join(spans, ["file", "number"], "left")
    alone = parts.filter("not coalesce(joined, false)").filter(F.trim(LINE) != "").select(
        F.col("file").alias(SOURCE_FILE), LINE,
        (~text.contains('"') | text.rlike(_WHOLE)).alias(WHOLE),
    )
    together = parts.filter("joined").groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("range", "at", LINE))).alias("lines")
    ).select(
        F.col("file").alias(SOURCE_FILE),
        F.array_join(F.col(f"lines.{LINE}"), "\n").alias(LINE), F.lit(True).alias(WHOLE),
    )
    return alone.unionByName(together)


def _states(acting: DataFrame, ranges: DataFrame) -> DataFrame:
    """The lines with `inside` (1 if they begin inside a quoted field) and `opened` (lines of
    their file before them that could open one)."""
    events = acting.filter("opens or closes").drop(LINE)
    before = Window.partitionBy("file", "range").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    both = (F.col("opens") & F.col("closes")).cast("int")
    # What a line that can only open or only close does: the state after it, and the switches
    # of its range before it.
    sets = F.col("opens") != F.col("closes")
    switched = F.coalesce(F.sum(both).over(before), F.lit(0))
    sums = events.select(
        "file", "range", both.alias("both"), F.col("opens").cast("int").alias("opens"),
        F.when(sets, F.struct("at", F.col("opens").cast("int").alias("state"),
                              switched.alias("switched"))).alias("set"),
    ).groupBy("file", "range").agg(
        F.sum("both").alias("switches"), F.sum("opens").alias("opens"), F.max("set").alias("set")
    )
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    summed = ranges.join(sums, ["file", "range"], "left").select(
        "file", "range", "set", F.col("switches").isNotNull().alias("acts"),
        F.coalesce(F.sum("switches").over(earlier), F.lit(0)).alias("switched"),
        F.coalesce(F.sum("opens").over(earlier), F.lit(0)).alias("opened_before"),
    ).withColumn("last", F.last(F.when(F.col("set").isNotNull(), F.struct(
        F.col("set.state").alias("state"),
        (F.col("switched") + F.col("set.switched")).alias("switched"),
    )), ignorenulls=True).over(earlier))
    starts = summed.select(
        "file", "range", "acts", "opened_before", _state(F.col("last"), F.col("switched"), F.lit(0))
        .alias("start"),
    )
    begun = acting.join(starts, ["file", "range"])
    quiet = begun.filter("not acts").select(
        "file", "range", "at", LINE, "opens", "closes", F.col("start").alias("inside"),
        F.col("opened_before").alias("opened"),
    )
    last = F.last(F.when(sets, F.struct(
        F.col("opens").cast("int").alias("state"), F.col("_switched").alias("switched")
    )), ignorenulls=True).over(before)
    busy = begun.filter("acts").withColumn("_switched", switched).select(
        "file", "range", "at", LINE, "opens", "closes",
        _state(last, F.col("_switched"), F.col("start")).alias("inside"),
        (F.col("opened_before") + F.coalesce(F.sum(F.col("opens").cast("int")).over(before),
                                             F.lit(0))).alias("opened"),
    )
    return quiet.unionByName(busy)


def _state(last: Column, switched: Column, start: Column) -> Column:
    """The state after the last line that set it, or from the start, with all switches since."""
    since_last = last["state"] + switched - last["switched"]
    return F.coalesce(since_last, start + switched) % 2
