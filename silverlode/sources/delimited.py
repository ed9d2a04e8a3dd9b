"""Delimited extracts with a header line and columns bound by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.sources.records import LINE, SOURCE_FILE, WHOLE, has_broken_lines, records

REJECT = "_rejected_line"

# A date, alone or as a midnight timestamp.
_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]00:00(:00(\.0+)?)?)?$"

_OPTIONS = {
    # Stands for a field without any text; a quoted empty text then stays an empty text.
    "nullValue": "\u0000", "dateFormat": "yyyy-MM-dd", "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": REJECT,
}
_QUOTED = {"quote": '"', "escape": '"'}


def read_extract(
    spark: SparkSession, path: str, schema: T.StructType, quoted: bool = True,
    mode: str = "PERMISSIVE", job: Job | None = None,
) -> DataFrame:
    """Rows of an extract, with SOURCE_FILE and, in PERMISSIVE mode, REJECT: the line of each row
    that does not fit the schema (NULL on good rows). FAILFAST raises at the first such line.

    Quoted extracts follow RFC 4180: a quote inside a field is doubled, and a quoted field may
    hold line breaks. They are scanned for their quotes first; if every line is a whole record,
    the files are read as they are, and otherwise as `records`, whose lines are staged in `job`.
    Either way a file is read by many tasks. A line with a quote that is not closed, or that neither opens nor ends a field,
    does not fit. In unquoted extracts a quote is plain data. Both kinds of line end are read.

    Texts are kept as they are. Numbers and dates may have spaces around them, a number or date
    field without any text is NULL, quoted or not, and a timestamp at midnight is its date.
    """
    columns = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    options = _OPTIONS | (_QUOTED if quoted else {"quote": ""})
    if not quoted or not has_broken_lines(spark, path):
        read = spark.read.schema(columns).options(**options).options(
            header=True, enforceSchema=True, columnPruning=False
        ).csv(path).withColumns({
            SOURCE_FILE: F.col("_metadata.file_path"), WHOLE: F.lit(True),
            # Only fields that a query reads are parsed, so all stand here; they add NULL.
            REJECT: F.coalesce(REJECT, *(
                F.nullif(F.col(name), F.col(name)).cast("string") for name in schema.fieldNames()
            )),
        })
    else:
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        fields = F.from_csv(F.when(F.col(WHOLE), F.regexp_replace(LINE, r"\r\z", "")), kinds,
                            options | {"multiLine": "true"})
        read = records(job or Job(spark), path).withColumn("fields", fields).select(
            *(F.col("fields")[name].alias(name) for name in schema.fieldNames()),
            F.coalesce(F.col("fields")[REJECT], F.when(~F.col(WHOLE), F.col(LINE))).alias(REJECT),
            SOURCE_FILE, WHOLE,
        )
    rows = _again(read, schema, options)
    if mode.upper() == "PERMISSIVE":
        return rows
    raised = F.raise_error(F.concat(F.lit("Malformed line: "), F.col(REJECT))).cast("string")
    # The check stays in the plan because its column decides which rows come out.
    checked = rows.withColumn(REJECT, F.when(F.col(REJECT).isNotNull(), raised))
    return checked.filter(F.col(REJECT).isNull()).drop(REJECT)


def _again(read: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Lines that the parser refused, taken as texts and cast with more patience."""
    texts = ", ".join(f"`{field.name}` string" for field in schema.fields)
    refused = F.col(REJECT)
    again = F.from_csv(refused, f"{texts}, `_refused` string", options | {
        "multiLine": "true", "columnNameOfCorruptRecord": "_refused",
    })
    typed = {field.name: _typed(F.col("_again")[field.name], field.dataType)
             for field in schema.fields}
    bad = reduce(Column.__or__, (
        typed[field.name].isNull() & (F.trim(F.col("_again")[field.name]) != "")
        for field in schema.fields if not isinstance(field.dataType, T.StringType)
    ), F.col("_again")["_refused"].isNotNull())
    mended = read.withColumn("_again", F.when(refused.isNotNull() & F.col(WHOLE), again))
    good = F.coalesce(F.col("_again").isNotNull() & ~F.coalesce(bad, F.lit(False)), F.lit(False))
    return mended.withColumn("_good", good).select(
        *(F.when(F.col("_good"), column).when(refused.isNull(), F.col(name)).alias(name)
          for name, column in typed.items()),
        SOURCE_FILE, F.when(~F.col("_good"), refused).alias(REJECT),
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    trimmed = F.trim(text)
    if isinstance(kind, T.DateType):
        return F.when(trimmed.rlike(_DATE), F.substring_index(
            F.substring_index(trimmed, " ", 1), "T", 1).try_cast("date"))
    return F.when(trimmed != "", trimmed.try_cast(kind))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows with the columns of their schema, and the rejected lines."""
    good = rows.filter(F.col(REJECT).isNull()).drop(REJECT, SOURCE_FILE)
    return good, rows.filter(F.col(REJECT).isNotNull())
