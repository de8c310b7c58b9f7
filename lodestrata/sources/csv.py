"""Tolerant CSV reading: short rows are filled, long text is cut, stray bytes are replaced, all else must parse."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import load_decimal
from ..functions.text import clean_bytes, decoded_file_name
from .records import records, without_return

# The entry of `text_bytes` that holds for all columns without their own; without one, their text is never cut.
EVERY_COLUMN = "*"
RAW_LINE = "_raw_line"


def read_raw_csv(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str],
    *,
    delimiter: str = ",",
    quote: str = '"',
    multi_line: bool = False,
) -> DataFrame:
    """All columns as byte text (one character per byte), the whole line for rows of another width, and the file.

    The header line is skipped and columns bind by position. Pruning is off because a pruned parser no longer notices
    rows of another width. `multi_line` admits line breaks inside quotes: files are scanned twice then, by as many tasks.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RAW_LINE]])
    options = {
        "sep": delimiter, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE,
        "nullValue": "\\N", "emptyValue": "",
    }
    if multi_line:
        found = records(spark, paths, quote).withColumn("record", without_return(F.col("record")))
        ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
        parsed = found.where("length(trim(record)) > 0").withColumn("row", F.from_csv("record", ddl, options))
        return parsed.select(
            "row.*", decoded_file_name(F.col("name")).alias("source_file"), F.hex(F.xxhash64("path")).alias("source_id")
        )
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=True, columnPruning=False, encoding="ISO-8859-1", **options)
        .csv(list(paths))
        .select(
            "*",
            decoded_file_name(F.col("_metadata.file_name")).alias("source_file"),
            F.hex(F.xxhash64("_metadata.file_path")).alias("source_id"),
        )
    )


def escaped_glob(path: str) -> str:
    """The path with its wildcard characters taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _width(line: Column, delimiter: str, quote: str) -> Column:
    """Number of fields of a raw line: delimiters outside quotes, plus one."""
    q = "\\" + quote
    bare = F.regexp_replace(line, f"{q}[^{q}]*+{q}", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def _columns(
    schema: T.StructType, text_bytes: Mapping[str, int | None], empty_as_null: bool, date_format: str
) -> list[tuple[T.StructField, str, str | None]]:
    """Per column its field, its value (NULL when unreadable) and, unless it is text, what should have been readable.

    Both are SQL expressions: one call into the JVM for each, which counts for a layout of a hundred columns.
    """
    columns = []
    for position, field in enumerate(schema.fields, start=1):
        kind, raw = field.dataType, f"`{field.name}`"
        if isinstance(kind, T.StringType):
            cleaned = clean_bytes(raw, text_bytes.get(field.name, text_bytes.get(EVERY_COLUMN)))
            if empty_as_null:
                value = f"nullif({cleaned}, '')"
            else:
                value = f"coalesce({cleaned}, if(_width >= {position}, '', NULL))"
            columns.append((field, value, None))
            continue
        filled = f"nullif(trim({raw}), '')"
        if isinstance(kind, T.DecimalType):
            value = load_decimal(filled, kind)
        elif isinstance(kind, T.DateType):
            value = f"try_to_date({filled}, '{date_format}')"
        else:
            value = f"try_cast({filled} AS {kind.simpleString()})"
        columns.append((field, value, filled))
    return columns


def _with_width(raw: DataFrame, declared: int, delimiter: str, quote: str) -> DataFrame:
    line = F.col(RAW_LINE)
    quotes = F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))
    return raw.withColumns(
        {
            "_width": F.when(line.isNull(), declared).otherwise(_width(line, delimiter, quote)),
            "_torn": F.coalesce(quotes % 2 == 1, F.lit(False)),
        }
    )


def tolerant_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    *,
    text_bytes: Mapping[str, int | None] | None = None,
    empty_as_null: bool = False,
    date_format: str = "yyyy-MM-dd",
    delimiter: str = ",",
    quote: str = '"',
    multi_line: bool = False,
) -> DataFrame:
    """Typed rows plus the file's name and an id of its full path, in one pass over the files.

    A row of another width with an odd number of quotes is one half of a row with a quoted line break: it stops the job
    too, as only `multi_line` reads such files (and stops at a quote that never closes). Missing trailing fields become NULL. Text is cut to its declared length in
    bytes, if it has one, and each invalid byte becomes "?". A value that cannot be read, or a row with surplus fields, stops the job that consumes the rows and names file and column.
    """
    raw = read_raw_csv(spark, paths, schema.names, delimiter=delimiter, quote=quote, multi_line=multi_line)

    values = []
    for field, value, text in _columns(schema, text_bytes or {}, empty_as_null, date_format):
        if text is not None:
            stop = f"raise_error(concat('unreadable value in {field.name}, file ', source_file))"
            value = f"coalesce({value}, if({text} IS NOT NULL, CAST({stop} AS {field.dataType.simpleString()}), NULL))"
        values.append(f"{value} AS `{field.name}`")
    stop = "CAST(raise_error(concat('extra columns, file ', source_file)) AS STRING)"
    reason = "quote that never closes" if multi_line else "line break inside quotes, needs multi_line"
    torn = f"CAST(raise_error(concat('{reason}, file ', source_file)) AS STRING)"
    source = f"CASE WHEN _torn THEN {torn} WHEN _width > {len(schema)} THEN {stop} ELSE source_file END AS source_file"
    return _with_width(raw, len(schema), delimiter, quote).selectExpr(*values, source, "source_id")


def csv_rejects(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    *,
    date_format: str = "yyyy-MM-dd",
    delimiter: str = ",",
    quote: str = '"',
    multi_line: bool = False,
) -> DataFrame:
    """What `tolerant_csv` would stop at: rejected values per file and column; surplus fields count as a column."""
    raw = read_raw_csv(spark, paths, schema.names, delimiter=delimiter, quote=quote, multi_line=multi_line)
    flags = [F.expr(f"if(_width > {len(schema)}, '(surplus fields)', NULL)")]
    flags += [
        F.expr(f"if({text} IS NOT NULL AND {value} IS NULL, '{field.name}', NULL)")
        for field, value, text in _columns(schema, {}, False, date_format)
        if text is not None
    ]
    wide = _with_width(raw, len(schema), delimiter, quote)
    problems = wide.select("source_file", F.array_compact(F.array(*flags)).alias("problems"))
    return (
        problems.select("source_file", F.explode("problems").alias("column"))
        .groupBy("source_file", "column")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
