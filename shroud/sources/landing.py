"""Landing files as DataFrames of strings: CSV, NDJSON, their choice, and lines that can't be read."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators.protect import missing_columns

# Text of a CSV cell that stands for a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
PREFIX, SUFFIXES = "inbound/", (".csv", ".json")
CORRUPT = "_corrupt_record"
#: Column for a cell beyond those of the header.
BEYOND = "_beyond_header"


def string_schema(fields: list[str]) -> str:
    return ", ".join(f"`{f}` string" for f in fields)


def present(value: Column, missing: tuple[str, ...] = MISSING) -> Column:
    """The cell, or null if its text stands for a missing value."""
    return F.when(~value.isin(*missing), value)


def csv_cells(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, broken_lines: bool = True) -> DataFrame:
    """Cells of CSV files with a header as text, and BEYOND: not null in a row with more cells than the header, whose rest can't be told apart.

    A quoted cell may hold line breaks, for which a file is read in one piece; without ``broken_lines`` files are split by lines.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", broken_lines)
    names = columns or reader.option("inferSchema", False).csv(paths).columns
    return reader.schema(string_schema([*names, BEYOND])).csv(paths)


def read_csv(spark: SparkSession, path: str, fields: list[str] | None = None, missing: tuple[str, ...] = MISSING) -> DataFrame:
    """A CSV file with a header, every column a string: plus signs and leading zeros stay. Without ``fields`` the header names the columns. Rows with more cells than the header are left out (see ``bad_lines``)."""
    rows = csv_cells(spark, path, fields, _quoted_breaks(spark, path)).where(F.col(BEYOND).isNull()).drop(BEYOND)
    return rows.select(*[present(F.col(f"`{c}`"), missing).alias(c) for c in rows.columns])


def _odd_quotes(line: Column) -> Column:
    """Whether a line ends within a quoted cell, or begins in one."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def _quoted_breaks(spark: SparkSession, path: str) -> bool:
    return not spark.read.text(path).where(_odd_quotes(F.col("value"))).isEmpty()


def parse_ndjson(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Parsed lines (column ``value``): the fields as the text they have in the JSON, and CORRUPT with a line that isn't JSON."""
    schema = string_schema([*fields, CORRUPT])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.where(F.trim("value") != "").select(parsed.alias("r")).select("r.*")


def read_ndjson(spark: SparkSession, path: str, fields: list[str], strict: bool = False) -> DataFrame:
    """Rows of an NDJSON file without type inference. Lines that aren't JSON are left out (see ``bad_lines``); in strict mode they fail the file."""
    if strict:
        return spark.read.schema(string_schema(fields)).option("mode", "FAILFAST").json(path)
    return parse_ndjson(spark.read.text(path), fields).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Number of lines that aren't JSON, or of CSV rows with more cells than the header; their text stays where it is."""
    if path.endswith(SUFFIXES[0]):
        return csv_cells(spark, path, None, _quoted_breaks(spark, path)).where(F.col(BEYOND).isNotNull()).agg(F.count("*").alias("bad_lines"))
    return parse_ndjson(spark.read.text(path), fields).where(F.col(CORRUPT).isNotNull()).agg(F.count("*").alias("bad_lines"))


def chosen(name: Column) -> Column:
    """Whether a file of the landing zone is taken: below the prefix, with one of the suffixes, and no directory marker."""
    return name.startswith(PREFIX) & (name.endswith(SUFFIXES[0]) | name.endswith(SUFFIXES[1]))


def require_suffix(path: str) -> str:
    """The suffix of a path that is read directly; another one is an error."""
    for suffix in SUFFIXES:
        if path.endswith(suffix):
            return suffix
    raise ValueError(f"only {' and '.join(SUFFIXES)} files are read: {path}")


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` and first line of each file, and whether a quoted cell of it holds a line break (``breaks``), in one job over all of them."""
    first = F.min_by("value", F.struct("start", "n"))
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return lines.groupBy("path").agg(first.alias("header"), F.max(_odd_quotes(F.col("value"))).alias("breaks"))


def header_columns(header: str) -> list[str]:
    return next(csv.reader([header]), [])


def read_files(spark: SparkSession, paths: list[str], suffix: str, columns: list[str], fields: list[str], breaks: bool = False) -> DataFrame:
    """user_id and the declared fields of files with one suffix and the same columns, with ``operation_id`` and ``day``, which each file keeps when it is read again, ``file``, and ``bad`` for a line that isn't JSON or a CSV row with more cells than the header.

    A bad row has no values: which cell is which can't be told. ``breaks``: quoted cells hold line breaks, so each file is read in one piece.
    """
    file = F.concat_ws("|", "_metadata.file_path", F.col("_metadata.file_modification_time").cast("string"))
    of_file = [F.substring(F.sha2(file, 256), 1, 32).alias("operation_id"), F.to_date("_metadata.file_modification_time").alias("day"), F.col("_metadata.file_path").alias("file")]
    wanted = list(dict.fromkeys(["user_id", *fields]))
    if suffix == ".json":
        lines = spark.read.text(paths).select("value", *of_file).where(F.trim("value") != "")
        parsed = F.from_json("value", string_schema([*wanted, CORRUPT]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        return lines.select(parsed.alias("r"), "operation_id", "day", "file").select(*[F.col(f"r.{c}").alias(c) for c in wanted], "operation_id", "day", "file", F.col(f"r.{CORRUPT}").isNotNull().alias("bad"))
    bad = F.col(BEYOND).isNotNull()
    return csv_cells(spark, paths, columns, breaks).select(*[F.when(~bad, present(F.col(f"`{c}`"))).alias(c) for c in wanted], *of_file, bad.alias("bad"))


def read_file(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """A landing file by its suffix, with the columns user_id and the declared fields at least; a file that lacks one is an error that names it."""
    if require_suffix(path) == ".json":
        return read_ndjson(spark, path, list(dict.fromkeys(["user_id", *fields])))
    rows = read_csv(spark, path)
    if lacking := missing_columns(rows.columns, fields):
        raise ValueError(f"the file lacks required columns: {', '.join(lacking)}")
    return rows
