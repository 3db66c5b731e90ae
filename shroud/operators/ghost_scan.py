"""Scans of tables for personal data that no one declared. Findings hold names and counts, never values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions.text import PATTERNS, classify, enabled

SAMPLE = 1000


def sampled(rows: DataFrame, full: bool = False, limit: int = SAMPLE, by: str | None = None) -> DataFrame:
    """All rows in full mode, else ``limit`` of them: any, or those with the smallest hash of a column, which repeats."""
    if full:
        return rows
    return rows.limit(limit) if by is None else rows.orderBy(F.sha2(F.col(by).cast("string"), 256), by).limit(limit)


def scanned_columns(rows: DataFrame, exempt: set[str]) -> list[str]:
    """String columns that aren't exempt: declared direct identifiers, allowed ones, and the tenant and user columns are."""
    return sorted(c for c, kind in rows.dtypes if kind == "string" and c not in exempt)


def findings(rows: DataFrame, exempt: set[str], patterns: list[str] | None = None) -> DataFrame:
    """column_name, pattern and findings, sorted: every cell is classified once, in one pass that shuffles partial counts only."""
    columns = scanned_columns(rows, exempt)
    tall = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), enabled(classify(F.col(c)), patterns or []).alias("pattern")) for c in columns])).alias("f")) if columns else rows.limit(0).select(F.lit(None).cast("struct<column_name:string,pattern:string>").alias("f"))
    counted = tall.select("f.*").where("pattern IS NOT NULL").groupBy("column_name", "pattern").agg(F.count("*").alias("findings"))
    return counted.orderBy("column_name", "pattern")


def counts_by_column(rows: DataFrame, exempt: set[str]) -> DataFrame:
    """One row with a count for each column and pattern, zeros included, from one aggregate without any key."""
    made = [F.count_if(classify(F.col(c)) == p).alias(f"{c}_{p}") for c in scanned_columns(rows, exempt) for p in PATTERNS]
    return rows.agg(*made)


def with_canary(rows: DataFrame, canary: DataFrame) -> DataFrame:
    """Rows and a planted one, which proves that a scan works."""
    return rows.unionByName(canary, allowMissingColumns=True)


def without_operation(rows: DataFrame, operation_id: str) -> DataFrame:
    """Rows but those of one operation: what is written back to purge it. Rows without an operation stay."""
    return rows.where(~F.col("operation_id").eqNullSafe(operation_id))
