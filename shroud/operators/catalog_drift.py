"""Drift between the warehouse's schema and the registry of declared columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions.text import excluded, resource_id

STATUSES = ("REGISTERED", "UNREGISTERED", "DRIFTED")


def column_mode(is_nullable: Column) -> Column:
    return F.when(is_nullable == "YES", "NULLABLE").otherwise("REQUIRED")


def recommended_action(status: Column) -> Column:
    return F.when(status == "UNREGISTERED", "register_resource_or_exclude_dataset").when(status == "DRIFTED", "review_registry_column_drift").otherwise("none")


def crawl(catalog: DataFrame, registry: DataFrame, exclude: list[str] = (), kinds: DataFrame | None = None) -> DataFrame:
    """One row per table of ``catalog`` (an information schema of columns): names, type, status, new columns by ordinal, missing columns sorted, action.

    ``kinds``, an information schema of tables, gives table_type and keeps base tables and views only.

    ``registry`` has resource_id and column_name. A table that the registry lacks is UNREGISTERED,
    with all of its columns new; one whose columns differ is DRIFTED.
    """
    kept = catalog.where(~excluded(F.col("table_schema"), F.col("table_name"), list(exclude)))
    named = kept.withColumn("resource_id", resource_id(F.col("table_catalog"), F.col("table_schema"), F.col("table_name")))
    tables = named.groupBy("resource_id", "table_catalog", "table_schema", "table_name").agg(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))).alias("found"))
    declared = registry.groupBy("resource_id").agg(F.collect_set("column_name").alias("declared"))
    if kinds is None:
        tables = tables.withColumn("table_type", F.lit(None).cast("string"))
    else:
        tables = tables.join(kinds.where(F.col("table_type").isin("BASE TABLE", "VIEW")).select("table_catalog", "table_schema", "table_name", "table_type"), ["table_catalog", "table_schema", "table_name"])
    both = tables.join(declared, "resource_id", "left").withColumn("names", F.transform("found", lambda c: c["column_name"]))
    new = F.filter("names", lambda c: ~F.coalesce(F.array_contains("declared", c), F.lit(False)))
    missing = F.coalesce(F.array_sort(F.array_except("declared", "names")), F.array().cast("array<string>"))
    rows = both.withColumn("new_columns", new).withColumn("missing_columns", missing)
    status = F.when(F.col("declared").isNull(), "UNREGISTERED").when((F.size("new_columns") > 0) | (F.size("missing_columns") > 0), "DRIFTED").otherwise("REGISTERED")
    rows = rows.withColumn("status", status)
    return rows.select("resource_id", "table_catalog", "table_schema", "table_name", "table_type", "status", F.size("names").alias("column_count"), "new_columns", "missing_columns", recommended_action(F.col("status")).alias("recommended_action"))


def column_drift(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """The same difference column by column, as a full join: resource_id, column_name, and which side lacks it."""
    found = catalog.select(resource_id(F.col("table_catalog"), F.col("table_schema"), F.col("table_name")).alias("resource_id"), "column_name", F.lit(True).alias("found")).distinct()
    declared = registry.select("resource_id", "column_name", F.lit(True).alias("declared")).distinct()
    side = F.when(F.col("found").isNull(), "missing").when(F.col("declared").isNull(), "new")
    return found.join(declared, ["resource_id", "column_name"], "full").select("resource_id", "column_name", side.alias("drift")).where("drift IS NOT NULL")


def status_counts(diffs: DataFrame) -> DataFrame:
    """Tables of each status in one row, zeros included."""
    return diffs.agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES])
