"""Discovery tables of many locations, grouped into one entry for each resource."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions.text import non_empty

SCHEMA = "resource_id string, table_catalog string, table_schema string, table_name string, field_name string, classification string, confidence string, detection_method string"


def read_locations(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of the tables at the given paths, duplicates kept, with ``location`` numbers; a missing one gives no rows."""
    found = []
    for number, path in enumerate(paths):
        try:
            found.append(spark.read.parquet(path).withColumn("location", F.lit(number)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    none = spark.createDataFrame([], SCHEMA + ", location int")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found, none)


def location_parts(location: Column, default_project: Column) -> Column:
    """struct(project, dataset) of ``project.dataset``, or of a bare dataset in the default project."""
    dot = F.instr(location, ".")
    return F.when(dot > 0, F.struct(F.substring_index(location, ".", 1).alias("project"), F.substr(location, dot + 1).alias("dataset"))).otherwise(F.struct(default_project.alias("project"), location.alias("dataset")))


def with_defaults(rows: DataFrame) -> DataFrame:
    """Rows with ``sure`` and ``method``, the confidence and detection method or their defaults."""
    return rows.select("*", F.coalesce(non_empty(F.col("confidence")), F.lit("INFERRED_HIGH")).alias("sure"), F.coalesce(non_empty(F.col("detection_method")), F.lit("INFORMATION_SCHEMA")).alias("method"))


def group_resources(rows: DataFrame, default_project: str) -> DataFrame:
    """One row per resource: names from its first row (by ``pos``), fields in order of their first row, and classifications by field, of which the last counts.

    A field is listed once, with the number ``n`` of its rows: rows are combined by resource and field
    before they meet in one task, so a resource with a third of all rows costs its fields only.
    """
    first = F.min_by(F.struct(F.coalesce(non_empty(F.col("table_catalog")), F.lit(default_project)).alias("project_id"), F.col("table_schema").alias("dataset_id"), F.col("table_name").alias("table_id"), "sure", "method"), "pos").alias("first")
    fields = with_defaults(rows).groupBy("resource_id", "field_name").agg(F.min("pos").alias("pos"), first, F.max_by("classification", "pos").alias("classification"), F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("pos", "field_name", "classification", F.col("first.sure").alias("sure"), F.col("first.method").alias("method"), "n")))
    grouped = fields.groupBy("resource_id").agg(F.min_by("first", "pos").alias("t"), listed.alias("fields"))
    names = F.transform("fields", lambda x: x["field_name"])
    return grouped.select("resource_id", "t.project_id", "t.dataset_id", "t.table_id", names.alias("field_names"), "fields", F.map_from_arrays(names, F.transform("fields", lambda x: x["classification"])).alias("classifications"))


def publish_counts(rows: DataFrame) -> DataFrame:
    """Resources and field rows of a run, counted without any list."""
    return rows.groupBy("resource_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("resources"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("fields"))
