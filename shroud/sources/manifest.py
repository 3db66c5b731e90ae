"""Model manifests: the models of a JSON object whose nodes are a map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators.policy import candidates

_NODE = "struct<resource_type:string,database:string,schema:string,alias:string,name:string,path:string,fqn:array<string>,columns:map<string,struct<name:string>>,meta:struct<`{}`:struct<mart_manual_review_approved:boolean>>>"


def read_models(spark: SparkSession, path: str, multi_line: bool = True, meta_key: str = "privacy") -> DataFrame:
    """The nodes that are models: node_id, name (``<unknown>`` without one), path, fqn, names of columns, whether a review was approved, and candidate resource ids.

    An approval stands in the object that ``meta`` holds under ``meta_key``.
    """
    rows = spark.read.schema(f"nodes map<string,{_NODE.format(meta_key)}>").option("multiLine", multi_line).json(path)
    nodes = rows.select(F.explode("nodes").alias("node_id", "n")).where("n.resource_type = 'model'")
    n = F.col("n")
    return nodes.select(
        "node_id", F.coalesce(n["name"], F.lit("<unknown>")).alias("name"), n["path"].alias("path"), F.coalesce(n["fqn"], F.array().cast("array<string>")).alias("fqn"),
        F.coalesce(F.map_keys(n["columns"]), F.array().cast("array<string>")).alias("columns"), F.coalesce(n["meta"][meta_key]["mart_manual_review_approved"], F.lit(False)).alias("approved"),
        candidates(n["database"], n["schema"], n["alias"], n["name"]).alias("candidates"),
    )
