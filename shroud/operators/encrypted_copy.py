"""Encrypted wide copies: source rows whose personal cells are the ciphertext that the vault already holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shroud.functions.text import json_safe
from shroud.sources import sinks


def wide_copy(source: DataFrame, vault: DataFrame, resource_id: str, fields: list[str], synced_at=None) -> DataFrame:
    """Source rows with the vault's ciphertext in place of each field, for users that the vault holds; nothing is encrypted twice.

    A field that the vault lacks is null, never plain text. Other columns are JSON-safe text.
    """
    latest_value = F.max_by("encrypted_value", "synced_at").alias("encrypted_value")  # one for each natural key, even if the vault should hold it twice
    held = vault.where(F.col("resource_id") == resource_id).groupBy("tenant_id", "user_id", "field_name").agg(latest_value)
    own = held.groupBy("tenant_id", "user_id").agg(F.map_from_entries(F.collect_list(F.struct("field_name", "encrypted_value"))).alias("cells"))
    kinds = dict(source.dtypes)
    plain = [json_safe(F.col(c), kinds[c]).alias(c) for c in source.columns if c not in fields]
    rows = source.where("user_id IS NOT NULL").join(own, ["tenant_id", "user_id"])
    at = F.current_timestamp() if synced_at is None else synced_at
    return rows.select(*plain, *[F.try_element_at("cells", F.lit(f)).alias(f) for f in fields], at.alias("synced_at"))


def copy_path(copies: str, resource_id: str) -> str:
    """Where a resource's copy stands below the folder of copies: named by project, dataset and table, so that tables of one name in two datasets have two."""
    return f"{copies}/{resource_id.partition(':')[2] or resource_id}_encrypted_raw"


def append_copy(spark: SparkSession, source: DataFrame, vault: str, copies: str, resource_id: str, fields: list[str]) -> None:
    """Appends the wide rows of the users that the stored vault holds for the resource and the copy doesn't, so what an earlier run failed to copy is made up for."""
    path = copy_path(copies, resource_id)
    held = spark.read.parquet(vault).where(F.col("resource_id") == resource_id)
    lacking = held.select("tenant_id", "user_id").distinct()
    if sinks.exists(spark, path):
        lacking = lacking.join(spark.read.parquet(path).select("tenant_id", "user_id"), ["tenant_id", "user_id"], "left_anti")
    wide = source.select("tenant_id", "user_id", *[f for f in fields if f not in ("tenant_id", "user_id")]).join(lacking, ["tenant_id", "user_id"], "left_semi")
    sinks.append(wide_copy(wide, held, resource_id, fields).withColumn("resource_id", F.lit(resource_id)), path)


def made_up_for(spark: SparkSession, source: DataFrame, vault: str, copies: str, resource_id: str, fields: list[str]) -> str | None:
    """``append_copy``, whose failure never undoes what the vault holds: what went wrong is given back, and the next run makes up for it."""
    try:
        append_copy(spark, source, vault, copies, resource_id, fields)
    except Exception as error:  # noqa: BLE001  the vault is complete without the copy
        return f"copy: {(str(error).strip().splitlines() or [type(error).__name__])[0][:500]}"
    return None


def latest(copy: DataFrame, user_column: str = "user_id", order: tuple[str, ...] = ("synced_at",)) -> DataFrame:
    """The latest row of each user of an append-only copy."""
    newest = Window.partitionBy(user_column).orderBy(*[F.col(c).desc() for c in order])
    return copy.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def latest_combined(copy: DataFrame, user_column: str = "user_id", order: tuple[str, ...] = ("synced_at",)) -> DataFrame:
    """The same rows as the largest struct of each user: each task sends one row per user, so a history of many rows is hardly shuffled."""
    rest = [c for c in copy.columns if c != user_column]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    return copy.groupBy(user_column).agg(best).select(user_column, *[F.col(f"r.{c}").alias(c) for c in rest])
