"""Back-fill of source tables into one vault of encrypted fields: incremental, and idempotent by a diff on the natural key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions import crypto
from shroud.operators import keys as K
from shroud.operators.numbering import numbered
from shroud.sources.sinks import append_vault, exists

UNIT = 100
VAULT = "tenant_id string, user_id string, key_id string, token string, encrypted_value string, synced_at timestamp, resource_id string, field_name string"
NATURAL_KEY = ["tenant_id", "user_id", "resource_id", "field_name"]


def changed_users(source: DataFrame, user_column: str, updated_column: str | None = None, last_synced: dt.datetime | None = None, force_full: bool = False) -> DataFrame:
    """Distinct non-null user ids, as text; only rows changed at or after the last sync if there is one, a time column, and no force."""
    rows = source
    if not force_full and updated_column and last_synced is not None:
        rows = rows.where(F.col(updated_column) >= F.lit(last_synced))
    return rows.where(F.col(user_column).isNotNull()).select(F.col(user_column).cast("string").alias("user_id")).distinct()


def work_units(users: DataFrame, size: int = UNIT) -> DataFrame:
    """Units of exactly ``size`` user ids of each resource but for its last, in order and with a running unit number; ids only, never values.

    Ids are numbered by ``numbered``, so no task sees a whole resource.
    """
    ids = users.select("resource_id", "user_id").where("user_id IS NOT NULL").distinct()
    rows = numbered(ids, ["resource_id"], ["user_id"])
    return rows.groupBy("resource_id", F.floor(F.col("number") / size).cast("long").alias("unit")).agg(F.array_sort(F.collect_list("user_id")).alias("user_ids"))


def reread(source: DataFrame, users: DataFrame, user_column: str = "user_id") -> DataFrame:
    """Source rows of the given users, whose ids are compared as text."""
    wanted = users.select(F.col("user_id").cast("string").alias("wanted"))
    return source.join(wanted, F.col(user_column).cast("string") == F.col("wanted"), "left_semi")


def latest_fields(source: DataFrame, fields: list[str], default_tenant: str, updated_column: str | None = None) -> DataFrame:
    """One row per user with ``f``, name and value of each field that isn't null; of repeated users the latest row counts, then the larger value."""
    order = F.col(updated_column) if updated_column else F.lit(0)
    rows = source.where("user_id IS NOT NULL").select(F.coalesce(F.col("tenant_id").cast("string"), F.lit(default_tenant)).alias("tenant_id"), F.col("user_id").cast("string").alias("user_id"), order.alias("at"), *[F.col(f).cast("string").alias(f"cell_{n}") for n, f in enumerate(fields)])
    best = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("at", c)))
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), best(f"cell_{n}").alias("value")) for n, f in enumerate(fields)])
    return rows.groupBy(*K.KEY).agg(F.filter(each, lambda one: one["value"].isNotNull()).alias("f"))


def long_fields(source: DataFrame, resource_id: str, fields: list[str], default_tenant: str, updated_column: str | None = None) -> DataFrame:
    """``latest_fields`` as one row per natural key with its value."""
    tall = latest_fields(source, fields, default_tenant, updated_column).select(*K.KEY, F.inline("f"))
    return tall.withColumn("resource_id", F.lit(resource_id)).select(*NATURAL_KEY, "value")


def not_yet_synced(fields: DataFrame, vault: DataFrame, tenant_in_key: bool = True) -> DataFrame:
    """Fields whose natural key isn't in the vault; without the tenant in the key, users of two tenants count as one."""
    on = NATURAL_KEY if tenant_in_key else NATURAL_KEY[1:]
    return fields.join(vault.select(*on), on, "left_anti")


def lacking(users: DataFrame, vault: DataFrame, fields: list[str]) -> DataFrame:
    """Users of ``latest_fields`` with those of their fields that the vault's rows of one resource don't hold; users without any are left out.

    Rows stay dealt by user, so the users' keys are all that is shuffled for them later.
    """
    has = [F.max(F.col("field_name") == f).alias(f"has_{n}") for n, f in enumerate(fields)]
    held = users.join(vault.groupBy(*K.KEY).agg(*has), K.KEY, "left")
    known = F.array(*[F.when(F.col(f"has_{n}"), F.lit(f)) for n, f in enumerate(fields)])
    rest = F.filter("f", lambda one: ~F.coalesce(F.array_contains(known, one["field_name"]), F.lit(False)))
    return held.select(*K.KEY, rest.alias("f")).where(F.size("f") > 0)


def vault_records(fields: DataFrame, keys: DataFrame, synced_at: Column | None = None) -> DataFrame:
    """Rows for the vault: token and stored form of each value under its user's live key. Write them before anything is derived."""
    users = fields.groupBy(*K.KEY).agg(F.collect_list(F.struct("resource_id", "field_name", "value")).alias("f"))  # a key is joined and masked once for a user
    return _sealed(users, keys, synced_at=synced_at)


def _sealed(users: DataFrame, keys: DataFrame, resource_id: str | None = None, synced_at: Column | None = None) -> DataFrame:
    """Rows for the vault of users with their fields ``f``, of one resource or of those that the fields name."""
    held = K.attach(users, keys).select(*K.KEY, "key_id", "dek_hex", "inner_mask", "outer_mask", F.inline("f"))
    held = held if resource_id is None else held.withColumn("resource_id", F.lit(resource_id))
    stored = crypto.vault_value(crypto.bundle(F.col("value"), F.col("dek_hex"), F.col("user_id"), F.col("key_id")))
    at = F.current_timestamp() if synced_at is None else synced_at
    return held.select(*NATURAL_KEY, "key_id", crypto.masked_token(F.col("value")).alias("token"), stored.alias("encrypted_value"), at.alias("synced_at"))


def sync(source: DataFrame, vault: DataFrame, keys: K.KeyTable, resource_id: str, fields: list[str], default_tenant: str, updated_column: str | None = None) -> DataFrame:
    """New vault rows of one resource; users of a missing field who have no key get one first, and shredded users none. The vault is read for this resource and its key columns only."""
    known = vault.where(F.col("resource_id") == resource_id)
    missing = lacking(latest_fields(source, fields, default_tenant, updated_column), known, fields)
    return _sealed(missing, keys.ensure(missing), resource_id)


def sync_users(source: DataFrame, users: DataFrame, vault: str, keys: K.KeyTable, resource_id: str, fields: list[str], default_tenant: str, updated_column: str | None = None) -> None:
    """Reads the users' source rows again, once, and appends the missing fields to the stored vault."""
    known = read_vault(source.sparkSession, vault).where(F.col("resource_id") == resource_id)
    missing = lacking(latest_fields(reread(source, users), fields, default_tenant, updated_column), known, fields).persist()
    try:
        append_vault(_sealed(missing, keys.ensure(missing), resource_id), vault)
    finally:
        missing.unpersist()


def read_vault(spark: SparkSession, path: str) -> DataFrame:
    """The stored vault, or an empty one before the first row is written."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], VAULT)


def users_synced(records: DataFrame) -> DataFrame:
    """Users with at least one record written, by resource."""
    return records.groupBy("resource_id").agg(F.count_distinct("tenant_id", "user_id").alias("users_synced"))


def skip_reasons(resources: DataFrame, system: str = "bigquery", owner: str = "manual") -> DataFrame:
    """resource_id and why a sync run passes it over, null if it doesn't."""
    reason = (
        F.when(F.col("owner_connector").isNull() | (F.col("owner_connector") != owner), "other_owner")
        .when(F.col("system").isNull() | (F.col("system") != system), "other_system")
        .when(F.col("user_id_column").isNull(), "no_user_column")
        .when(~F.exists("columns", lambda c: F.coalesce(c["handling"] == "ENCRYPT", F.lit(False))), "no_field_to_encrypt")
        .when(~F.col("id").rlike(r"^bigquery:[^.]+\.[^.]+\.[^.]+$"), "bad_id")
    )
    return resources.select(F.col("id").alias("resource_id"), reason.alias("reason"))


def advance(state: DataFrame, runs: DataFrame) -> DataFrame:
    """New state (resource_id, last_synced_at, last_attempt_at): the start of a full success moves the mark of a resource with a time column, never back; every completed run moves the attempt.

    ``runs``: resource_id, started_at (taken before the scan), succeeded, updated_at_column.
    """
    moved = F.max(F.when(F.col("succeeded") & F.col("updated_at_column").isNotNull(), F.col("started_at"))).alias("mark")
    latest = runs.groupBy("resource_id").agg(moved, F.max("started_at").alias("attempt"))
    return state.join(latest, "resource_id", "full").select("resource_id", F.greatest("last_synced_at", "mark").alias("last_synced_at"), F.greatest("last_attempt_at", "attempt").alias("last_attempt_at"))


OUTCOME = "run_id string, resource_id string, unit_id string, users long, status string, tries int, error string"


def unit_id() -> Column:
    """What names a unit of work: its resource and its users."""
    return F.sha2(F.concat_ws("\n", "resource_id", F.array_join("user_ids", "\n")), 256)


def settled(outcomes: DataFrame) -> DataFrame:
    """One outcome of each unit of a run, however often it came: COMPLETED if it ever was, else FAILED if that, else DROPPED."""
    best = F.min(F.struct(F.when(F.col("status") == "COMPLETED", 0).when(F.col("status") == "FAILED", 1).otherwise(2).alias("order"), "status", "error")).alias("o")
    return outcomes.groupBy("run_id", "resource_id", "unit_id").agg(best).select("run_id", "resource_id", "unit_id", "o.status", "o.error")


def run_progress(units: DataFrame) -> DataFrame:
    """Units of each run in total, completed and failed."""
    return units.groupBy("run_id").agg(F.count("*").alias("units"), F.count_if(F.col("status") == "COMPLETED").alias("completed"), F.count_if(F.col("status") == "FAILED").alias("failed"))


def run_summary(units: DataFrame) -> DataFrame:
    """Units queued and errors of each resource of a run."""
    return units.groupBy("run_id", "resource_id").agg(F.count_if(F.col("status") != "ERROR").alias("queued"), F.count_if(F.col("status") == "ERROR").alias("errors"))
