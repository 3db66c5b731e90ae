"""A sync run: every declared resource from the registry to rows of the vault, one result for each, and failures that stop no other."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators import encrypted_copy as C
from shroud.operators import keys as K
from shroud.operators import vault_sync as S
from shroud.operators.sync_state import SyncState
from shroud.sources import scratch

RESULT = "resource_id string, status string, reason string, units long, started_at timestamp, succeeded boolean, updated_at_column string"


class Run:
    """``source`` gives the rows of a resource by its id, with columns tenant_id and user_id in the names that the registry declares, or raises; ``state`` holds the marks of earlier runs and takes those of this one.

    A resource with a time column and a mark is read from that mark on, unless ``force_full``; the mark of
    this run is the time before its scan. Wide copies go below ``copies``, for resources that want one. With
    ``units``, a folder, nothing is read but ids: units of work are written there, for the stream that takes them.
    """

    def __init__(self, spark: SparkSession, source: Callable[[str], DataFrame], keys: K.KeyTable, vault: str, default_tenant: str, state: SyncState, copies: str | None = None, owner: str = "manual", units: str | None = None, run_id: str | None = None):
        self.spark, self.source, self.keys, self.vault, self.default_tenant, self.state, self.copies, self.owner = spark, source, keys, vault, default_tenant, state, copies, owner
        self.units, self.run_id = units, run_id or uuid.uuid4().hex

    def all(self, resources: DataFrame, force_full: bool = False) -> DataFrame:
        """Results of the owner's resources: SYNCED with its work units, SKIPPED with the reason, or ERROR with what went wrong."""
        return self._results(resources.where(F.col("owner_connector") == self.owner), force_full)

    def one(self, resources: DataFrame, resource_id: str, force_full: bool = False) -> DataFrame:
        """The result of one resource; one that isn't declared, or belongs to another owner, is an ERROR."""
        found = resources.where(F.col("id") == resource_id)
        owners = [r.owner_connector for r in found.select("owner_connector").take(1)]
        if not owners or owners[0] != self.owner:
            reason = "other_owner" if owners else "not_declared"
            return self.spark.createDataFrame([(resource_id, "ERROR", reason, 0, dt.datetime.now(), False, None)], RESULT)
        return self._results(found, force_full)

    def _results(self, resources: DataFrame, force_full: bool) -> DataFrame:
        skipped = S.skip_reasons(resources, owner=self.owner).withColumnRenamed("resource_id", "id")
        fields = F.transform(F.filter("columns", lambda c: F.coalesce(c["handling"] == "ENCRYPT", F.lit(False))), lambda c: c["name"])
        declared = resources.select("id", "user_id_column", "tenant_id_column", "updated_at_column", fields.alias("fields"), F.array_contains("redaction_strategies", "ENCRYPTED_COPY").alias("copy"))
        marks = self.state.read().select(F.col("resource_id").alias("id"), "last_synced_at")
        rows = [self._one(r, force_full) for r in declared.join(skipped, "id").join(marks, "id", "left").orderBy("id").collect()]  # a row for each declared resource
        results = self.spark.createDataFrame(rows, RESULT)
        self.state.advance(results.where("status <> 'SKIPPED' AND succeeded"))
        return results

    def _one(self, r, force_full: bool) -> tuple:
        started = dt.datetime.now()
        if r.reason:
            status = "ERROR" if r.reason == "bad_id" else "SKIPPED"
            return (r.id, status, r.reason, 0, started, False, r.updated_at_column)
        try:
            with scratch.cleared(self.spark):
                units, reason = self._sync(r, None if force_full else r.last_synced_at)
            return (r.id, "SYNCED", reason, units, started, True, r.updated_at_column)
        except Exception as error:  # noqa: BLE001  one resource's failure is its own result
            return (r.id, "ERROR", said(error), 0, started, False, r.updated_at_column)

    def _sync(self, r, since: dt.datetime | None) -> tuple[int, str | None]:
        """Units of work, and what went wrong beside the vault."""
        rows = self.source(r.id)
        tenant = F.col(r.tenant_id_column).cast("string") if r.tenant_id_column else F.lit(self.default_tenant)
        named = rows.withColumns({"user_id": F.col(r.user_id_column).cast("string"), "tenant_id": F.coalesce(tenant, F.lit(self.default_tenant))})
        users = scratch.written(S.changed_users(named, "user_id", r.updated_at_column, since), "changed")  # ids only
        if self.units:
            units = S.work_units(users.withColumn("resource_id", F.lit(r.id))).withColumn("run_id", F.lit(self.run_id))
            units.select("run_id", "resource_id", "user_ids").write.mode("append").json(self.units)
        else:
            S.sync_users(named, users, self.vault, self.keys, r.id, r.fields, self.default_tenant, r.updated_at_column)
        reason = C.made_up_for(self.spark, named, self.vault, self.copies, r.id, r.fields) if r.copy and self.copies and not self.units else None
        return -(-users.count() // S.UNIT), reason


def said(error: Exception) -> str:
    """The first line of an error's text, or its kind if it has none."""
    return (str(error).strip().splitlines() or [type(error).__name__])[0][:500]
