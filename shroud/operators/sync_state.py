"""Marks of earlier sync runs, stored so that runs that overlap never move one back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shroud.operators.vault_sync import advance
from shroud.sources.versions import Versions

STATE = "resource_id string, last_synced_at timestamp, last_attempt_at timestamp"


class SyncState:
    """A row of marks for each resource, in a table with versions.

    A run's results are added to the version that was read; if another run committed meanwhile, its version
    is read and they are added to that one, so no run's marks are lost.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.versions = Versions(spark, path, STATE)

    def read(self) -> DataFrame:
        return self.versions.read()

    def advance(self, results: DataFrame, tries: int = 50) -> None:
        """Adds the results of a run: resource_id, started_at, succeeded, updated_at_column."""
        for _ in range(tries):
            version = self.versions.newest()
            name = self.versions.stage(advance(self.versions.read(version), results).coalesce(1))  # a row for each declared resource
            if self.versions.commit(version, [name]):
                return
            self.versions.drop(name)
        raise RuntimeError(f"{tries} times another run came first")
