"""Keys of users: stored documents, users without a key, new keys, and keys attached to rows."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import StringType

from shroud.functions.crypto import masks
from shroud.functions.text import non_empty
from shroud.sources.versions import Versions

KEY = ["tenant_id", "user_id"]
#: States in which a key must not be used.
GONE = ("SHREDDED", "DELETED")


def from_documents(documents: DataFrame) -> DataFrame:
    """Usable keys from stored documents, whose fields have snake_case or camelCase names: user_id, tenant_id, key_id, dek, token_key_id, encryption_version, status.

    The key itself is the first non-empty of encrypted_dek, encryptedDek, dek, and else the entry of
    the map ``deks`` for the active version, v1 by default. Documents without one, and shredded or
    deleted ones, give no row. Columns that ``documents`` lacks count as null.
    """
    has = {c.lower() if c.islower() else c for c in documents.columns}
    text = lambda *names: non_empty(*[F.col(n) if n in has else F.lit(None).cast("string") for n in names])
    active = F.coalesce(text("active_dek_id", "activeDekId"), F.lit("v1"))
    mapped = F.try_element_at(F.col("deks"), active) if "deks" in has else F.lit(None).cast("string")
    rows = documents.select(
        text("user_id", "userId").alias("user_id"),
        text("tenant_id", "tenantId").alias("tenant_id"),
        F.coalesce(text("key_id", "keyId", "active_dek_id"), F.lit("v1")).alias("key_id"),
        F.coalesce(text("encrypted_dek", "encryptedDek", "dek"), non_empty(mapped)).alias("dek"),
        text("token_key_id", "tokenKeyId").alias("token_key_id"),
        F.coalesce(text("encryption_version", "encryptionVersion"), F.lit("v1")).alias("encryption_version"),
        F.col("status"),
    )
    return rows.where(F.col("dek").isNotNull() & ~F.coalesce(F.col("status").isin(*GONE), F.lit(False)))


def live(keys: DataFrame) -> DataFrame:
    """Keys that may be used."""
    return keys.where(~F.coalesce(F.col("status").isin(*GONE), F.lit(False)))


def users_without_key(users: DataFrame, keys: DataFrame) -> DataFrame:
    """Each (tenant, user) once that has no key of any state: a shredded user gets no second key."""
    return users.select(*KEY).where("user_id IS NOT NULL").dropDuplicates(KEY).join(keys.select(*KEY), KEY, "left_anti")


@pandas_udf(StringType())
def _random_keys(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield pd.Series([os.urandom(32).hex() for _ in range(len(part))], index=part.index, dtype=object)


def new_keys(users: DataFrame, keys: DataFrame) -> DataFrame:
    """A new key for every user without one. The keys are random: write them before they are used."""
    made = _random_keys.asNondeterministic()
    return users_without_key(users, keys).select(*KEY, F.lit("v1").alias("key_id"), F.lit("v2").alias("encryption_version"), made(F.col("user_id")).alias("dek_hex"), F.lit("ACTIVE").alias("status"))


KEY_SCHEMA = "tenant_id string, user_id string, key_id string, encryption_version string, dek_hex string, status string"


#: Buckets of a key table, and folders of one that are merged into one.
BUCKETS, MERGED = 16, 24


def bucket(buckets: int) -> Column:
    """The bucket of a (tenant, user)."""
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


class KeyTable:
    """Keys in a table with versions, dealt to ``buckets`` folders by a hash of (tenant, user); a larger table wants more of them.

    A batch reads the buckets of its users only. New keys are committed after the version in which their users
    had none, so of two writers that make a key for the same user the second finds the first one's.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.versions = Versions(spark, path, f"{KEY_SCHEMA}, bucket int")

    def read(self, users: DataFrame | None = None) -> DataFrame:
        """The keys as they are at the moment; with ``users``, those of their buckets."""
        return self._held(self.versions.newest(), None if users is None else self._buckets(users))

    def _buckets(self, users: DataFrame) -> list[int]:
        return [r[0] for r in users.select(bucket(self.buckets).alias("b")).distinct().collect()]  # ``buckets`` of them at most

    def _held(self, version: int, found: list[int] | None) -> DataFrame:
        held = self.versions.read(version)
        return (held if found is None else held.where(F.col("bucket").isin(found))).drop("bucket")

    def add(self, keys: DataFrame) -> None:
        """Adds keys, whoever has one already."""
        name = self._staged(keys)
        while not self._commit(self.versions.newest(), name):
            pass

    def ensure(self, users: DataFrame, tries: int = 50) -> DataFrame:
        """The keys of the users' buckets, after every (tenant, user) of ``users`` without one got one. New keys are random, so they are written before anyone reads them."""
        found = self._buckets(users.where("user_id IS NOT NULL"))
        for _ in range(tries):
            version = self.versions.newest()
            name = self._staged(new_keys(users, self._held(version, found)))
            if self.versions.folder(name).isEmpty():
                self.versions.drop(name)
                return self._held(version, found)
            if self._commit(version, name):
                return self._held(self.versions.newest(), found)
            self.versions.drop(name)
        raise RuntimeError(f"{tries} times another writer came first")

    def _staged(self, keys: DataFrame) -> str:
        dealt = keys.select(*[c.split()[0] for c in KEY_SCHEMA.split(", ")], bucket(self.buckets).alias("bucket"))
        return self.versions.stage(dealt.repartition("bucket"), ["bucket"])

    def _commit(self, version: int, name: str) -> bool:
        """Commits a folder; every MERGED folders become one, so a table has few files."""
        names = [*self.versions.folders(version), name]
        if len(names) < MERGED:
            return self.versions.commit(version, names)
        merged = self._staged(self.versions.folder(*names))
        if self.versions.commit(version, [merged]):
            return True
        self.versions.drop(merged)
        return False


def attach(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with key_id, encryption_version, dek_hex and its two HMAC masks of their user's live key; rows without one are left out (see ``without_key``).

    Masks are made here, once for each row, so that fields that are unpivoted or tokenised later don't make them again.
    """
    held = rows.join(live(keys).select(*KEY, "dek_hex", "key_id", "encryption_version"), KEY)
    return held.withColumns(masks(F.col("dek_hex")))


def without_key(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows that ``attach`` leaves out."""
    return rows.join(live(keys).select(*KEY), KEY, "left_anti")


def tenant(header: Column, body: Column) -> Column:
    """The header's tenant, else the body's; an empty one counts as absent, and null means that the message is rejected."""
    return non_empty(header, body)
