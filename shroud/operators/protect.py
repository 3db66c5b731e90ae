"""Landing rows to protected records: every declared field encrypted and tokenised under its user's key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions import crypto
from shroud.functions.text import valid_email
from shroud.operators import keys as K

#: Declared fields of a resource that the registry doesn't know.
FALLBACK_FIELDS = ["email"]


def encrypted_fields(columns: DataFrame | None, resource_id: str) -> list[str]:
    """Names of the resource's columns that are to be encrypted, in declared order; the fallback without a registry or resource."""
    if columns is None:
        return FALLBACK_FIELDS
    rows = columns.where((F.col("resource_id") == resource_id) & (F.col("handling") == "ENCRYPT")).orderBy("position").select("name").collect()
    known = rows or columns.where(F.col("resource_id") == resource_id).take(1)
    return [r.name for r in rows] if known else FALLBACK_FIELDS


def missing_columns(columns: list[str], fields: list[str]) -> list[str]:
    """Required columns that a file lacks: user_id and the declared fields, sorted."""
    return sorted({"user_id", *fields} - set(columns))


def rejection(fields: list[str]) -> Column:
    """Why a row is dropped as a whole, or null: a reason code, never a value."""
    any_null = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])
    reason = F.when(F.col("user_id").isNull(), "missing_user").when(any_null, "missing_field")
    return reason.when(~valid_email(F.col("email")), "malformed_email") if "email" in fields else reason


def accepted(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Rows with every declared field, and an e-mail of the right form if ``email`` is declared."""
    return rows.where(rejection(fields).isNull())


def quarantine(rows: DataFrame, fields: list[str], *keep: str) -> DataFrame:
    """user_id and reason of every row that ``accepted`` drops; columns to ``keep`` come first."""
    return rows.select(*keep, "user_id", rejection(fields).alias("reason")).where("reason IS NOT NULL")


def protect(rows: DataFrame, keys: DataFrame, fields: list[str], operation_id: str | Column, source_system: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records in the shape of the raw table, one for each accepted row whose user has a live key.

    ``pii_fields`` holds field name, token and encrypted bundle of each field in declared order. The
    columns for a field named ``email`` repeat its token and bundle, and are empty without one.
    """
    held = K.attach(accepted(rows, fields), keys)
    dek, user = F.col("dek_hex"), F.col("user_id")
    each = [F.struct(F.lit(f).alias("field_name"), crypto.masked_token(F.col(f)).alias("token"), F.encode(crypto.bundle(F.col(f), dek, user, F.col("key_id")), "UTF-8").alias("encrypted_value")) for f in fields]
    held = held.withColumn("pii_fields", F.array(*each))
    email = F.try_element_at(F.filter("pii_fields", lambda x: x["field_name"] == "email"), F.lit(1))
    token = F.coalesce(email["token"], F.lit(""))
    return held.select(
        "tenant_id", "user_id", token.alias("email_token"), "encryption_version", "key_id",
        F.coalesce(email["encrypted_value"], F.lit("").cast("binary")).alias("encrypted_pii"), token.alias("data_hash"),
        (F.lit(operation_id) if isinstance(operation_id, str) else operation_id).alias("operation_id"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
        F.lit(source_system).alias("source_system"), "pii_fields", *keep,
    )


def taken_messages(messages: DataFrame) -> DataFrame:
    """Messages with tenant, user and e-mail, as columns."""
    named = messages.withColumn("tenant_id", K.tenant(F.col("header_tenant"), F.col("body_tenant"))).withColumn("email", F.try_element_at("payload", F.lit("email")))
    return named.where("tenant_id IS NOT NULL AND user_id IS NOT NULL AND email IS NOT NULL")


def single_messages(messages: DataFrame, keys: DataFrame) -> DataFrame:
    """Records of single messages (header_tenant, body_tenant, user_id, payload map, operation_id): the payload's e-mail as a bare payload.

    Messages without tenant, user or e-mail give no record (see ``rejected_messages``).
    """
    held = K.attach(taken_messages(messages), keys)
    return held.select("user_id", "tenant_id", crypto.encrypt(F.col("email"), F.col("dek_hex"), F.col("user_id")).alias("encrypted_pii"), "key_id", "operation_id")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """operation_id and reason of the messages that can't be taken."""
    reason = F.when(K.tenant(F.col("header_tenant"), F.col("body_tenant")).isNull(), "missing_tenant").when(F.col("user_id").isNull(), "missing_user").when(F.try_element_at("payload", F.lit("email")).isNull(), "missing_email")
    return messages.select("operation_id", reason.alias("reason")).where("reason IS NOT NULL")


def flat(records: DataFrame) -> DataFrame:
    """The flat warehouse form: no ``pii_fields``, and ``encrypted_pii`` of base64 text as bytes."""
    out = records.drop("pii_fields")
    return out.withColumn("encrypted_pii", F.unbase64("encrypted_pii")) if dict(out.dtypes)["encrypted_pii"] == "string" else out


def wire(records: DataFrame) -> DataFrame:
    """The form in which records travel as text: bytes are base64, within ``pii_fields`` too."""
    as_text = F.transform("pii_fields", lambda x: F.struct(x["field_name"].alias("field_name"), x["token"].alias("token"), crypto.base64_line(x["encrypted_value"]).alias("encrypted_value")))
    return records.withColumn("encrypted_pii", crypto.base64_line(F.col("encrypted_pii"))).withColumn("pii_fields", as_text)
