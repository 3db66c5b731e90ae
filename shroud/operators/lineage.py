"""Lineage events as rows: where each user's data went. Values never appear, only names and counts."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import StringType

from shroud.functions.text import REDACTED, SENSITIVE, redact

#: Users that stand for jobs, not people: each holds a large share of all events.
JOB_USERS = ("BATCH_JOB", "UNKNOWN")


def context_json(operation_id: Column, event_type: Column, metadata: Column, numbers: Column | None = None) -> Column:
    """operation_id, event_type and dataClassification (PII by default), then the redacted metadata, which may override them, as JSON. ``numbers``, a map to whole numbers, comes last, as numbers."""
    safe = redact(metadata)
    base = F.map_from_arrays(F.array(F.lit("operation_id"), F.lit("event_type"), F.lit("dataClassification")), F.array(operation_id, event_type, F.coalesce(F.try_element_at(safe, F.lit("dataClassification")), F.lit("PII"))))
    kept = F.map_filter(base, lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(safe), k), F.lit(False)))
    text = F.to_json(F.map_concat(kept, F.coalesce(safe, F.create_map().cast("map<string,string>"))))
    if numbers is None:
        return text
    shown = F.transform(F.map_entries(redact(numbers)), lambda e: F.concat(F.lit(',"'), e["key"], F.lit('":'), F.when(e["value"] == REDACTED, F.lit(f'"{REDACTED}"')).otherwise(e["value"])))
    return F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.array_join(shown, ""), F.lit("}"))


def event(tenant: Column, user: Column, source: Column, destination: Column, event_type: Column, operation_id: Column, metadata: Column, numbers: Column | None = None) -> list[Column]:
    """The columns of an event in its stored form; the time is in microseconds."""
    return [
        F.expr("uuid()").alias("event_id"), tenant.alias("tenant_id"), user.alias("user_id"), source.alias("source"), destination.alias("destination"),
        event_type.alias("event_type"), F.unix_micros(F.current_timestamp()).alias("timestamp"), context_json(operation_id, event_type, metadata, numbers).alias("context"),
    ]


def row_events(records: DataFrame, source: str | Column, topic: str) -> DataFrame:
    """Two events for each written record: DATA_ENCRYPTED and DATA_PROVISIONED_TO_SINK."""
    none = F.lit(None).cast("string")
    kind = lambda event_type, source, destination, key_id, sync_type: F.struct(F.lit(event_type).alias("event_type"), source.alias("source"), F.lit(destination).alias("destination"), key_id.alias("key_id"), sync_type.alias("sync_type"))
    kinds = F.array(
        kind("DATA_ENCRYPTED", F.lit(source) if isinstance(source, str) else source, "ingestion_pipeline", F.col("key_id"), none),
        kind("DATA_PROVISIONED_TO_SINK", F.lit(topic), "hubspot", none, F.lit("initial_load")),
    )
    rows = records.select("tenant_id", "user_id", "operation_id", "key_id", F.explode(kinds).alias("e"))
    given = F.when(F.col("e.sync_type").isNull(), F.create_map(F.lit("key_id"), F.col("e.key_id"))).otherwise(F.create_map(F.lit("sync_type"), F.col("e.sync_type")))
    return rows.select(*event(F.col("tenant_id"), F.col("user_id"), F.col("e.source"), F.col("e.destination"), F.col("e.event_type"), F.col("operation_id"), given))


def batch_events(figures: DataFrame, topic: str) -> DataFrame:
    """DATA_READ and DATA_PUBLISHED_TO_TOPIC of each row of figures: tenant_id, operation_id, source, rows_read, records_published."""
    kind = lambda event_type, source, destination, what, n: F.struct(F.lit(event_type).alias("event_type"), source.alias("source"), destination.alias("destination"), F.create_map(F.lit(what), F.col(n).cast("long")).alias("numbers"))
    kinds = F.array(
        kind("DATA_READ", F.col("source"), F.lit("ingestion_pipeline"), "file_size_rows", "rows_read"),
        kind("DATA_PUBLISHED_TO_TOPIC", F.lit("ingestion_pipeline"), F.lit(topic), "record_count", "records_published"),
    )
    rows = figures.select("tenant_id", "operation_id", F.explode(kinds).alias("e"))
    none = F.create_map().cast("map<string,string>")
    return rows.select(*event(F.col("tenant_id"), F.lit(JOB_USERS[0]), F.col("e.source"), F.col("e.destination"), F.col("e.event_type"), F.col("operation_id"), none, F.col("e.numbers")))


def batch_figures(read: DataFrame, published: DataFrame, by: tuple[str, ...] = ("tenant_id",)) -> DataFrame:
    """rows_read and records_published of a batch, for each tenant, or file."""
    reads = read.groupBy(*by).agg(F.count("*").alias("rows_read"))
    writes = published.groupBy(*by).agg(F.count("*").alias("records_published"))
    return reads.join(writes, list(by), "left").select(*by, "rows_read", F.coalesce("records_published", F.lit(0)).cast("long").alias("records_published"))


def job_event(event_type: str, tenant_id: str, source: str, destination: Column, classification: str, operation_id: Column, details: Column) -> list[Column]:
    """The columns of an event that no single user stands for, in the shape in which it is reported: its details are JSON, its time is ISO text."""
    return [
        F.lit(event_type).alias("event_type"), F.lit(JOB_USERS[1]).alias("user_id"), F.lit(tenant_id).alias("tenant_id"), F.lit(source).alias("source"), destination.alias("destination"),
        F.lit(classification).alias("data_classification"), operation_id.alias("operation_id"), details.alias("metadata"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
    ]


def finding_events(findings: DataFrame, tenant_id: str, source: str = "bigquery_ghost_data_scanner") -> DataFrame:
    """GHOST_DATA_DETECTED of each finding (resource_id, system, destination, column_name, pattern, findings): names and counts only."""
    details = F.to_json(F.struct(
        "resource_id", "system", F.col("column_name").alias("column"), "pattern", F.col("findings").alias("count"), F.lit("PATTERN_MATCH").alias("confidence"), F.lit(source).alias("scanner"),
        F.lit("declare_in_pii_registry_or_remove_from_resource").alias("recommended_action"),
    ))
    destination = F.coalesce("destination", "resource_id")
    return findings.select(*job_event("GHOST_DATA_DETECTED", tenant_id, source, destination, "GHOST_DATA", F.concat(F.lit("ghost-scan:"), "resource_id"), details))


def table_events(diffs: DataFrame, tenant_id: str, source: str = "bigquery_metadata_crawler") -> DataFrame:
    """WAREHOUSE_METADATA_DISCOVERED of each crawled table (output of the drift crawl)."""
    details = F.to_json(F.struct(
        "resource_id", F.lit("bigquery").alias("system"), F.col("table_catalog").alias("project_id"), F.col("table_schema").alias("dataset_id"), F.col("table_name").alias("table_id"), "table_type",
        F.col("status").alias("registry_status"), "column_count", "new_columns", F.col("missing_columns").alias("missing_registry_columns"), "recommended_action",
    ))
    operation = F.concat(F.lit("metadata-crawl:"), F.concat_ws(".", "table_catalog", "table_schema", "table_name"))
    return diffs.select(*job_event("WAREHOUSE_METADATA_DISCOVERED", tenant_id, source, F.col("resource_id"), "METADATA", operation, details))


def discovery_events(resources: DataFrame, tenant_id: str, source: str = "pii_discovery") -> DataFrame:
    """WAREHOUSE_METADATA_DISCOVERED of each resource that discovery tables name; ``source`` is the name of whatever filled them."""
    details = F.to_json(F.struct(
        "resource_id", F.lit("bigquery").alias("system"), "project_id", "dataset_id", "table_id", F.lit("UNREGISTERED").alias("registry_status"), F.col("field_names").alias("new_columns"), "classifications",
        F.lit("declare_in_dbt_meta_pii_or_console").alias("recommended_action"),
    ))
    return resources.select(*job_event("WAREHOUSE_METADATA_DISCOVERED", tenant_id, source, F.col("resource_id"), "METADATA", F.concat(F.lit("dbt-pii-discovery:"), "resource_id"), details))


def message_events(messages: DataFrame, destination: str, *keep: str) -> DataFrame:
    """INGESTION of each single message, with the sorted names of its payload's keys; columns to ``keep`` come first."""
    return messages.select(*keep, "user_id", F.lit("pii-ingestor-worker").alias("source"), F.lit(destination).alias("destination"), "operation_id", F.lit("INGESTION").alias("event_type"), F.array_sort(F.map_keys("payload")).alias("payload_keys"))


def destinations(events: DataFrame) -> DataFrame:
    """Sorted distinct destinations of each (tenant, user). Users that stand for jobs are left out before the shuffle."""
    people = events.where(~F.col("user_id").isin(*JOB_USERS))
    return people.groupBy("tenant_id", "user_id").agg(F.array_sort(F.collect_set("destination")).alias("destinations"))


_SENSITIVE_KEY = re.compile("|".join(SENSITIVE), re.IGNORECASE)


def _redact_object(pairs: list[tuple]) -> dict:
    """An object as it is parsed, innermost first, without what its sensitive keys hold."""
    return {k: REDACTED if _SENSITIVE_KEY.search(k) else v for k, v in pairs}


@pandas_udf(StringType())
def redact_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """JSON text of any depth without what sensitive keys hold; text that isn't JSON is redacted as a whole."""

    def one(text):
        try:
            return text and json.dumps(json.loads(text, object_pairs_hook=_redact_object), ensure_ascii=False)
        except ValueError:
            return REDACTED

    for part in texts:
        yield part.map(one)
