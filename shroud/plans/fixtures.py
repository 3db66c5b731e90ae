"""Inputs derived from the given tables, as SQL that Spark and DuckDB read alike.

Each text may use the given tables and the texts above it. ``frame`` gives one as a DataFrame,
``ctes`` the same ones as the head of a DuckDB query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents".split()

USERS = """
SELECT CAST(c_custkey AS VARCHAR(20)) AS user_id,
       concat('t', CAST(c_nationkey % 5 AS VARCHAR(20))) AS tenant_id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 13 = 0 THEN 'not-an-email'
            ELSE concat('user', CAST(c_custkey AS VARCHAR(20)), '@mail.example.com') END AS email,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            ELSE concat('+1 415 555 ', lpad(CAST(c_custkey % 10000 AS VARCHAR(20)), 4, '0')) END AS phone,
       c_mktsegment AS plan
FROM customer
"""

KEYS = """
SELECT tenant_id, user_id, 'v1' AS key_id, 'v2' AS encryption_version,
       sha256(concat('dek:', tenant_id, ':', user_id)) AS dek_hex,
       CASE WHEN CAST(user_id AS BIGINT) % 17 = 0 THEN 'SHREDDED' ELSE 'ACTIVE' END AS status
FROM users WHERE CAST(user_id AS BIGINT) % 19 <> 0
"""

LIVE = "SELECT * FROM keys WHERE status = 'ACTIVE'"

FIELDS = """
SELECT tenant_id, user_id, 'email' AS field_name, email AS value, plan FROM users WHERE email IS NOT NULL
UNION ALL SELECT tenant_id, user_id, 'phone', phone, plan FROM users WHERE phone IS NOT NULL
"""

VAULT_ROWS = """
SELECT tenant_id, user_id, 'bigquery:proj.ds.users' AS resource_id, 'email' AS field_name
FROM users WHERE CAST(user_id AS BIGINT) % 3 = 0
UNION ALL
SELECT tenant_id, user_id, 'bigquery:proj.ds.users', 'phone'
FROM users WHERE CAST(user_id AS BIGINT) % 6 = 0
"""

LINEAGE = """
SELECT concat('e', CAST(event_id AS VARCHAR(20))) AS event_id,
       concat('t', CAST(user_id % 5 AS VARCHAR(20))) AS tenant_id,
       CASE WHEN event_id % 10 = 0 THEN 'BATCH_JOB' ELSE CAST(user_id AS VARCHAR(20)) END AS user_id,
       CASE event_type WHEN 'view' THEN 'ingestion_pipeline' WHEN 'signup' THEN 'hubspot'
            WHEN 'purchase' THEN 'bigquery:proj.ds.raw_users' WHEN 'error' THEN 'archive' ELSE 'topic' END AS destination,
       CASE event_type WHEN 'view' THEN 'DATA_READ' WHEN 'signup' THEN 'DATA_PROVISIONED_TO_SINK'
            WHEN 'purchase' THEN 'INGESTION' WHEN 'error' THEN 'GHOST_DATA_DETECTED' ELSE 'DATA_ENCRYPTED' END AS event_type,
       ts
FROM events
"""

CATALOG_COLUMNS = """
SELECT DISTINCT 'proj' AS table_catalog, concat('ds', CAST(p_size % 4 AS VARCHAR(20))) AS table_schema,
       concat('tbl', CAST(p_partkey % 29 AS VARCHAR(20))) AS table_name,
       concat('col', CAST(p_partkey % 7 AS VARCHAR(20))) AS column_name,
       CAST(p_partkey % 7 AS INT) AS ordinal_position,
       CASE WHEN p_partkey % 7 < 3 THEN 'YES' ELSE 'NO' END AS is_nullable
FROM part
"""

CATALOG_TABLES = """
SELECT DISTINCT table_catalog, table_schema, table_name,
       CASE WHEN table_name LIKE '%3' THEN 'VIEW' WHEN table_name LIKE '%6' THEN 'EXTERNAL' ELSE 'BASE TABLE' END AS table_type
FROM catalog_columns
"""

SYNC_RESOURCES = """
SELECT r_regionkey AS k,
       CASE r_regionkey WHEN 0 THEN 'bigquery:proj.crm.users' WHEN 1 THEN 'bigquery:broken' WHEN 2 THEN 'bigquery:proj.crm.gone' WHEN 3 THEN 'gcs:bucket' ELSE 'bigquery:proj.crm.phones' END AS resource_id,
       CASE WHEN r_regionkey = 4 THEN 'phone' ELSE 'email' END AS declared,
       CASE WHEN r_regionkey = 0 THEN 'changed_at' END AS updated_column
FROM region
"""

REGISTRY_COLUMNS = """
SELECT DISTINCT concat('bigquery:', table_catalog, '.', table_schema, '.', table_name) AS resource_id,
       CASE WHEN column_name = 'col3' AND table_name LIKE '%1' THEN 'gone' ELSE column_name END AS column_name
FROM catalog_columns WHERE table_name NOT LIKE '%5'
"""

CELLS = {
    "spark": "SELECT doc_id, lang, source, explode(split(text, ' ', -1)) AS token FROM documents",
    "duckdb": "SELECT doc_id, lang, source, unnest(string_split(text, ' ')) AS token FROM documents",
}

PROFILES = """
SELECT c_custkey AS id, concat('t', CAST(c_nationkey % 5 AS VARCHAR(20))) AS tenant_id,
       CASE c_custkey % 5 WHEN 0 THEN concat(' user', CAST(c_custkey AS VARCHAR(20)), '@mail.example.com ')
            WHEN 1 THEN concat('+44 20 7946 ', lpad(CAST(c_custkey % 10000 AS VARCHAR(20)), 4, '0'))
            WHEN 2 THEN 'Ada Lovelace' WHEN 3 THEN NULL ELSE c_mktsegment END AS notes,
       CASE WHEN c_custkey % 4 = 0 THEN 'Grace Hopper' WHEN c_custkey % 4 = 1 THEN concat(c_name, '@shop') ELSE '12345' END AS remark,
       CASE WHEN c_custkey % 9 = 0 THEN concat('user', CAST(c_custkey AS VARCHAR(20)), '@mail.example.com') END AS email,
       c_acctbal AS balance
FROM customer
"""

SYNC_SOURCE = """
SELECT event_id, CAST(user_id AS VARCHAR(20)) AS user_id, concat('t', CAST(user_id % 5 AS VARCHAR(20))) AS tenant_id,
       concat('u', CAST(user_id AS VARCHAR(20)), '.', event_type, '@mail.example.com') AS email, ts AS updated_at
FROM events
"""

REGISTRY_RAW = """
SELECT s_suppkey AS k,
       CASE WHEN s_suppkey % 3 = 0 THEN concat('bigquery:proj.ds', CAST(s_suppkey % 4 AS VARCHAR(20)), '.tbl', CAST(s_suppkey AS VARCHAR(20))) END AS resource_camel,
       CASE WHEN s_suppkey % 3 = 1 THEN concat('gcs:bucket/p', CAST(s_suppkey AS VARCHAR(20))) END AS resource_snake,
       CASE WHEN s_suppkey % 3 = 2 THEN concat('crm', CAST(s_suppkey AS VARCHAR(20))) END AS resource_plain,
       CASE WHEN s_suppkey % 5 = 0 THEN 'bigquery' END AS system_given,
       CASE WHEN s_suppkey % 7 = 0 THEN 'custom' END AS type_given,
       CASE WHEN s_suppkey % 2 = 0 THEN 'tenant_id' END AS tenant_column,
       CASE WHEN s_suppkey % 4 <> 1 THEN 'user_id' END AS user_column,
       CASE WHEN s_suppkey % 6 = 1 THEN TRUE END AS scoped_given,
       CASE WHEN s_suppkey % 2 = 0 THEN 'manual' ELSE 'crm' END AS owner,
       CASE s_suppkey % 8 WHEN 0 THEN 'ENCRYPTED_COPY' WHEN 1 THEN '' END AS strategies_given,
       CASE s_suppkey % 8 WHEN 1 THEN 'SHADOW_COPY' WHEN 2 THEN 'REDACT_IN_PLACE' WHEN 3 THEN 'NONE' END AS strategy_legacy,
       (s_suppkey % 3 = 0) AS scan_enabled,
       CASE WHEN s_suppkey % 9 = 0 THEN 'full' END AS scan_mode,
       CASE WHEN s_suppkey > 3 THEN '7' END AS version_given,
       CASE WHEN s_suppkey % 4 = 2 THEN 'updated_at' END AS updated_column,
       CASE WHEN s_suppkey % 4 = 3 THEN 'phone' ELSE 'email' END AS declared
FROM supplier
"""

MODELS = """
SELECT p_partkey AS k, concat('model.proj.m', CAST(p_partkey AS VARCHAR(20))) AS node_id,
       CASE WHEN p_partkey % 6 = 5 THEN 'test' ELSE 'model' END AS resource_type,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'proj' END AS database_name,
       concat('ds', CAST(p_size % 4 AS VARCHAR(20))) AS schema_name,
       CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN concat('tbl', CAST(p_partkey % 29 AS VARCHAR(20))) END AS alias,
       CASE WHEN p_partkey % 5 = 0 THEN concat('mart_m', CAST(p_partkey % 29 AS VARCHAR(20))) ELSE concat('tbl', CAST(p_partkey % 29 AS VARCHAR(20))) END AS name,
       CASE WHEN p_partkey % 8 = 0 THEN concat('models/marts/m', CAST(p_partkey AS VARCHAR(20)), '.sql') ELSE 'models/staging/s.sql' END AS path,
       CASE WHEN p_partkey % 10 = 0 THEN 'marts' ELSE 'staging' END AS folder,
       (p_partkey % 2 = 0) AS has_tenant, (p_partkey % 3 <> 2) AS has_user, (p_partkey % 4 < 3) AS has_email,
       (p_partkey % 7 = 0) AS approved
FROM part
"""

MODEL_REGISTRY = """
SELECT row_number() OVER (ORDER BY resource_id DESC) AS pos, resource_id,
       (resource_id LIKE '%1' OR resource_id LIKE '%2') AS tenant_scoped,
       CASE WHEN resource_id NOT LIKE '%2' THEN 'tenant_id' END AS tenant_column,
       CASE WHEN resource_id LIKE '%3' OR resource_id LIKE '%4' THEN 'CRYPTO_SHRED' WHEN resource_id LIKE '%6' THEN 'MANUAL_REVIEW' ELSE 'DELETE' END AS deletion_strategy,
       CASE WHEN resource_id LIKE '%13' THEN 'Documented Exception' WHEN resource_id LIKE '%7' THEN 'Manual steps' END AS handling_policy,
       CASE WHEN resource_id LIKE '%24' THEN 'exception:ticket-1' ELSE 'doc:policy' END AS evidence,
       (resource_id LIKE '%8') AS email_in_mart
FROM (SELECT DISTINCT resource_id FROM registry_columns
      UNION SELECT DISTINCT concat('bigquery:', table_schema, '.', table_name) FROM catalog_columns WHERE table_name LIKE '%9') AS every_id
"""

DISCOVERY = """
SELECT p_partkey AS pos, concat('bigquery:proj.ds', CAST(p_size % 4 AS VARCHAR(20)), '.tbl', CAST(p_partkey % 29 AS VARCHAR(20))) AS resource_id,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'proj' END AS table_catalog, concat('ds', CAST(p_size % 4 AS VARCHAR(20))) AS table_schema,
       concat('tbl', CAST(p_partkey % 29 AS VARCHAR(20))) AS table_name, concat('f', CAST(p_partkey % 4 AS VARCHAR(20))) AS field_name,
       CASE WHEN p_partkey % 3 = 0 THEN 'DIRECT_IDENTIFIER' ELSE 'ENCRYPTED_PII' END AS classification,
       CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 6 = 1 THEN 'DECLARED' END AS confidence,
       CASE WHEN p_partkey % 4 = 0 THEN 'META' END AS detection_method
FROM part
"""

_ORDER = ["users", "keys", "live", "fields", "vault_rows", "lineage", "catalog_columns", "catalog_tables", "registry_columns", "sync_resources", "cells", "profiles", "sync_source", "registry_raw", "models", "model_registry", "discovery"]
_TEXTS = {name: globals()[name.upper()] for name in _ORDER}


def _needed(names: tuple[str, ...], engine: str) -> list[tuple[str, str]]:
    wanted, out = set(names), []
    for name in reversed(_ORDER):
        if name in wanted:
            text = _TEXTS[name] if isinstance(_TEXTS[name], str) else _TEXTS[name][engine]
            wanted |= {n for n in _ORDER[: _ORDER.index(name)] if re.search(rf"\b{n}\b", text)}
            out.append((name, text))
    return out[::-1]


def ctes(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for DuckDB."""
    return "WITH " + ",\n".join(f"{name} AS ({text.strip()})" for name, text in _needed(names, "duckdb")) + "\n"


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input, or a given table, as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = _needed((name,), "spark")
    used = [t for t in TABLES if any(re.search(rf"\b{t}\b", text) for _, text in parts)]
    given = [(t, f"SELECT * FROM parquet.`{sf_dir}/{t}.parquet`") for t in used]
    texts = ", ".join(f"{n} AS ({re.sub(r'sha256[(](.*)[)] AS', r'sha2(\1, 256) AS', text)})" for n, text in [*given, *parts])
    return spark.sql(f"WITH {texts} SELECT * FROM {name}")
