"""Queries of registry, vault sync, encrypted copies, scans, drift, discovery, policy and lineage."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions import crypto, text
from shroud.operators import catalog_drift as D
from shroud.operators import discovery as V
from shroud.operators import encrypted_copy as C
from shroud.operators import ghost_scan as G
from shroud.operators import keys as K
from shroud.operators import lineage as L
from shroud.operators import policy as Y
from shroud.operators import sync_run as R
from shroud.operators.sync_state import SyncState
from shroud.operators import vault_sync as S
from shroud.plans.fixtures import ctes, frame
from shroud.plans.protection import HELD
from shroud.plans.support import RESOURCE, classify_sql, hmac_sql, key_table, work_dir, written
from shroud.sources import manifest, registry, sinks

SYNCED = dt.datetime(2024, 1, 15)
EXCLUDE = ["*7", "ds1.tbl?", "tbl2[0-3]", "ds[!023].tbl1?"]
_JOIN = lambda c: F.array_join(c, ",")


# --- registry ---


def _resources(spark, sf):
    """Registry documents written as JSON lines and read back."""
    k = F.col("k")
    email = F.struct(F.lit("email").alias("name"), F.lit("DIRECT_IDENTIFIER").alias("classification"), F.lit("ENCRYPT").alias("handling"))
    plan = F.struct(F.lit("plan").alias("name"), F.lit("SYSTEM_METADATA").alias("classification"), F.lit(None).cast("string").alias("handling"))
    phone = F.struct(F.lit("phone").alias("name"), F.lit("ENCRYPTED_PII").alias("classification"), F.lit("ENCRYPT").alias("handling"), F.lit(True).alias("allowed_in_mart"))
    doc = F.to_json(F.struct(
        F.col("resource_camel").alias("resourceId"), F.col("resource_snake").alias("resource_id"), F.col("resource_plain").alias("id"), F.col("system_given").alias("system"), F.col("type_given").alias("type"),
        F.when(k % 3 == 0, F.col("tenant_column")).alias("tenantIdColumn"), F.when(k % 3 != 0, F.col("tenant_column")).alias("tenant_id_column"), F.col("user_column").alias("userIdColumn"), F.col("scoped_given").alias("tenantScoped"),
        F.col("owner").alias("ownerConnector"), F.when(F.col("declared") == "email", F.array(email, plan)).alias("columns"), F.when(F.col("declared") == "phone", F.array(phone)).alias("piiFields"),
        F.when(F.col("strategies_given") == "", F.array().cast("array<string>")).when(F.col("strategies_given").isNotNull(), F.array("strategies_given", F.lit("SHADOW_COPY"))).alias("sourceRedactionStrategies"), F.col("strategy_legacy").alias("sourceRedactionStrategy"),
        F.struct(F.col("scan_enabled").alias("enabled"), F.col("scan_mode").alias("scanMode"), F.when(k % 2 == 0, F.array(F.lit("EMAIL"))).alias("patterns")).alias("ghostDataScan"),
        F.col("version_given").alias("registryVersion"), F.col("updated_column").alias("updatedAtColumn"),
    ))
    path = work_dir(spark, "registry")
    frame(spark, sf, "registry_raw").select(F.to_json(F.struct(F.col("k").alias("pos"), doc.alias("value"))).alias("value")).write.text(path)
    lines = spark.read.text(path).select(F.from_json("value", "pos long, value string").alias("j")).select("j.*")
    return registry.normalise(registry.parse_resources(lines))


_NORMAL = """(SELECT *, id_ AS id, coalesce(system_given, CASE WHEN contains(id_, ':') THEN split_part(id_, ':', 1) END) AS system,
  coalesce(scoped_given, tenant_column IS NOT NULL) AS tenant_scoped,
  CASE WHEN strategies_given = '' THEN '' WHEN strategies_given IS NOT NULL THEN 'ENCRYPTED_COPY,SHADOW_COPY' WHEN strategy_legacy IS NOT NULL AND strategy_legacy <> 'NONE' THEN strategy_legacy ELSE '' END AS strategies
  FROM (SELECT *, coalesce(resource_camel, resource_snake, resource_plain) AS id_ FROM registry_raw))"""
_TYPE = "coalesce(type_given, CASE WHEN system = 'bigquery' THEN 'bigquery_table' WHEN system = 'gcs' THEN 'gcs_prefix' ELSE coalesce(system, 'external') END)"


def src_registry(spark, sf):
    r = _resources(spark, sf)
    return r.select("id", "type", "system", "tenant_scoped", "tenant_id_column", "user_id_column", "owner_connector", "registry_version", "updated_at_column", F.col("scan.enabled").alias("scan_enabled"), F.col("scan.scan_mode").alias("scan_mode"), _JOIN("scan.patterns").alias("patterns"))


def src_registry_version(spark, sf):
    return registry.version(_resources(spark, sf))


def prj_encrypted_fields(spark, sf):
    return registry.columns_of(_resources(spark, sf)).where("handling = 'ENCRYPT'").select("resource_id", F.col("position").cast("long").alias("position"), "name", "allowed_in_mart")


def prj_redaction(spark, sf):
    return _resources(spark, sf).select("id", _JOIN("redaction_strategies").alias("strategies"))


def prj_registry_filters(spark, sf):
    """Each filter over registry documents; a resource that several filters keep has a row for each."""
    r = _resources(spark, sf)
    parts = {"type": r.where("type = 'bigquery_table'"), "system": r.where("system = 'gcs'"), "owner": r.where("owner_connector = 'manual'"), "scan": registry.scan_enabled(r, "bigquery"), "copy": registry.wants_encrypted_copy(r)}
    rows = [p.select(F.lit(name).alias("filter"), "id") for name, p in parts.items()] + [registry.direct_identifiers(r).select(F.lit("direct").alias("filter"), F.col("resource_id").alias("id"))]
    return reduce(DataFrame.unionByName, rows)


def src_registry_file(spark, sf):
    """A registry file of its own: an object with a version and all resources."""
    doc = F.struct((F.max("k") + 3).cast("string").alias("version"), F.sort_array(F.collect_list(F.struct(F.coalesce("resource_camel", "resource_snake", "resource_plain").alias("id")))).alias("resources"))
    path = work_dir(spark, "registry-file")
    frame(spark, sf, "registry_raw").agg(F.to_json(doc).alias("value")).write.text(path)
    documents = registry.read_documents(spark, path)
    return registry.file_version(documents).crossJoin(documents.agg(F.count("*").alias("resources")))  # one row each


def inc_skip_reasons(spark, sf):
    return S.skip_reasons(_resources(spark, sf))


# --- vault sync ---


def _vault(spark, sf):
    """Vault rows of what is already synced."""
    keys = frame(spark, sf, "keys")
    fields = frame(spark, sf, "fields").join(frame(spark, sf, "vault_rows"), ["tenant_id", "user_id", "field_name"]).drop("plan")
    path = work_dir(spark, "vault")
    sinks.append_vault(S.vault_records(fields, keys), path)
    return spark.read.parquet(path), path


def inc_changed_users(spark, sf):
    return S.changed_users(frame(spark, sf, "sync_source"), "user_id", "updated_at", SYNCED)


def inc_new_records(spark, sf):
    """The whole sync of one resource: diff, keys for users without one, encryption, append; a second run adds nothing. A new user's token is random, so only whether it fits is shown."""
    old, source = frame(spark, sf, "keys"), frame(spark, sf, "users")
    keys, (vault, path) = key_table(old), _vault(spark, sf)
    for _ in range(2):
        vault = spark.read.parquet(path)
        sinks.append_vault(written(S.sync(source, vault, keys, RESOURCE, ["email", "phone"], "t0"), "synced"), path)
    rows = spark.read.parquet(path).join(K.live(keys.read()).select(*K.KEY, "dek_hex"), K.KEY).join(old.select(*K.KEY, F.lit(True).alias("known")), K.KEY, "left")
    opened = crypto.open_vault_value(F.col("encrypted_value"), F.col("dek_hex"), F.col("user_id"))
    fits = crypto.token(opened, F.col("dek_hex")) == F.col("token")
    return rows.select("tenant_id", "user_id", "resource_id", "field_name", "key_id", F.when(F.col("known"), F.col("token")).alias("token"), fits.alias("fits"), opened.alias("opened"))


def inc_sync_run(spark, sf):
    """Two runs over declared resources: good ones, a bad id, one that vanished, another system. The second run reads what changed since the first, and nobody's field twice."""
    docs = frame(spark, sf, "sync_resources")
    column = F.struct(F.col("declared").alias("name"), F.lit("ENCRYPTED_PII").alias("classification"), F.lit("ENCRYPT").alias("handling"))
    doc = F.struct(F.col("resource_id").alias("resourceId"), F.lit("tenant").alias("tenantIdColumn"), F.lit("customer_key").alias("userIdColumn"), F.lit("manual").alias("ownerConnector"), F.array(column).alias("columns"), F.col("updated_column").alias("updatedAtColumn"))
    resources = registry.normalise(registry.parse_resources(docs.select(F.col("k").cast("long").alias("pos"), F.to_json(doc).alias("value"))))
    n, keys, vault = F.col("user_id").cast("long"), key_table(frame(spark, sf, "keys")), work_dir(spark, "run-vault")
    late = n % 10 == 3
    users = frame(spark, sf, "users").select(F.col("tenant_id").alias("tenant"), n.alias("customer_key"), "email", "phone", F.when(late, F.lit("2100-01-01")).otherwise("2024-01-01").cast("timestamp").alias("changed_at"))

    def source(number):
        def of(resource_id):
            if resource_id.endswith("gone"):
                raise FileNotFoundError(resource_id)
            return users if number else users.where("changed_at < TIMESTAMP '2050-01-01'")

        return of

    state, out = SyncState(spark, work_dir(spark, "state")), []
    for number in range(2):
        results = R.Run(spark, source(number), keys, vault, "t0", state).all(resources)
        held = written(spark.read.parquet(vault).groupBy("resource_id").agg(F.count("*").alias("fields")), "held")
        out.append(results.join(held, "resource_id", "left").select(F.lit(number).cast("long").alias("run"), "resource_id", "status", "reason", "units", F.coalesce("fields", F.lit(0)).cast("long").alias("fields")))
    return out[0].unionByName(out[1])


def inc_sync_one(spark, sf):
    """A run of one resource at a time: of another owner, not declared, and skipped ones."""
    resources = _resources(spark, sf)
    run = R.Run(spark, lambda resource_id: frame(spark, sf, "users"), key_table(frame(spark, sf, "keys")), work_dir(spark, "one-vault"), "t0", SyncState(spark, work_dir(spark, "state")))
    first = resources.where("owner_connector = 'crm'").agg(F.min("id")).first()[0]
    none = resources.where("owner_connector = 'manual' AND (system IS NULL OR system <> 'bigquery')").agg(F.min("id")).first()[0]
    return reduce(DataFrame.unionByName, [run.one(resources, i) for i in (first, none, "bigquery:a.b.nowhere")]).select("resource_id", "status", "reason", "units")


def inc_latest_value(spark, sf):
    """One row per natural key: of repeated users the latest row counts."""
    return S.long_fields(frame(spark, sf, "sync_source"), "bigquery:proj.ds.events", ["email"], "t0", "updated_at")


def joi_not_yet_synced(spark, sf):
    fields = frame(spark, sf, "fields").withColumn("resource_id", F.lit(RESOURCE)).select(*S.NATURAL_KEY, "value")
    return S.not_yet_synced(fields, frame(spark, sf, "vault_rows"))


def joi_reread_users(spark, sf):
    wanted = frame(spark, sf, "vault_rows").where("field_name = 'phone'").select("user_id")
    return S.reread(frame(spark, sf, "customer"), wanted, "c_custkey").select("c_custkey", "c_name")


def win_work_units(spark, sf):
    users = frame(spark, sf, "users").select(F.concat(F.lit("bigquery:proj.ds."), "tenant_id").alias("resource_id"), "user_id")
    return S.work_units(users).select("resource_id", "unit", F.size("user_ids").cast("long").alias("n"), _JOIN("user_ids").alias("user_ids"))


def _runs(spark, sf):
    n = F.col("p_partkey")
    return frame(spark, sf, "part").select(
        F.concat(F.lit("run"), (n % 11).cast("string")).alias("run_id"), F.concat(F.lit("res"), (n % 7).cast("string")).alias("resource_id"),
        F.when(n % 13 == 0, "ERROR").when(n % 5 == 0, "FAILED").when(n % 3 == 0, "QUEUED").otherwise("COMPLETED").alias("status"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n % 1000).cast("decimal(18,6)"))).alias("started_at"), (n % 4 != 0).alias("succeeded"), F.when(n % 7 != 3, F.lit("updated_at")).alias("updated_at_column"),
    )


_RUNS = """(SELECT concat('run', CAST(p_partkey % 11 AS VARCHAR)) AS run_id, concat('res', CAST(p_partkey % 7 AS VARCHAR)) AS resource_id,
  CASE WHEN p_partkey % 13 = 0 THEN 'ERROR' WHEN p_partkey % 5 = 0 THEN 'FAILED' WHEN p_partkey % 3 = 0 THEN 'QUEUED' ELSE 'COMPLETED' END AS status,
  TIMESTAMP '2024-01-01' + to_seconds(p_partkey % 1000) AS started_at, p_partkey % 4 <> 0 AS succeeded, CASE WHEN p_partkey % 7 <> 3 THEN 'updated_at' END AS updated_at_column FROM part)"""


def inc_advance(spark, sf):
    state = spark.range(9).select(F.concat(F.lit("res"), F.col("id").cast("string")).alias("resource_id"), F.when(F.col("id") % 2 == 0, F.lit(dt.datetime(2024, 1, 1, 0, 10))).when(F.col("id") == 5, F.lit(dt.datetime(2025, 1, 1))).alias("last_synced_at"), F.lit(None).cast("timestamp").alias("last_attempt_at"))
    out = S.advance(state, _runs(spark, sf))
    return out.select("resource_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("last_synced_at", "last_attempt_at")])


def agg_run_summary(spark, sf):
    return S.run_summary(_runs(spark, sf))


def agg_users_synced(spark, sf):
    return S.users_synced(_vault(spark, sf)[0])


# --- encrypted copies ---


def _copy(spark, sf):
    vault, _ = _vault(spark, sf)
    return written(C.wide_copy(frame(spark, sf, "users"), vault, RESOURCE, ["email", "phone"]), "copy")


def joi_wide_copy(spark, sf):
    rows = _copy(spark, sf).join(K.live(frame(spark, sf, "keys")).select(*K.KEY, "dek_hex"), K.KEY)
    opened = lambda c: crypto.open_vault_value(F.col(c), F.col("dek_hex"), F.col("user_id")).alias(c)
    return rows.select("tenant_id", "user_id", "plan", opened("email"), opened("phone"))


def win_latest_copy(spark, sf):
    return C.latest(frame(spark, sf, "sync_source"), "user_id", ("updated_at", "event_id")).select("user_id", "event_id", "email")


def win_latest_combined(spark, sf):
    return C.latest_combined(frame(spark, sf, "sync_source"), "user_id", ("updated_at", "event_id")).select("user_id", "event_id", "email")


# --- scans ---


def agg_ghost_findings(spark, sf):
    return G.findings(frame(spark, sf, "profiles"), {"email", "tenant_id"})


def sca_enabled_patterns(spark, sf):
    return G.findings(frame(spark, sf, "profiles"), {"tenant_id"}, ["EMAIL", "NAME"])


def agg_ghost_tokens(spark, sf):
    return G.findings(frame(spark, sf, "cells"), {"lang", "source"})


def agg_ghost_counts_by_column(spark, sf):
    return G.counts_by_column(frame(spark, sf, "profiles"), {"email", "tenant_id"})


def sca_classify(spark, sf):
    return frame(spark, sf, "profiles").select("id", text.classify(F.col("notes")).alias("notes"), text.classify(F.col("remark")).alias("remark"))


def lim_sample(spark, sf):
    return G.findings(G.sampled(frame(spark, sf, "profiles"), limit=200, by="id"), {"email", "tenant_id"})


# --- drift ---


def joi_schema_drift(spark, sf):
    out = D.crawl(frame(spark, sf, "catalog_columns"), frame(spark, sf, "registry_columns"))
    return out.select("resource_id", "status", F.col("column_count").cast("long").alias("column_count"), _JOIN("new_columns").alias("new_columns"), _JOIN("missing_columns").alias("missing_columns"), "recommended_action")


def joi_column_drift(spark, sf):
    return D.column_drift(frame(spark, sf, "catalog_columns"), frame(spark, sf, "registry_columns"))


def agg_crawl_counts(spark, sf):
    return D.status_counts(D.crawl(frame(spark, sf, "catalog_columns"), frame(spark, sf, "registry_columns")))


def srt_catalog(spark, sf):
    return frame(spark, sf, "catalog_columns").groupBy("table_schema", "table_name").agg(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))).alias("c")).select("table_schema", "table_name", _JOIN(F.transform("c", lambda x: x["column_name"])).alias("columns")).orderBy("table_schema", "table_name")


def sca_exclusion(spark, sf):
    t = frame(spark, sf, "catalog_columns").select("table_schema", "table_name").distinct()
    return t.where(~text.excluded(F.col("table_schema"), F.col("table_name"), EXCLUDE))


def sca_column_mode(spark, sf):
    return frame(spark, sf, "catalog_columns").select("table_schema", "table_name", "column_name", D.column_mode(F.col("is_nullable")).alias("mode"))


def prj_table_reference(spark, sf):
    n = F.col("p_partkey") % 4
    rid = F.when(n == 0, F.concat(F.lit("bigquery:a.b.c"), F.col("p_partkey").cast("string"))).when(n == 1, F.lit("bigquery:a.b")).when(n == 2, F.lit("gcs:a.b.c")).otherwise(F.lit("bigquery:a.b.c.d"))
    return frame(spark, sf, "part").select("p_partkey", text.table_reference(rid).alias("t")).select("p_partkey", "t.project", "t.dataset", F.col("t.table").alias("table_name"))


def prj_resource_id(spark, sf):
    return frame(spark, sf, "catalog_columns").select(text.resource_id(F.col("table_catalog"), F.col("table_schema"), F.col("table_name")).alias("resource_id")).distinct()


# --- discovery ---


def _discovery(spark, sf):
    """Rows of two written locations and a missing one, read back as one."""
    rows = frame(spark, sf, "discovery")
    paths = [work_dir(spark, "discovery") for _ in range(3)]
    rows.where("pos % 2 = 0").write.parquet(paths[0])
    rows.where("pos % 2 = 1").write.parquet(paths[2])
    return V.read_locations(spark, paths)


def set_discovery_union(spark, sf):
    return _discovery(spark, sf).select("pos", "location", "resource_id", "field_name")


def agg_discovered_resources(spark, sf):
    g = V.group_resources(_discovery(spark, sf), "default")
    return g.select("resource_id", "project_id", "dataset_id", "table_id", _JOIN("field_names").alias("field_names"), _JOIN(F.array_sort(F.transform(F.map_entries("classifications"), lambda e: F.concat_ws("=", e["key"], e["value"])))).alias("classifications"))


def sca_discovery_defaults(spark, sf):
    return V.with_defaults(_discovery(spark, sf)).groupBy("sure", "method").agg(F.count("*").alias("n"))


def agg_publish_counts(spark, sf):
    return V.publish_counts(_discovery(spark, sf))


def sca_locations(spark, sf):
    n = F.col("p_partkey") % 3
    loc = F.when(n == 0, F.concat(F.lit("proj."), "p_brand")).otherwise(F.col("p_brand"))
    return frame(spark, sf, "part").select("p_partkey", V.location_parts(loc, F.lit("main")).alias("l")).select("p_partkey", "l.*")


def sca_comma_list(spark, sf):
    s = F.concat(F.lit(" a"), F.col("p_size").cast("string"), F.lit(" ,, b,  ,"), "p_brand")
    return frame(spark, sf, "part").select("p_partkey", _JOIN(text.comma_list(s)).alias("items"))


# --- policy ---


def _models(spark, sf):
    """A manifest for each model, written as JSON and read back."""
    col = lambda name, flag: F.when(F.col(flag), F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    names = F.concat(F.array(F.lit("plan")), col("tenant_id", "has_tenant"), col("user_id", "has_user"), col("email", "has_email"))
    columns = F.map_from_arrays(names, F.transform(names, lambda n: F.struct(n.alias("name"))))
    node = F.struct("resource_type", F.col("database_name").alias("database"), F.col("schema_name").alias("schema"), "alias", "name", "path", F.array(F.lit("proj"), F.col("folder"), F.col("name")).alias("fqn"), columns.alias("columns"), F.struct(F.struct(F.col("approved").alias("mart_manual_review_approved")).alias("privacy")).alias("meta"))
    path = work_dir(spark, "manifest")
    frame(spark, sf, "models").select(F.to_json(F.struct(F.map_from_arrays(F.array("node_id"), F.array(node)).alias("nodes"))).alias("value")).write.text(path)
    return manifest.read_models(spark, path, multi_line=False)


def _matched(spark, sf):
    resources = frame(spark, sf, "model_registry").select("pos", "resource_id", "tenant_scoped", "tenant_column", "deletion_strategy", "handling_policy", F.array("evidence").alias("evidence"), F.lit("user_id").alias("user_column"), F.array(F.struct(F.lit("email").alias("name"), F.col("email_in_mart").alias("allowed_in_mart"))).alias("identifiers"))
    return Y.match(_models(spark, sf), resources)


def src_manifest(spark, sf):
    return _models(spark, sf).select("node_id", "name", _JOIN(F.array_sort("columns")).alias("columns"), "approved", _JOIN("candidates").alias("candidates"))


def joi_match_models(spark, sf):
    return _matched(spark, sf).select("node_id", F.col("resource.resource_id").alias("resource_id"))


def sca_mart(spark, sf):
    return _models(spark, sf).select("node_id", Y.is_mart(F.col("name"), F.col("path"), F.array_join("fqn", ".")).alias("mart"))


def pol_all_checks(spark, sf):
    return Y.all_checks(_matched(spark, sf)).groupBy("status", "rule", "name", "message").agg(F.count("*").alias("n"))


def agg_overall_status(spark, sf):
    return Y.overall(Y.all_checks(_matched(spark, sf)))


def pol_evaluations(spark, sf):
    n = F.col("p_partkey")
    issue = lambda k: F.struct(F.when(n % 3 == k, "HIGH").alias("severity"), F.when(n % 4 != k, F.concat(F.lit("C"), (n % 5).cast("string"))).alias("code"), F.when(n % 2 == k, F.lit("email")).alias("field"), F.col("p_brand").alias("message"))
    issues = F.when(n % 6 == 0, F.array().cast("array<struct<severity:string,code:string,field:string,message:string>>")).when(n % 6 == 1, F.array(issue(0))).otherwise(F.array(issue(0), issue(1)))
    docs = frame(spark, sf, "part").select(F.to_json(F.struct(F.array(F.struct(F.when(n % 7 != 0, F.concat(F.lit("res"), n.cast("string"))).alias("resource_id"), F.when(n % 5 != 0, F.lit("FAIL")).alias("status"), issues.alias("issues"))).alias("evaluations"))).alias("j"))
    parsed = docs.select(F.from_json("j", "evaluations array<struct<resource_id:string,status:string,issues:array<struct<severity:string,code:string,field:string,message:string>>>>").alias("p")).select("p.*")
    return Y.flatten_evaluations(parsed)


# --- lineage ---


def agg_destinations(spark, sf):
    return L.destinations(frame(spark, sf, "lineage")).select("tenant_id", "user_id", _JOIN("destinations").alias("destinations"))


def agg_batch_figures(spark, sf):
    users = frame(spark, sf, "users")
    return L.batch_figures(users, K.attach(users, frame(spark, sf, "keys")))


def lin_batch_events(spark, sf):
    figures = agg_batch_figures(spark, sf).withColumns({"operation_id": F.lit("op-1"), "source": F.lit("gs://landing/users.csv")})
    return L.batch_events(figures, "topic").select("tenant_id", "user_id", "source", "destination", "event_type", "context")


def lin_row_events(spark, sf):
    """Events of the records that landing rows became; rows that were dropped have none."""
    from shroud.plans.protection import _records

    return L.row_events(_records(spark, sf), "gs://landing/users.csv", "topic").select("tenant_id", "user_id", "source", "destination", "event_type", "context")


_JOB = ["event_type", "user_id", "tenant_id", "source", "destination", "data_classification", "operation_id", "metadata"]


def lin_finding_events(spark, sf):
    found = agg_ghost_findings(spark, sf).select(F.lit(RESOURCE).alias("resource_id"), F.lit("bigquery").alias("system"), F.lit(None).cast("string").alias("destination"), "*")
    return L.finding_events(found, "t1").select(*_JOB, (F.to_timestamp("timestamp") <= F.current_timestamp()).alias("timed"))


def lin_table_events(spark, sf):
    diffs = D.crawl(frame(spark, sf, "catalog_columns"), frame(spark, sf, "registry_columns"), kinds=frame(spark, sf, "catalog_tables"))
    return L.table_events(diffs, "t1").select(*_JOB, (F.to_timestamp("timestamp") <= F.current_timestamp()).alias("timed"))


def lin_discovery_events(spark, sf):
    return L.discovery_events(V.group_resources(_discovery(spark, sf), "default"), "t1").select(*_JOB)


def lin_message_events(spark, sf):
    from shroud.plans.protection import _messages

    return L.message_events(_messages(spark, sf), "bigquery:proj.ds.raw_users").withColumn("payload_keys", _JOIN("payload_keys"))


def prj_redact(spark, sf):
    made = F.map_from_arrays(F.array(F.lit("User_Email"), F.lit("table_name"), F.lit("rows")), F.array("tenant_id", "event_type", "destination"))
    return frame(spark, sf, "lineage").select("event_id", F.to_json(text.redact(made)).alias("metadata"))


def prj_redact_bytes(spark, sf):
    made = F.map_from_arrays(F.array(F.lit("User_Email"), F.lit("payload")), F.transform(F.array("tenant_id", "destination"), lambda v: F.encode(v, "UTF-8")))
    return frame(spark, sf, "lineage").select("event_id", F.to_json(text.redact(made, of_bytes=True)).alias("metadata"))


def prj_redact_nested(spark, sf):
    doc = F.to_json(F.struct(F.struct(F.col("tenant_id").alias("phone"), F.array(F.struct(F.col("event_type").alias("full_name"), F.col("destination").alias("sink"))).alias("items")).alias("outer"), F.col("user_id").alias("rows")))
    return frame(spark, sf, "lineage").select("event_id", L.redact_json(doc).alias("metadata"))


def sca_context_json(spark, sf):
    meta = F.when(F.col("event_type") == "INGESTION", F.create_map(F.lit("dataClassification"), F.lit("METADATA"), F.lit("event_type"), F.lit("OVERRIDE"))).otherwise(F.create_map(F.lit("rows"), F.lit("3")))
    return frame(spark, sf, "lineage").select("event_id", L.context_json(F.lit("op"), F.col("event_type"), meta).alias("context"))


def sca_stamps(spark, sf):
    return frame(spark, sf, "lineage").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))


def snk_archive(spark, sf):
    path = work_dir(spark, "archive")
    sinks.archive_lineage(frame(spark, sf, "lineage"), path, "r1")
    return spark.read.schema("event_id string, event_type string, date string, run string").json(path).groupBy("run", "date", "event_type").agg(F.count("*").alias("n"))


def snk_vault(spark, sf):
    return _vault(spark, sf)[0].groupBy("resource_id", "field_name").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


_ID_FIELDS = ctes("fields", "vault_rows", "live", "users", "keys")
_SYNCED = "(SELECT f.*, k.dek_hex, k.key_id FROM fields f JOIN vault_rows USING (tenant_id, user_id, field_name) JOIN live k USING (tenant_id, user_id))"


def _ghost(src: str) -> str:
    return f"(SELECT 'notes' AS column_name, {classify_sql('notes')} AS pattern FROM {src} UNION ALL SELECT 'remark', {classify_sql('remark')} FROM {src}"


_PROFILES = ctes("profiles")
_CRAWL = """, tables AS (SELECT concat('bigquery:', table_catalog, '.', table_schema, '.', table_name) AS resource_id, table_catalog, table_schema, table_name, list(column_name ORDER BY ordinal_position, column_name) AS names FROM catalog_columns GROUP BY ALL),
 declared AS (SELECT resource_id, list_sort(list(DISTINCT column_name)) AS declared FROM registry_columns GROUP BY 1),
 crawl AS (SELECT t.*, declared, list_filter(names, lambda c: NOT coalesce(list_contains(declared, c), FALSE)) AS new_columns, coalesce(list_filter(declared, lambda c: NOT list_contains(names, c)), []) AS missing_columns FROM tables t LEFT JOIN declared USING (resource_id)),
 diffs AS (SELECT *, CASE WHEN declared IS NULL THEN 'UNREGISTERED' WHEN len(new_columns) > 0 OR len(missing_columns) > 0 THEN 'DRIFTED' ELSE 'REGISTERED' END AS status FROM crawl)
"""
_CATALOG = ctes("catalog_columns", "registry_columns")
_MATCH = """, made AS (SELECT *, coalesce(nullif(alias, ''), name) AS a FROM models WHERE resource_type = 'model'),
 cand AS (SELECT *, list_filter([concat('bigquery:', database_name, '.', schema_name, '.', a), concat('bigquery:', database_name, '.', schema_name), concat('bigquery:', schema_name, '.', a)], lambda c: TRUE) AS all_three,
   list_filter([CASE WHEN database_name IS NOT NULL THEN concat('bigquery:', database_name, '.', schema_name, '.', a) END, CASE WHEN database_name IS NOT NULL THEN concat('bigquery:', database_name, '.', schema_name) END, concat('bigquery:', schema_name, '.', a)], lambda c: c IS NOT NULL) AS candidates FROM made),
 matched AS (SELECT c.*, r.pos, r.resource_id, r.tenant_scoped, r.tenant_column, r.deletion_strategy, r.handling_policy, r.evidence, r.email_in_mart FROM cand c LEFT JOIN (
   SELECT c.node_id, min(r.pos) AS pos FROM cand c JOIN model_registry r ON list_contains(c.candidates, r.resource_id) GROUP BY 1) m USING (node_id) LEFT JOIN model_registry r ON r.pos = m.pos),
 marts AS (SELECT *, (starts_with(name, 'mart') OR contains(name, '.mart') OR contains(name, '/mart') OR starts_with(path, 'mart') OR contains(path, '.mart') OR contains(path, '/mart') OR contains(concat('proj.', folder, '.', name), '.mart') OR contains(concat('proj.', folder, '.', name), '/mart')) AS mart FROM matched),
 checks AS (
  SELECT 'FAIL' AS status, 'missing_registry_resource' AS rule, name, concat('no registry resource matches ', array_to_string(candidates, ', ')) AS message FROM marts WHERE resource_id IS NULL
  UNION ALL SELECT 'FAIL', 'tenant_id_required', name, concat(resource_id, ' is tenant-scoped but the model lacks ', coalesce(tenant_column, 'tenant_id')) FROM marts WHERE tenant_scoped AND NOT (tenant_column IS NOT NULL AND has_tenant)
  UNION ALL SELECT 'FAIL', 'user_scope_required', name, concat(resource_id, ' uses CRYPTO_SHRED but the model lacks user_id') FROM marts WHERE deletion_strategy = 'CRYPTO_SHRED' AND NOT has_user AND NOT contains(lower(coalesce(handling_policy, '')), 'exception') AND NOT starts_with(evidence, 'exception:')
  UNION ALL SELECT 'FAIL', 'direct_identifier_in_mart', name, concat('mart model exposes direct identifier column email from ', resource_id) FROM marts WHERE mart AND resource_id IS NOT NULL AND has_email AND NOT email_in_mart
  UNION ALL SELECT 'WARN', 'manual_review_required', name, concat(resource_id, ' requires manual review') FROM marts WHERE resource_id IS NOT NULL AND (deletion_strategy = 'MANUAL_REVIEW' OR contains(lower(coalesce(handling_policy, '')), 'manual')) AND NOT approved)
"""
_MODELS = ctes("models", "model_registry") + _MATCH
_DISCOVERED = ctes("discovery") + """, located AS (SELECT *, CASE WHEN pos % 2 = 0 THEN 0 ELSE 2 END AS location FROM discovery),
 listed AS (SELECT resource_id, field_name, min(pos) AS first_pos, arg_max(classification, pos) AS c FROM located GROUP BY 1, 2),
 names AS (SELECT resource_id, list(field_name ORDER BY first_pos) AS names, list(concat('"', field_name, '":"', c, '"') ORDER BY first_pos) AS pairs, string_agg(concat(field_name, '=', c), ',' ORDER BY field_name) AS classifications FROM listed GROUP BY 1),
 grouped AS (SELECT * FROM names JOIN (SELECT resource_id, arg_min(coalesce(table_catalog, 'default'), pos) AS project_id, arg_min(table_schema, pos) AS dataset_id, arg_min(table_name, pos) AS table_id FROM located GROUP BY 1) USING (resource_id))
"""
_EVENT = "CAST(NULL AS VARCHAR)"
_MESSAGE_KEYS = "CASE WHEN email IS NOT NULL THEN 'email,plan' ELSE 'plan' END"

QUERIES = {
    "src_registry": (src_registry, ctes("registry_raw") + f"SELECT id, {_TYPE} AS type, system, tenant_scoped, tenant_column AS tenant_id_column, user_column AS user_id_column, owner AS owner_connector, version_given AS registry_version, updated_column AS updated_at_column, scan_enabled, CASE WHEN scan_mode = 'full' THEN 'FULL' ELSE 'SAMPLED' END AS scan_mode, CASE WHEN k % 2 = 0 THEN 'EMAIL' ELSE '' END AS patterns FROM {_NORMAL}"),
    "src_registry_file": (src_registry_file, ctes("registry_raw") + "SELECT CAST(max(k) + 3 AS BIGINT) AS version, count(*) AS resources FROM registry_raw"),
    "src_registry_version": (src_registry_version, ctes("registry_raw") + "SELECT coalesce(max(version_given), '0') AS version FROM registry_raw"),
    "prj_encrypted_fields": (prj_encrypted_fields, ctes("registry_raw") + f"SELECT id AS resource_id, CAST(0 AS BIGINT) AS position, declared AS name, declared = 'phone' AS allowed_in_mart FROM {_NORMAL}"),
    "prj_redaction": (prj_redaction, ctes("registry_raw") + f"SELECT id, strategies FROM {_NORMAL}"),
    "prj_registry_filters": (prj_registry_filters, ctes("registry_raw") + f"""SELECT 'type' AS filter, id FROM {_NORMAL} WHERE {_TYPE} = 'bigquery_table' UNION ALL SELECT 'system', id FROM {_NORMAL} WHERE system = 'gcs'
      UNION ALL SELECT 'owner', id FROM {_NORMAL} WHERE owner = 'manual' UNION ALL SELECT 'scan', id FROM {_NORMAL} WHERE scan_enabled AND system = 'bigquery' UNION ALL SELECT 'copy', id FROM {_NORMAL} WHERE contains(strategies, 'ENCRYPTED_COPY') UNION ALL SELECT 'direct', id FROM {_NORMAL} WHERE declared = 'email'"""),
    "inc_skip_reasons": (inc_skip_reasons, ctes("registry_raw") + f"SELECT id AS resource_id, CASE WHEN owner <> 'manual' THEN 'other_owner' WHEN system IS NULL OR system <> 'bigquery' THEN 'other_system' WHEN user_column IS NULL THEN 'no_user_column' WHEN NOT regexp_matches(id, '^bigquery:[^.]+\\.[^.]+\\.[^.]+$') THEN 'bad_id' END AS reason FROM {_NORMAL}"),
    "inc_changed_users": (inc_changed_users, ctes("sync_source") + "SELECT DISTINCT user_id FROM sync_source WHERE updated_at >= TIMESTAMP '2024-01-15 00:00:00' AND user_id IS NOT NULL"),
    "inc_new_records": (inc_new_records, ctes("fields", "users", "keys") + f"""SELECT tenant_id, user_id, '{RESOURCE}' AS resource_id, field_name, 'v1' AS key_id, CASE WHEN status IS NOT NULL THEN {hmac_sql('dek_hex', 'value')} END AS token, TRUE AS fits, value AS opened
      FROM fields LEFT JOIN keys USING (tenant_id, user_id) WHERE status IS NULL OR status = 'ACTIVE'"""),
    "inc_sync_run": (inc_sync_run, ctes("sync_resources", "users", "keys") + """, numbered AS (SELECT u.*, CAST(user_id AS BIGINT) % 10 = 3 AS late, coalesce(k.status, 'ACTIVE') AS state FROM users u LEFT JOIN keys k USING (tenant_id, user_id)),
      runs AS (SELECT CAST(0 AS BIGINT) AS run UNION ALL SELECT 1), pairs AS (SELECT * FROM runs, sync_resources),
      reads AS (SELECT p.run, p.resource_id, count(*) AS users FROM pairs p JOIN numbered n ON p.k IN (0, 4) AND CASE WHEN p.run = 0 THEN NOT n.late ELSE p.k = 4 OR n.late END GROUP BY 1, 2),
      units AS (SELECT run, resource_id, CAST(sum(ceil(users / 100.0)) AS BIGINT) AS units FROM reads GROUP BY 1, 2),
      held AS (SELECT p.run, p.resource_id, count(*) AS fields FROM pairs p JOIN numbered n ON n.state = 'ACTIVE' AND (p.run = 1 OR NOT n.late) AND ((p.k = 0 AND n.email IS NOT NULL) OR (p.k = 4 AND n.phone IS NOT NULL)) GROUP BY 1, 2)
      SELECT p.run, p.resource_id, CASE p.k WHEN 1 THEN 'ERROR' WHEN 2 THEN 'ERROR' WHEN 3 THEN 'SKIPPED' ELSE 'SYNCED' END AS status, CASE p.k WHEN 1 THEN 'bad_id' WHEN 2 THEN p.resource_id WHEN 3 THEN 'other_system' END AS reason, coalesce(units, 0) AS units, coalesce(fields, 0) AS fields
      FROM pairs p LEFT JOIN units USING (run, resource_id) LEFT JOIN held USING (run, resource_id)"""),
    "inc_sync_one": (inc_sync_one, ctes("registry_raw") + f"""SELECT min(id) AS resource_id, 'ERROR' AS status, 'other_owner' AS reason, CAST(0 AS BIGINT) AS units FROM {_NORMAL} WHERE owner = 'crm'
      UNION ALL SELECT min(id), 'SKIPPED', 'other_system', 0 FROM {_NORMAL} WHERE owner = 'manual' AND (system IS NULL OR system <> 'bigquery') UNION ALL SELECT 'bigquery:a.b.nowhere', 'ERROR', 'not_declared', 0"""),
    "inc_latest_value": (inc_latest_value, ctes("sync_source") + "SELECT tenant_id, user_id, 'bigquery:proj.ds.events' AS resource_id, 'email' AS field_name, arg_max(email, (updated_at, email)) AS value FROM sync_source GROUP BY 1, 2"),
    "joi_not_yet_synced": (joi_not_yet_synced, _ID_FIELDS + f"SELECT tenant_id, user_id, '{RESOURCE}' AS resource_id, field_name, value FROM fields ANTI JOIN vault_rows USING (tenant_id, user_id, field_name)"),
    "joi_reread_users": (joi_reread_users, ctes("vault_rows") + "SELECT c_custkey, c_name FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT user_id FROM vault_rows WHERE field_name = 'phone')"),
    "win_work_units": (win_work_units, ctes("users") + "SELECT resource_id, unit, count(*) AS n, string_agg(user_id, ',' ORDER BY user_id) AS user_ids FROM (SELECT concat('bigquery:proj.ds.', tenant_id) AS resource_id, user_id, (row_number() OVER (PARTITION BY tenant_id ORDER BY user_id) - 1) // 100 AS unit FROM users) GROUP BY 1, 2"),
    "inc_advance": (inc_advance, f"""SELECT resource_id, strftime(greatest(s.last_synced_at, r.mark), '%Y-%m-%d %H:%M:%S') AS last_synced_at, strftime(r.attempt, '%Y-%m-%d %H:%M:%S') AS last_attempt_at
      FROM (SELECT concat('res', CAST(i AS VARCHAR)) AS resource_id, CASE WHEN i % 2 = 0 THEN TIMESTAMP '2024-01-01 00:10:00' WHEN i = 5 THEN TIMESTAMP '2025-01-01' END AS last_synced_at FROM range(9) t(i)) s
      FULL JOIN (SELECT resource_id, max(started_at) FILTER (succeeded AND updated_at_column IS NOT NULL) AS mark, max(started_at) AS attempt FROM {_RUNS} GROUP BY 1) r USING (resource_id)"""),
    "agg_run_summary": (agg_run_summary, f"SELECT run_id, resource_id, count(*) FILTER (WHERE status <> 'ERROR') AS queued, count(*) FILTER (WHERE status = 'ERROR') AS errors FROM {_RUNS} GROUP BY 1, 2"),
    "agg_users_synced": (agg_users_synced, _ID_FIELDS + f"SELECT '{RESOURCE}' AS resource_id, count(DISTINCT (tenant_id, user_id)) AS users_synced FROM {_SYNCED}"),
    "joi_wide_copy": (joi_wide_copy, _ID_FIELDS + f"SELECT u.tenant_id, u.user_id, u.plan, max(CASE WHEN s.field_name = 'email' THEN s.value END) AS email, max(CASE WHEN s.field_name = 'phone' THEN s.value END) AS phone FROM users u JOIN {_SYNCED} s ON u.tenant_id = s.tenant_id AND u.user_id = s.user_id GROUP BY 1, 2, 3"),
    "win_latest_copy": (win_latest_copy, ctes("sync_source") + "SELECT user_id, event_id, email FROM sync_source QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, event_id DESC) = 1"),
    "win_latest_combined": (win_latest_combined, ctes("sync_source") + "SELECT user_id, event_id, email FROM sync_source QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, event_id DESC) = 1"),
    "agg_ghost_findings": (agg_ghost_findings, _PROFILES + f"SELECT column_name, pattern, count(*) AS findings FROM {_ghost('profiles')}) WHERE pattern IS NOT NULL GROUP BY 1, 2"),
    "sca_enabled_patterns": (sca_enabled_patterns, _PROFILES + f"SELECT column_name, pattern, count(*) AS findings FROM {_ghost('profiles')} UNION ALL SELECT 'email', {classify_sql('email')} FROM profiles) WHERE pattern IN ('EMAIL', 'NAME') GROUP BY 1, 2"),
    "agg_ghost_tokens": (agg_ghost_tokens, ctes("cells") + f"SELECT 'token' AS column_name, pattern, count(*) AS findings FROM (SELECT {classify_sql('token')} AS pattern FROM cells) WHERE pattern IS NOT NULL GROUP BY 2"),
    "agg_ghost_counts_by_column": (agg_ghost_counts_by_column, _PROFILES + "SELECT " + ", ".join(f"count(*) FILTER (WHERE {classify_sql(c)} = '{p}') AS {c}_{p}" for c in ("notes", "remark") for p in text.PATTERNS) + " FROM profiles"),
    "sca_classify": (sca_classify, _PROFILES + f"SELECT id, {classify_sql('notes')} AS notes, {classify_sql('remark')} AS remark FROM profiles"),
    "lim_sample": (lim_sample, _PROFILES + f", picked AS (SELECT * FROM profiles ORDER BY sha256(CAST(id AS VARCHAR)), id LIMIT 200) SELECT column_name, pattern, count(*) AS findings FROM {_ghost('picked')}) WHERE pattern IS NOT NULL GROUP BY 1, 2"),
    "joi_schema_drift": (joi_schema_drift, _CATALOG + _CRAWL + "SELECT resource_id, status, len(names) AS column_count, array_to_string(new_columns, ',') AS new_columns, array_to_string(missing_columns, ',') AS missing_columns, CASE status WHEN 'UNREGISTERED' THEN 'register_resource_or_exclude_dataset' WHEN 'DRIFTED' THEN 'review_registry_column_drift' ELSE 'none' END AS recommended_action FROM diffs"),
    "joi_column_drift": (joi_column_drift, _CATALOG + "SELECT resource_id, column_name, CASE WHEN f IS NULL THEN 'missing' ELSE 'new' END AS drift FROM (SELECT DISTINCT concat('bigquery:', table_catalog, '.', table_schema, '.', table_name) AS resource_id, column_name, 1 AS f FROM catalog_columns) FULL JOIN (SELECT resource_id, column_name, 1 AS d FROM registry_columns) USING (resource_id, column_name) WHERE f IS NULL OR d IS NULL"),
    "agg_crawl_counts": (agg_crawl_counts, _CATALOG + _CRAWL + "SELECT count(*) FILTER (WHERE status = 'REGISTERED') AS registered, count(*) FILTER (WHERE status = 'UNREGISTERED') AS unregistered, count(*) FILTER (WHERE status = 'DRIFTED') AS drifted FROM diffs"),
    "srt_catalog": (srt_catalog, _CATALOG + "SELECT table_schema, table_name, string_agg(column_name, ',' ORDER BY ordinal_position, column_name) AS columns FROM catalog_columns GROUP BY 1, 2"),
    "sca_exclusion": (sca_exclusion, _CATALOG + "SELECT DISTINCT table_schema, table_name FROM catalog_columns WHERE NOT (table_name GLOB '*7' OR concat(table_schema, '.', table_name) GLOB '*7' OR concat(table_schema, '.', table_name) GLOB 'ds1.tbl?' OR table_name GLOB 'tbl2[0-3]' OR concat(table_schema, '.', table_name) GLOB 'ds[!023].tbl1?')"),
    "sca_column_mode": (sca_column_mode, _CATALOG + "SELECT table_schema, table_name, column_name, CASE WHEN is_nullable = 'YES' THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode FROM catalog_columns"),
    "prj_table_reference": (prj_table_reference, "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'a' END AS project, CASE WHEN p_partkey % 4 = 0 THEN 'b' END AS dataset, CASE WHEN p_partkey % 4 = 0 THEN concat('c', CAST(p_partkey AS VARCHAR)) END AS table_name FROM part"),
    "prj_resource_id": (prj_resource_id, _CATALOG + "SELECT DISTINCT concat('bigquery:', table_catalog, '.', table_schema, '.', table_name) AS resource_id FROM catalog_columns"),
    "set_discovery_union": (set_discovery_union, _DISCOVERED + "SELECT pos, location, resource_id, field_name FROM located"),
    "agg_discovered_resources": (agg_discovered_resources, _DISCOVERED + "SELECT resource_id, project_id, dataset_id, table_id, array_to_string(names, ',') AS field_names, classifications FROM grouped"),
    "sca_discovery_defaults": (sca_discovery_defaults, _DISCOVERED + "SELECT coalesce(nullif(confidence, ''), 'INFERRED_HIGH') AS sure, coalesce(nullif(detection_method, ''), 'INFORMATION_SCHEMA') AS method, count(*) AS n FROM located GROUP BY 1, 2"),
    "agg_publish_counts": (agg_publish_counts, _DISCOVERED + "SELECT count(DISTINCT resource_id) AS resources, count(*) AS fields FROM located"),
    "sca_locations": (sca_locations, "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'proj' ELSE 'main' END AS project, p_brand AS dataset FROM part"),
    "sca_comma_list": (sca_comma_list, "SELECT p_partkey, concat('a', CAST(p_size AS VARCHAR), ',b,', p_brand) AS items FROM part"),
    "src_manifest": (src_manifest, _MODELS + "SELECT node_id, name, concat_ws(',', CASE WHEN has_email THEN 'email' END, 'plan', CASE WHEN has_tenant THEN 'tenant_id' END, CASE WHEN has_user THEN 'user_id' END) AS columns, approved, array_to_string(candidates, ',') AS candidates FROM cand"),
    "joi_match_models": (joi_match_models, _MODELS + "SELECT node_id, resource_id FROM matched"),
    "sca_mart": (sca_mart, _MODELS + "SELECT node_id, mart FROM marts"),
    "pol_all_checks": (pol_all_checks, _MODELS + "SELECT status, rule, name, message, count(*) AS n FROM checks GROUP BY ALL"),
    "agg_overall_status": (agg_overall_status, _MODELS + "SELECT CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END AS status, count(*) AS checks FROM checks"),
    "pol_evaluations": (pol_evaluations, """SELECT coalesce(CASE WHEN n % 7 <> 0 THEN concat('res', CAST(n AS VARCHAR)) END, '<missing-resource>') AS resource_id, CASE WHEN n % 5 <> 0 THEN 'FAIL' ELSE '<missing>' END AS status,
      CASE WHEN k IS NOT NULL THEN concat(CASE WHEN n % 3 = k THEN 'HIGH' ELSE 'INFO' END, ' ', CASE WHEN n % 4 <> k THEN concat('C', CAST(n % 5 AS VARCHAR)) ELSE '<missing-code>' END, CASE WHEN n % 2 = k THEN ' field=email' ELSE '' END, ': ', p_brand) END AS issue
      FROM (SELECT p_partkey AS n, p_brand, unnest(CASE WHEN p_partkey % 6 = 0 THEN [NULL] WHEN p_partkey % 6 = 1 THEN [0] ELSE [0, 1] END) AS k FROM part)"""),
    "agg_destinations": (agg_destinations, ctes("lineage") + "SELECT tenant_id, user_id, string_agg(DISTINCT destination, ',' ORDER BY destination) AS destinations FROM lineage WHERE user_id NOT IN ('BATCH_JOB', 'UNKNOWN') GROUP BY 1, 2"),
    "agg_batch_figures": (agg_batch_figures, ctes("users", "keys", "live") + "SELECT u.tenant_id, count(*) AS rows_read, count(k.user_id) AS records_published FROM users u LEFT JOIN live k USING (tenant_id, user_id) GROUP BY 1"),
    "lin_batch_events": (lin_batch_events, ctes("users", "keys", "live") + """, f AS (SELECT u.tenant_id, count(*) AS r, count(k.user_id) AS w FROM users u LEFT JOIN live k USING (tenant_id, user_id) GROUP BY 1)
      SELECT tenant_id, 'BATCH_JOB' AS user_id, 'gs://landing/users.csv' AS source, 'ingestion_pipeline' AS destination, 'DATA_READ' AS event_type, concat('{"operation_id":"op-1","event_type":"DATA_READ","dataClassification":"PII","file_size_rows":', CAST(r AS VARCHAR), '}') AS context FROM f
      UNION ALL SELECT tenant_id, 'BATCH_JOB', 'ingestion_pipeline', 'topic', 'DATA_PUBLISHED_TO_TOPIC', concat('{"operation_id":"op-1","event_type":"DATA_PUBLISHED_TO_TOPIC","dataClassification":"PII","record_count":', CAST(w AS VARCHAR), '}') FROM f"""),
    "lin_row_events": (lin_row_events, ctes("users", "keys", "live") + f""", h AS (SELECT tenant_id, user_id, key_id FROM {HELD})
      SELECT tenant_id, user_id, 'gs://landing/users.csv' AS source, 'ingestion_pipeline' AS destination, 'DATA_ENCRYPTED' AS event_type, concat('{{"operation_id":"op-1","event_type":"DATA_ENCRYPTED","dataClassification":"PII","key_id":"', key_id, '"}}') AS context FROM h
      UNION ALL SELECT tenant_id, user_id, 'topic', 'hubspot', 'DATA_PROVISIONED_TO_SINK', '{{"operation_id":"op-1","event_type":"DATA_PROVISIONED_TO_SINK","dataClassification":"PII","sync_type":"initial_load"}}' FROM h"""),
    "lin_finding_events": (lin_finding_events, _PROFILES + f"""SELECT 'GHOST_DATA_DETECTED' AS event_type, 'UNKNOWN' AS user_id, 't1' AS tenant_id, 'bigquery_ghost_data_scanner' AS source, '{RESOURCE}' AS destination, 'GHOST_DATA' AS data_classification, 'ghost-scan:{RESOURCE}' AS operation_id, TRUE AS timed,
      concat('{{"resource_id":"{RESOURCE}","system":"bigquery","column":"', column_name, '","pattern":"', pattern, '","count":', CAST(count(*) AS VARCHAR), ',"confidence":"PATTERN_MATCH","scanner":"bigquery_ghost_data_scanner","recommended_action":"declare_in_pii_registry_or_remove_from_resource"}}') AS metadata
      FROM {_ghost('profiles')}) WHERE pattern IS NOT NULL GROUP BY column_name, pattern"""),
    "lin_table_events": (lin_table_events, ctes("catalog_columns", "registry_columns", "catalog_tables") + _CRAWL + """SELECT 'WAREHOUSE_METADATA_DISCOVERED' AS event_type, 'UNKNOWN' AS user_id, 't1' AS tenant_id, 'bigquery_metadata_crawler' AS source, resource_id AS destination, 'METADATA' AS data_classification,
      concat('metadata-crawl:', d.table_catalog, '.', d.table_schema, '.', d.table_name) AS operation_id, TRUE AS timed,
      concat('{"resource_id":"', resource_id, '","system":"bigquery","project_id":"', d.table_catalog, '","dataset_id":"', d.table_schema, '","table_id":"', d.table_name, '","table_type":"', k.table_type, '","registry_status":"', status, '","column_count":', CAST(len(names) AS VARCHAR), ',"new_columns":[', array_to_string(list_transform(new_columns, lambda c: concat('"', c, '"')), ','), '],"missing_registry_columns":[', array_to_string(list_transform(missing_columns, lambda c: concat('"', c, '"')), ','), '],"recommended_action":"',
        CASE status WHEN 'UNREGISTERED' THEN 'register_resource_or_exclude_dataset' WHEN 'DRIFTED' THEN 'review_registry_column_drift' ELSE 'none' END, '"}') AS metadata
      FROM diffs d JOIN catalog_tables k USING (table_catalog, table_schema, table_name) WHERE k.table_type IN ('BASE TABLE', 'VIEW')"""),
    "lin_discovery_events": (lin_discovery_events, _DISCOVERED + """SELECT 'WAREHOUSE_METADATA_DISCOVERED' AS event_type, 'UNKNOWN' AS user_id, 't1' AS tenant_id, 'pii_discovery' AS source, resource_id AS destination, 'METADATA' AS data_classification, concat('dbt-pii-discovery:', resource_id) AS operation_id,
      concat('{"resource_id":"', resource_id, '","system":"bigquery","project_id":"', project_id, '","dataset_id":"', dataset_id, '","table_id":"', table_id, '","registry_status":"UNREGISTERED","new_columns":["', array_to_string(names, '","'), '"],"classifications":{', array_to_string(pairs, ','), '},"recommended_action":"declare_in_dbt_meta_pii_or_console"}') AS metadata FROM grouped"""),
    "lin_message_events": (lin_message_events, ctes("users") + f"SELECT user_id, 'pii-ingestor-worker' AS source, 'bigquery:proj.ds.raw_users' AS destination, concat('op-', user_id) AS operation_id, 'INGESTION' AS event_type, {_MESSAGE_KEYS} AS payload_keys FROM users"),
    "prj_redact": (prj_redact, ctes("lineage") + """SELECT event_id, concat('{"User_Email":"<redacted>","table_name":"<redacted>","rows":"', destination, '"}') AS metadata FROM lineage"""),
    "prj_redact_bytes": (prj_redact_bytes, ctes("lineage") + """SELECT event_id, concat('{"User_Email":"<redacted>","payload":"<', CAST(octet_length(encode(destination)) AS VARCHAR), ' bytes>"}') AS metadata FROM lineage"""),
    "prj_redact_nested": (prj_redact_nested, ctes("lineage") + """SELECT event_id, concat('{"outer": {"phone": "<redacted>", "items": [{"full_name": "<redacted>", "sink": "', destination, '"}]}, "rows": "', user_id, '"}') AS metadata FROM lineage"""),
    "sca_context_json": (sca_context_json, ctes("lineage") + """SELECT event_id, CASE WHEN event_type = 'INGESTION' THEN '{"operation_id":"op","dataClassification":"METADATA","event_type":"OVERRIDE"}' ELSE concat('{"operation_id":"op","event_type":"', event_type, '","dataClassification":"PII","rows":"3"}') END AS context FROM lineage"""),
    "sca_stamps": (sca_stamps, ctes("lineage") + "SELECT event_id, epoch_us(ts) AS micros, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM lineage"),
    "snk_archive": (snk_archive, ctes("lineage") + "SELECT 'r1' AS run, strftime(ts, '%Y-%m-%d') AS date, event_type, count(*) AS n FROM lineage GROUP BY ALL"),
    "snk_vault": (snk_vault, _ID_FIELDS + f"SELECT '{RESOURCE}' AS resource_id, field_name, count(*) AS n, count(DISTINCT user_id) AS users FROM {_SYNCED} GROUP BY field_name"),
}
