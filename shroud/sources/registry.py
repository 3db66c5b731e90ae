"""Registry documents: declared resources and their columns, in any of the spellings in which they are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.functions.text import non_empty

_COLUMN = "struct<name:string,classification:string,identifierType:string,identifier_type:string,allowedInMart:boolean,allowed_in_mart:boolean,handling:string,requiredInMart:boolean,required_in_mart:boolean,evidence:array<string>,confidence:string>"
_SCAN = "struct<enabled:boolean,scanMode:string,scan_mode:string,patterns:array<string>>"
RESOURCE = (
    "struct<resourceId:string,resource_id:string,id:string,type:string,system:string,tenantScoped:boolean,tenant_scoped:boolean,tenantIdColumn:string,tenant_id_column:string,"
    "userIdColumn:string,user_id_column:string,allowedDirectIdentifiers:array<string>,allowed_direct_identifiers:array<string>,"
    f"columns:array<{_COLUMN}>,piiFields:array<{_COLUMN}>,pii_fields:array<{_COLUMN}>,ownerConnector:string,owner_connector:string,lineageDestination:string,lineage_destination:string,"
    "deletionStrategy:string,deletion_strategy:string,handlingPolicy:string,handling_policy:string,evidencePointers:array<string>,evidence_pointers:array<string>,"
    f"ghostDataScan:{_SCAN},ghost_data_scan:{_SCAN},registryVersion:string,registry_version:string,updatedAtColumn:string,updated_at_column:string,lastSyncedAt:string,last_synced_at:string,"
    "sourceRedactionStrategies:array<string>,sourceRedactionStrategy:string,source_redaction_strategy:string>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``pos`` and ``r`` of every resource of a registry file (an object with version and resources)."""
    rows = spark.read.schema(f"version string, resources array<{RESOURCE}>").option("multiLine", True).json(path)
    return rows.select("version", F.posexplode("resources").alias("pos", "r"))


def parse_resources(texts: DataFrame) -> DataFrame:
    """``pos`` and ``r`` from rows of pos and ``value``, the JSON of one resource each."""
    return texts.select("pos", F.from_json("value", RESOURCE).alias("r"))


def _text(name: str, other: str) -> Column:
    return non_empty(F.col(f"r.{name}"), F.col(f"r.{other}"))


def _list(name: str, other: str) -> Column:
    return F.coalesce(f"r.{name}", f"r.{other}", F.array().cast("array<string>"))


def file_version(documents: DataFrame) -> DataFrame:
    """The version that a registry file states, as a whole number in one row."""
    return documents.agg(F.max("version").cast("long").alias("version"))


def normalise(resources: DataFrame) -> DataFrame:
    """One row per resource with one spelling for everything: what isn't given is derived from the id or takes its default."""
    rid = non_empty(F.col("r.resourceId"), F.col("r.resource_id"), F.col("r.id"))
    given = non_empty(F.col("r.system"))
    derived = F.when(rid.contains(":"), F.substring_index(rid, ":", 1))
    system = F.coalesce(given, derived)
    kind = F.when(system == "bigquery", "bigquery_table").when(system == "gcs", "gcs_prefix").otherwise(F.coalesce(non_empty(system), F.lit("external")))
    column = lambda c: F.struct(
        c["name"].alias("name"), c["classification"].alias("classification"), non_empty(c["identifierType"], c["identifier_type"]).alias("identifier_type"),
        F.coalesce(c["allowedInMart"], c["allowed_in_mart"], F.lit(False)).alias("allowed_in_mart"), c["handling"].alias("handling"),
        F.coalesce(c["requiredInMart"], c["required_in_mart"], F.lit(False)).alias("required_in_mart"), F.coalesce(c["evidence"], F.array().cast("array<string>")).alias("evidence"), c["confidence"].alias("confidence"),
    )
    scan = F.coalesce("r.ghostDataScan", "r.ghost_data_scan")
    legacy = _text("sourceRedactionStrategy", "source_redaction_strategy")
    tenant = _text("tenantIdColumn", "tenant_id_column")
    return resources.select(
        "pos", rid.alias("id"), F.coalesce(non_empty(F.col("r.type")), kind).alias("type"), system.alias("system"),
        F.coalesce("r.tenantScoped", "r.tenant_scoped", tenant.isNotNull()).alias("tenant_scoped"), tenant.alias("tenant_id_column"), _text("userIdColumn", "user_id_column").alias("user_id_column"),
        _list("allowedDirectIdentifiers", "allowed_direct_identifiers").alias("allowed_direct_identifiers"), F.transform(F.coalesce("r.columns", "r.piiFields", "r.pii_fields"), column).alias("columns"),
        _text("ownerConnector", "owner_connector").alias("owner_connector"), _text("lineageDestination", "lineage_destination").alias("lineage_destination"),
        _text("deletionStrategy", "deletion_strategy").alias("deletion_strategy"), _text("handlingPolicy", "handling_policy").alias("handling_policy"), _list("evidencePointers", "evidence_pointers").alias("evidence_pointers"),
        F.struct(F.coalesce(scan["enabled"], F.lit(False)).alias("enabled"), F.upper(F.coalesce(non_empty(scan["scanMode"], scan["scan_mode"]), F.lit("SAMPLED"))).alias("scan_mode"), F.coalesce(scan["patterns"], F.array().cast("array<string>")).alias("patterns")).alias("scan"),
        _text("registryVersion", "registry_version").alias("registry_version"), _text("updatedAtColumn", "updated_at_column").alias("updated_at_column"), _text("lastSyncedAt", "last_synced_at").alias("last_synced_at"),
        F.coalesce("r.sourceRedactionStrategies", F.when(legacy != "NONE", F.array(legacy)), F.array().cast("array<string>")).alias("redaction_strategies"),
    )


def columns_of(resources: DataFrame) -> DataFrame:
    """Declared columns of normalised resources: resource_id, position and the column's fields."""
    return resources.select(F.col("id").alias("resource_id"), F.posexplode("columns").alias("position", "c")).select("resource_id", "position", "c.*")


def version(resources: DataFrame) -> DataFrame:
    """The registry's version in one row: that of the first resource with one, else 0."""
    return resources.agg(F.coalesce(F.min_by("registry_version", F.when(F.col("registry_version").isNotNull(), F.col("pos"))), F.lit("0")).alias("version"))


def direct_identifiers(resources: DataFrame) -> DataFrame:
    return columns_of(resources).where("classification = 'DIRECT_IDENTIFIER'")


def scan_enabled(resources: DataFrame, system: str | None = None) -> DataFrame:
    rows = resources.where("scan.enabled")
    return rows if system is None else rows.where(F.col("system") == system)


def wants_encrypted_copy(resources: DataFrame) -> DataFrame:
    return resources.where(F.array_contains("redaction_strategies", "ENCRYPTED_COPY"))
