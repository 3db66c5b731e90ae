"""Privacy policy over modelled tables: each broken rule is a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shroud.functions.text import non_empty


def candidates(database: Column, schema: Column, alias: Column, name: Column) -> Column:
    """The resource ids that a model may have, the most specific first."""
    d, s, a = non_empty(database), non_empty(schema), non_empty(alias, name)
    made = [F.concat(F.lit("bigquery:"), d, F.lit("."), s, F.lit("."), a), F.concat(F.lit("bigquery:"), d, F.lit("."), s), F.concat(F.lit("bigquery:"), s, F.lit("."), a)]
    return F.array_compact(F.array(*made))


def is_mart(*parts: Column) -> Column:
    """Whether name, path or dotted fqn says that the model belongs to a mart."""
    tests = [F.coalesce(p.startswith("mart") | p.contains(".mart") | p.contains("/mart"), F.lit(False)) for p in parts]
    return reduce(lambda a, b: a | b, tests)


def match(models: DataFrame, resources: DataFrame) -> DataFrame:
    """Models (node_id, candidates, ...) with ``resource``: of the table resources with a candidate id, the first in registry order, else null."""
    by_id = models.select("node_id", F.explode("candidates").alias("resource_id")).distinct().join(resources, "resource_id")
    fields = [c for c in resources.columns if c not in ("pos",)]
    first = by_id.groupBy("node_id").agg(F.min_by(F.struct(*fields), "pos").alias("resource"))
    return models.join(first, "node_id", "left")


def _broken(condition: Column, status: str, rule: str, message: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(status).alias("status"), F.lit(rule).alias("rule"), message.alias("message")))


def _lacks(what: str, column: Column, default: str) -> Column:
    return F.concat(F.col("resource.resource_id"), F.lit(f" {what} but the model lacks "), F.coalesce(column, F.lit(default)))


def all_checks(matched: DataFrame) -> DataFrame:
    """Every broken rule of every model, in one pass: status, rule, name, message. Only a missing review is a warning.

    missing_registry_resource: no resource matches. tenant_id_required: the resource is tenant-scoped
    and the model lacks its tenant column. user_scope_required: the resource is crypto-shredded, the
    model lacks its user column, and no exception is documented. manual_review_required: the resource
    needs a review by hand that the model doesn't say was approved. direct_identifier_in_mart: a mart
    model exposes a direct identifier that isn't allowed in marts, one row for each.
    """
    r, has = F.col("resource"), lambda c: F.coalesce(F.array_contains("columns", c), F.lit(False))
    policy = F.coalesce(F.lower(r["handling_policy"]), F.lit(""))
    excepted = policy.contains("exception") | F.coalesce(F.exists(r["evidence"], lambda e: e.startswith("exception:")), F.lit(False))
    review = (r["deletion_strategy"].eqNullSafe("MANUAL_REVIEW") | policy.contains("manual")) & ~F.coalesce("approved", F.lit(False))
    rules = [
        _broken(r.isNull(), "FAIL", "missing_registry_resource", F.concat(F.lit("no registry resource matches "), F.array_join("candidates", ", "))),
        _broken(r["tenant_scoped"] & ~has(r["tenant_column"]), "FAIL", "tenant_id_required", _lacks("is tenant-scoped", r["tenant_column"], "tenant_id")),
        _broken((r["deletion_strategy"] == "CRYPTO_SHRED") & ~has(r["user_column"]) & ~excepted, "FAIL", "user_scope_required", _lacks("uses CRYPTO_SHRED", r["user_column"], "user_id")),
        _broken(r.isNotNull() & review, "WARN", "manual_review_required", F.concat(r["resource_id"], F.lit(" requires manual review"))),
    ]
    text = lambda i: F.concat(F.lit("mart model exposes direct identifier column "), i["name"], F.lit(" from "), r["resource_id"])
    exposed = F.transform(F.filter(r["identifiers"], lambda i: has(i["name"]) & ~i["allowed_in_mart"]), lambda i: _broken(F.lit(True), "FAIL", "direct_identifier_in_mart", text(i)))
    mart = is_mart(F.col("name"), F.col("path"), F.array_join("fqn", ".")) & r["identifiers"].isNotNull()
    every = F.array_compact(F.concat(F.array(*rules), F.when(mart, exposed).otherwise(F.array().cast("array<struct<status:string,rule:string,message:string>>"))))
    return matched.select("name", F.explode(every).alias("v")).select("v.status", "v.rule", "name", "v.message")


def overall(checks: DataFrame) -> DataFrame:
    """FAIL over WARN over PASS, in one row; no check at all passes."""
    rank = F.max(F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0))
    return checks.agg(rank.alias("rank"), F.count("*").alias("checks")).select(F.when(F.col("rank") == 2, "FAIL").when(F.col("rank") == 1, "WARN").otherwise("PASS").alias("status"), "checks")


def flatten_evaluations(policies: DataFrame) -> DataFrame:
    """One row per issue of stored policy evaluations (status, evaluations[resource_id, status, issues[...]]), and one for each without any."""
    rows = policies.select(F.explode_outer("evaluations").alias("e")).select("e.resource_id", F.col("e.status").alias("status"), F.explode_outer("e.issues").alias("i"))
    field = F.when(non_empty(F.col("i.field")).isNotNull(), F.format_string(" field=%s", "i.field")).otherwise("")
    text = F.when(F.col("i").isNotNull(), F.format_string("%s %s%s: %s", F.coalesce("i.severity", F.lit("INFO")), F.coalesce("i.code", F.lit("<missing-code>")), field, F.coalesce("i.message", F.lit(""))))
    return rows.select(F.coalesce("resource_id", F.lit("<missing-resource>")).alias("resource_id"), F.coalesce("status", F.lit("<missing>")).alias("status"), text.alias("issue"))
