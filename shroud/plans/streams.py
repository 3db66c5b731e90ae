"""Queries that run the streaming jobs over files derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shroud.functions import crypto
from shroud.operators import encrypted_copy as C
from shroud.operators import keys as K
from shroud.operators import protect as P
from shroud.operators import vault_sync as S
from shroud.plans.fixtures import ctes, frame
from shroud.plans.protection import ACCEPTED, HELD, MESSAGES, _messages, _records
from shroud.plans.support import RESOURCE, hmac_sql, key_table, work_dir
from shroud.sources import sinks
from shroud.streaming import landing as T

FIELDS = ["email", "phone"]
#: Users whose rows come in one round of landing files, about; a round has files of each tenant.
ROUND = 100_000
#: A resource whose source fails for one user.
BROKEN = "bigquery:proj.broken.users"


def _landed(spark, sf):
    """CSV and NDJSON files of every tenant in a folder of its own, protected by one stream; cells hold line breaks, broken lines and rows with a cell too many are counted, and files without the declared columns are moved aside."""
    out, side, keys, inbound = work_dir(spark, "raw"), work_dir(spark, "side"), key_table(frame(spark, sf, "keys")), work_dir(spark, "inbound")
    users = frame(spark, sf, "users")
    users = users.repartition(_rounds(users.count()), "user_id")
    n = F.col("user_id").cast("long")
    note = F.when(n % 4 == 0, F.concat(F.lit('said "'), "plan", F.lit('",\nand left'))).otherwise(F.col("plan")).alias("note")
    users.where((n % 2 == 0) & (n % 100 != 8)).select("tenant_id", "user_id", note, "email", "phone").write.partitionBy("tenant_id").option("header", True).option("escape", '"').csv(inbound)
    users.where(n % 2 == 0).select("tenant_id", "user_id").write.partitionBy("tenant_id").mode("append").option("header", True).csv(inbound)
    line = F.when(n % 50 == 7, F.lit('{"user_id": broken')).otherwise(F.to_json(F.struct("user_id", "email", "phone")))
    _moved(spark, users.where(n % 2 == 1).select("tenant_id", line.alias("value")), inbound, ".json")
    longer = F.concat_ws(",", "user_id", F.coalesce("email", F.lit("")), F.coalesce("phone", F.lit("")), F.lit("one more"))
    rows = F.concat(F.lit("user_id,email,phone\n"), F.array_join(F.sort_array(F.collect_list(longer)), "\n"))
    _moved(spark, users.where(n % 100 == 8).groupBy("tenant_id", F.floor(n / 5000).alias("g")).agg(rows.alias("value")).drop("g"), inbound, ".csv")
    tenant = lambda path: F.regexp_extract(path, "tenant_id=([^/]+)", 1)
    sink = T.landing_batch(tenant, keys, FIELDS, out, work_dir(spark, "failed"), side, "landing")
    T.watch_landing(spark, f"{inbound}/*", work_dir(spark, "check"), sink).awaitTermination()
    return out, side, keys


def _rounds(users):
    """Rounds of landing files for so many users: files that are read in one piece stay bounded, and more of them are written and read side by side."""
    return max(3, -(-users // ROUND))


def _moved(spark, texts, inbound, suffix):
    """Writes texts (tenant_id, value) as files with a suffix into the tenants' landing folders."""
    drafts = work_dir(spark, "drafts")
    texts.write.partitionBy("tenant_id").option("maxRecordsPerFile", 1 if suffix == ".csv" else 0).text(drafts)
    fs, folder = sinks.hadoop_path(spark, drafts)
    for tenant in fs.listStatus(folder):
        for number, status in enumerate(fs.listStatus(tenant.getPath()) if tenant.isDirectory() else []):
            if status.getPath().getName().startswith("part-"):
                _, place = sinks.hadoop_path(spark, f"{inbound}/{tenant.getPath().getName()}/moved-{number}{suffix}")
                fs.mkdirs(place.getParent())
                fs.rename(status.getPath(), place)


def str_landing(spark, sf):
    """Records of landing files, of users with and without a key before; a new user's token is random, so only the opened value shows."""
    out, _, keys = _landed(spark, sf)
    rows = spark.read.parquet(out).join(K.live(keys.read()).select(*K.KEY, "dek_hex"), K.KEY).join(frame(spark, sf, "keys").select(*K.KEY, F.lit(True).alias("known")), K.KEY, "left")
    opened = crypto.open_bundle(F.decode("encrypted_pii", "UTF-8"), F.col("dek_hex"), F.col("user_id"))
    return rows.select("tenant_id", "user_id", F.when(F.col("known"), F.col("email_token")).alias("email_token"), opened.alias("opened"), F.size("pii_fields").cast("long").alias("n_fields"))


def str_landing_sides(spark, sf):
    """Quarantined rows by reason, and lineage events by kind with the rows that they count."""
    _, side, _ = _landed(spark, sf)
    held = spark.read.parquet(f"{side}/quarantine").groupBy(F.lit("quarantine").alias("side"), F.col("reason").alias("what")).agg(F.count("*").alias("n"))
    number = F.coalesce(F.get_json_object("context", "$.file_size_rows"), F.get_json_object("context", "$.record_count"), F.lit("1")).cast("long")
    return held.unionByName(spark.read.parquet(f"{side}/lineage").groupBy(F.lit("lineage").alias("side"), F.col("event_type").alias("what")).agg(F.sum(number).alias("n")))


def str_records(spark, sf):
    """Records in wire form as JSON lines, some of them broken, into the raw table; each is taken once although the files come twice."""
    source, out, dead = (work_dir(spark, p) for p in ("wire", "raw", "dead"))
    n = F.col("user_id").cast("long")
    line = F.when(n % 40 == 3, F.lit("{broken")).when(n % 40 == 4, F.to_json(F.struct("tenant_id", "user_id"))).otherwise(F.to_json(F.struct("*")))
    for _ in range(2):
        P.wire(_records(spark, sf)).select(line.alias("value")).write.mode("append").text(source)
    T.take_records(T.parse_records(spark.readStream.option("maxFilesPerTrigger", 2).text(source)), work_dir(spark, "check"), out, dead)
    rows = spark.read.parquet(out).join(K.live(frame(spark, sf, "keys")).select(*K.KEY, "dek_hex"), K.KEY)
    lost = spark.read.parquet(dead).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("malformed"))
    opened = crypto.open_bundle(F.decode("encrypted_pii", "UTF-8"), F.col("dek_hex"), F.col("user_id"))
    return rows.select("tenant_id", "user_id", "operation_id", "email_token", opened.alias("opened"), F.size("pii_fields").cast("long").alias("n_fields")).crossJoin(lost)  # one row


def str_messages(spark, sf):
    """Messages as JSON lines, some of them broken, into records; each is taken once although the files come twice."""
    keys = key_table(frame(spark, sf, "keys"))
    source, out, events, dead = (work_dir(spark, p) for p in ("messages", "records", "events", "dead"))
    line = F.when(F.col("user_id").cast("long") % 40 == 3, F.lit("{broken")).otherwise(F.to_json(F.struct("*")))
    for _ in range(2):
        _messages(spark, sf).select(line.alias("value")).write.mode("append").text(source)
    stream = T.parse_messages(spark.readStream.text(source))
    T.take_messages(stream, work_dir(spark, "check"), keys, out, events, dead)
    rows = spark.read.parquet(out).join(K.live(keys.read()).select(*K.KEY, "dek_hex"), K.KEY)
    return rows.select("tenant_id", "user_id", "operation_id", crypto.open_bundle(F.col("encrypted_pii"), F.col("dek_hex"), F.col("user_id")).alias("opened"))


def _units(spark, sf):
    """A sync run that only writes units of work, and a stream that takes them: they come twice, one resource has vanished, and the source of another breaks on one user."""
    keys, folder, vault, outcomes, dead, copies = key_table(frame(spark, sf, "keys")), *(work_dir(spark, p) for p in ("units", "unit-vault", "outcomes", "dead", "copies"))
    users = frame(spark, sf, "users")
    broken = users.withColumn("email", F.when(F.col("user_id") == "3", F.raise_error(F.lit("no such row"))).otherwise(F.col("email")))
    units = S.work_units(users.select(F.explode(F.array(F.lit(RESOURCE), F.lit(BROKEN), F.lit("gone"))).alias("resource_id"), "user_id")).withColumn("run_id", F.lit("run-1"))
    for _ in range(2):
        units.select("run_id", "resource_id", "user_ids").write.mode("append").json(folder)
    stream = spark.readStream.schema("run_id string, resource_id string, user_ids array<string>").option("maxFilesPerTrigger", 16).json(folder)
    sources = {RESOURCE: (users, FIELDS), BROKEN: (lambda: broken, ["email"])}
    T.run_once(stream, work_dir(spark, "check"), T.unit_batch(sources, keys, vault, "t0", outcomes, dead, copies))
    return vault, outcomes, dead, copies


def str_units(spark, sf):
    """Vault rows of work units; units that come again, those of a vanished resource and the one that fails add nothing."""
    vault, _, _, copies = _units(spark, sf)
    copied = spark.read.parquet(C.copy_path(copies, RESOURCE)).select(F.lit(RESOURCE).alias("resource_id"), *K.KEY, F.lit(True).alias("copied"))
    rows = spark.read.parquet(vault).join(frame(spark, sf, "keys").select(*K.KEY, F.lit(True).alias("known")), K.KEY, "left").join(copied, ["resource_id", *K.KEY], "left")
    wanted = rows.where(F.col("resource_id") == RESOURCE)
    return wanted.select("tenant_id", "user_id", "resource_id", "field_name", F.when(F.col("known"), F.col("token")).alias("token"), F.coalesce("copied", F.lit(False)).alias("copied"))


def agg_run_progress(spark, sf):
    """Progress of a run from the outcomes that the stream of its units left, each unit once."""
    _, outcomes, dead, _ = _units(spark, sf)
    again = spark.read.json(dead).select(F.explode("user_ids").alias("u")).distinct().agg(F.count("*").alias("users_to_send_again"))
    return S.run_progress(S.settled(spark.read.schema(S.OUTCOME).parquet(outcomes))).crossJoin(again)  # one row


_BASE = ctes("fields", "live", "users", "keys")
#: Users whose key isn't gone, with what is known of their key; others get a new one.
_KEYED = "(SELECT u.*, CAST(user_id AS BIGINT) AS n, k.dek_hex, k.status FROM users u LEFT JOIN keys k USING (tenant_id, user_id))"
_READ = "(NOT (n % 2 = 1 AND n % 50 = 7) AND n % 100 <> 8)"
_SHOWN = "(status IS NULL OR status = 'ACTIVE')"
QUERIES = {
    "str_landing": (str_landing, _BASE + f"SELECT tenant_id, user_id, CASE WHEN status IS NOT NULL THEN {hmac_sql('dek_hex', 'email')} END AS email_token, email AS opened, CAST(2 AS BIGINT) AS n_fields FROM {_KEYED} WHERE {_SHOWN} AND {_READ} AND {ACCEPTED}"),
    "str_landing_sides": (str_landing_sides, _BASE + f""", k AS (SELECT *, {_READ} AS whole, coalesce({ACCEPTED}, FALSE) AS fine FROM {_KEYED}),
      q AS (SELECT CASE WHEN NOT whole THEN 'malformed_line' WHEN email IS NULL OR phone IS NULL THEN 'missing_field' WHEN NOT fine THEN 'malformed_email' WHEN NOT {_SHOWN} THEN 'no_live_key' END AS what, count(*) AS n FROM k GROUP BY 1)
      SELECT 'quarantine' AS side, what, n FROM q WHERE what IS NOT NULL UNION ALL SELECT 'lineage', 'DATA_READ', count(*) FROM k WHERE whole
      UNION ALL SELECT 'lineage', w, count(*) FROM k, (VALUES ('DATA_PUBLISHED_TO_TOPIC'), ('DATA_ENCRYPTED'), ('DATA_PROVISIONED_TO_SINK')) v(w) WHERE whole AND fine AND {_SHOWN} GROUP BY w"""),
    "str_records": (str_records, _BASE + f"SELECT tenant_id, user_id, 'op-1' AS operation_id, {hmac_sql('dek_hex', 'email')} AS email_token, email AS opened, CAST(2 AS BIGINT) AS n_fields, (SELECT CAST(2 * count(*) AS BIGINT) FROM {HELD} WHERE CAST(user_id AS BIGINT) % 40 IN (3, 4)) AS malformed FROM {HELD} WHERE CAST(user_id AS BIGINT) % 40 NOT IN (3, 4)"),
    "str_messages": (str_messages, _BASE + f"SELECT m.tenant_id, m.user_id, concat('op-', m.user_id) AS operation_id, m.email AS opened FROM {MESSAGES} m LEFT JOIN keys k ON m.tenant_id = k.tenant_id AND m.user_id = k.user_id WHERE {_SHOWN} AND m.tenant_id IS NOT NULL AND m.email IS NOT NULL AND m.n % 40 <> 3"),
    "str_units": (str_units, _BASE + f"SELECT tenant_id, user_id, '{RESOURCE}' AS resource_id, field_name, CASE WHEN status IS NOT NULL THEN {hmac_sql('dek_hex', 'value')} END AS token, TRUE AS copied FROM fields LEFT JOIN keys USING (tenant_id, user_id) WHERE {_SHOWN}"),
    "agg_run_progress": (agg_run_progress, ctes("users") + """, u AS (SELECT user_id, (row_number() OVER (ORDER BY user_id) - 1) // 100 AS unit FROM users), bad AS (SELECT unit FROM u WHERE user_id = '3'), n AS (SELECT count(DISTINCT unit) AS units FROM u)
      SELECT 'run-1' AS run_id, 3 * units AS units, 2 * units - (SELECT count(*) FROM bad) AS completed, (SELECT count(*) FROM bad) AS failed, (SELECT count(*) FROM u JOIN bad USING (unit)) AS users_to_send_again FROM n"""),
}
