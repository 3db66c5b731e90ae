"""Queries of landing, encryption, tokens, keys and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from shroud.functions import crypto, text
from shroud.operators import compaction
from shroud.operators import keys as K
from shroud.operators import protect as P
from shroud.plans.fixtures import ctes, frame
from shroud.plans.support import email_sql, hmac_sql, work_dir, written
from shroud.sources import landing, sinks

FIELDS = ["email", "phone"]
ACCEPTED = f"user_id IS NOT NULL AND email IS NOT NULL AND phone IS NOT NULL AND {email_sql('email')}"
#: Users with every field, joined to their live keys.
HELD = f"(SELECT u.*, k.dek_hex, k.key_id, k.encryption_version FROM users u JOIN live k USING (tenant_id, user_id) WHERE {ACCEPTED})"


def _records(spark, sf):
    users, keys = frame(spark, sf, "users"), frame(spark, sf, "keys")
    return written(P.protect(users, keys, FIELDS, "op-1", "landing"), "records")


def _fields_with_keys(spark, sf):
    return K.attach(frame(spark, sf, "fields"), frame(spark, sf, "keys"))




def src_csv(spark, sf):
    """Cells of text as they are, line breaks in quoted ones too; rows with a cell too many are left out."""
    users = frame(spark, sf, "users")
    n = F.col("user_id").cast("long")
    plan = F.when(n % 6 == 0, "NA").when(n % 6 == 1, "null").when(n % 6 == 2, "").when(n % 6 == 3, "#N/A").when(n % 6 == 4, "None!").otherwise(F.col("plan"))
    note = F.when(n % 5 == 0, F.concat(F.lit('a "'), "plan", F.lit('"\nb, c'))).otherwise(F.lit("x"))
    path = work_dir(spark, "csv")
    users.where(n % 9 != 0).select("user_id", F.concat(F.lit("00"), "user_id").alias("code"), "phone", note.alias("note"), plan.alias("plan")).write.option("header", True).option("escape", '"').csv(path)
    longer = F.concat_ws(",", "user_id", F.lit("00"), F.lit(""), F.lit("x"), "plan", F.lit("one more"))
    lines = users.where(n % 9 == 0).groupBy(F.floor(n / 5000)).agg(F.array_join(F.collect_list(longer), "\n").alias("lines"))
    lines.select(F.concat(F.lit("user_id,code,phone,note,plan\n"), "lines").alias("value")).write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return landing.read_csv(spark, path, ["user_id", "code", "phone", "note", "plan"])


def src_ndjson(spark, sf):
    users = frame(spark, sf, "users").withColumn("n", F.col("user_id").cast("long"))
    line = F.when(F.col("n") % 50 == 7, F.lit('{"user_id": broken')).otherwise(F.to_json(F.struct("user_id", "email", "n")))
    path = work_dir(spark, "ndjson")
    users.select(line.alias("value")).write.text(path)
    return landing.read_ndjson(spark, path, ["user_id", "email", "n"])


def src_chosen_files(spark, sf):
    n = F.col("p_partkey") % 6
    folder = F.when(n == 5, "failed/").otherwise(landing.PREFIX)
    suffix = F.when(n == 0, ".csv").when(n == 1, ".json").when(n == 2, "/").when(n == 3, ".csv.gz").otherwise(".csv")
    names = frame(spark, sf, "part").select(F.concat(folder, "p_name", F.col("p_partkey").cast("string"), suffix).alias("name"))
    return names.where(landing.chosen(F.col("name")))


def prj_accepted_rows(spark, sf):
    return P.accepted(frame(spark, sf, "users"), FIELDS).select("tenant_id", "user_id", *FIELDS)


def prj_quarantine(spark, sf):
    return P.quarantine(frame(spark, sf, "users"), FIELDS)


def prj_legacy_columns(spark, sf):
    only_phone = P.protect(frame(spark, sf, "users"), frame(spark, sf, "keys"), ["phone"], "op-2", "landing")
    both = _records(spark, sf)
    out = both.select(F.lit("both").alias("declared"), *both.columns).unionByName(only_phone.select(F.lit("phone").alias("declared"), *only_phone.columns))
    return out.select("declared", "tenant_id", "user_id", "email_token", "data_hash", F.octet_length("encrypted_pii").cast("long").alias("pii_bytes"))


def _messages(spark, sf):
    n = F.col("user_id").cast("long")
    return frame(spark, sf, "users").select(
        F.when(n % 4 == 0, "").when(n % 4 == 1, F.col("tenant_id")).alias("header_tenant"), F.when(n % 3 != 0, F.col("tenant_id")).otherwise("").alias("body_tenant"), "user_id",
        F.when(F.col("email").isNotNull(), F.map_from_arrays(F.array(F.lit("email"), F.lit("plan")), F.array("email", "plan"))).otherwise(F.create_map(F.lit("plan"), F.col("plan"))).alias("payload"),
        F.concat(F.lit("op-"), "user_id").alias("operation_id"),
    )


MESSAGES = """(SELECT *, coalesce(nullif(CASE WHEN n % 4 = 0 THEN '' WHEN n % 4 = 1 THEN tenant END, ''), nullif(CASE WHEN n % 3 <> 0 THEN tenant ELSE '' END, '')) AS tenant_id
  FROM (SELECT user_id, tenant_id AS tenant, email, CAST(user_id AS BIGINT) AS n FROM users))"""


def prj_tenant(spark, sf):
    return _messages(spark, sf).select("user_id", K.tenant(F.col("header_tenant"), F.col("body_tenant")).alias("tenant"))


def prj_rejected_messages(spark, sf):
    return P.rejected_messages(_messages(spark, sf))


def prj_key_documents(spark, sf):
    """Key documents in mixed spellings, derived from the keys."""
    n = F.col("user_id").cast("long") % 4
    dek = F.col("dek_hex")
    docs = frame(spark, sf, "keys").select(
        F.when(n < 2, F.col("user_id")).alias("user_id"), F.when(n >= 2, F.col("user_id")).alias("userId"), F.when(n == 0, "").otherwise(F.col("tenant_id")).alias("tenant_id"), F.when(n == 0, F.col("tenant_id")).alias("tenantId"),
        F.when(n == 0, dek).alias("encrypted_dek"), F.when(n == 1, dek).alias("dek"), F.when(n == 2, F.create_map(F.lit("v1"), dek)).when(n == 3, F.create_map(F.lit("v1"), F.lit("old"), F.lit("v3"), dek)).alias("deks"),
        F.when(n == 3, "v3").alias("active_dek_id"), F.when(n == 1, "k9").alias("keyId"), F.when(n == 2, "v2").alias("encryptionVersion"), "status",
    )
    return K.from_documents(docs).select("user_id", "tenant_id", "key_id", "dek", "encryption_version", "status")


def prj_json_safe(spark, sf):
    orders = frame(spark, sf, "orders")
    kinds = dict(orders.dtypes)
    later = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(F.col("o_orderkey") % 3).cast("decimal(18,6)") / 8)
    return orders.select(
        "o_orderkey", text.json_safe(F.col("o_orderdate"), kinds["o_orderdate"]).alias("ordered"), text.json_safe(later, "timestamp").alias("later"),
        text.json_safe(F.to_date("o_orderdate"), "date").alias("day"), text.json_safe(F.encode("o_orderstatus", "UTF-8"), "binary").alias("state"),
    )


def cry_round_trip(spark, sf):
    """Flagship: each live user's fields with token, and the text opened again from the written ciphertext."""
    rows = _fields_with_keys(spark, sf)
    dek, user = F.col("dek_hex"), F.col("user_id")
    sealed = written(rows.select("tenant_id", "user_id", "field_name", "dek_hex", crypto.token(F.col("value"), dek).alias("token"), crypto.encrypt(F.col("value"), dek, user).alias("payload")), "sealed")
    return sealed.select("tenant_id", "user_id", "field_name", "token", crypto.decrypt(F.col("payload"), dek, user).alias("opened"), F.length("payload").cast("long").alias("payload_chars"))


def cry_wrong_key(spark, sf):
    """Payloads under another user or key open to null."""
    rows = _fields_with_keys(spark, sf).withColumn("payload", crypto.encrypt(F.col("value"), F.col("dek_hex"), F.col("user_id")))
    other = F.sha2(F.col("dek_hex"), 256)
    return rows.select("user_id", "field_name", crypto.decrypt(F.col("payload"), F.col("dek_hex"), F.concat("user_id", F.lit("x"))).alias("other_user"), crypto.decrypt(F.col("payload"), other, F.col("user_id")).alias("other_key"))


def cry_tokens(spark, sf):
    return _fields_with_keys(spark, sf).select("tenant_id", "user_id", "field_name", crypto.token(F.col("value"), F.col("dek_hex")).alias("token"))


def cry_bundles(spark, sf):
    """Bundle and vault value: sizes, key, and what opens."""
    rows = _fields_with_keys(spark, sf)
    made = written(rows.select("user_id", "field_name", "dek_hex", crypto.bundle(F.col("value"), F.col("dek_hex"), F.col("user_id"), F.col("key_id")).alias("bundle")).withColumn("stored", crypto.vault_value(F.col("bundle"))), "bundles")
    return made.select("user_id", "field_name", F.split_part("bundle", F.lit(":"), F.lit(1)).alias("key_id"), F.length("bundle").cast("long").alias("bundle_chars"), F.length("stored").cast("long").alias("stored_chars"), crypto.open_vault_value(F.col("stored"), F.col("dek_hex"), F.col("user_id")).alias("opened"))


def cry_open_after_shred(spark, sf):
    """Stored values of all users: those whose key is shredded open to null."""
    keys = frame(spark, sf, "keys")
    rows = frame(spark, sf, "fields").join(keys, K.KEY)
    stored = written(rows.select(*K.KEY, "field_name", crypto.bundle(F.col("value"), F.col("dek_hex"), F.col("user_id"), F.col("key_id")).alias("bundle")), "shred")
    held = stored.join(K.live(keys).select(*K.KEY, "dek_hex"), K.KEY, "left")
    return held.select(*K.KEY, "field_name", crypto.open_bundle(F.col("bundle"), F.col("dek_hex"), F.col("user_id")).alias("opened"))


def cry_envelope(spark, sf):
    """Wrapped keys are unwrapped with a key that comes as a column."""
    keys = frame(spark, sf, "keys").withColumn("kek", F.sha2(F.concat(F.lit("kek:"), "tenant_id"), 256))
    wrapped = keys.withColumn("wrapped", crypto.base64_line(F.aes_encrypt(F.unhex("dek_hex"), F.unhex("kek"), F.lit("GCM"))))
    return wrapped.select(*K.KEY, crypto.unwrap(F.col("wrapped"), F.col("kek")).alias("dek_hex"), crypto.unwrap(F.col("wrapped"), F.sha2("kek", 256)).alias("other"))


def cry_record_fields(spark, sf):
    """Declared fields of the raw records, in order, with tokens and opened values."""
    records = _records(spark, sf).select("tenant_id", "user_id", F.posexplode("pii_fields").alias("position", "f"))
    held = records.join(K.live(frame(spark, sf, "keys")).select(*K.KEY, "dek_hex"), K.KEY)
    return held.select(*K.KEY, F.col("position").cast("long").alias("position"), "f.field_name", "f.token", crypto.open_bundle(F.decode("f.encrypted_value", "UTF-8"), F.col("dek_hex"), F.col("user_id")).alias("opened"))


def cry_single_messages(spark, sf):
    keys = frame(spark, sf, "keys")
    made = written(P.single_messages(_messages(spark, sf), keys), "messages")
    held = made.join(K.live(keys).select(*K.KEY, "dek_hex"), K.KEY)
    return held.select(*K.KEY, "key_id", "operation_id", crypto.open_bundle(F.col("encrypted_pii"), F.col("dek_hex"), F.col("user_id")).alias("opened"))


def joi_users_without_key(spark, sf):
    return K.users_without_key(frame(spark, sf, "users"), frame(spark, sf, "keys"))


def joi_new_keys(spark, sf):
    made = written(K.new_keys(frame(spark, sf, "users"), frame(spark, sf, "keys")), "new-keys")
    return made.select("tenant_id", "user_id", "key_id", "encryption_version", "status", F.length("dek_hex").cast("long").alias("dek_digits"))


def joi_attach_keys(spark, sf):
    return K.attach(frame(spark, sf, "users"), frame(spark, sf, "keys")).select("tenant_id", "user_id", "key_id", "dek_hex")


def joi_skipped_users(spark, sf):
    return K.without_key(frame(spark, sf, "users"), frame(spark, sf, "keys")).select("tenant_id", "user_id")


def set_distinct_users(spark, sf):
    return frame(spark, sf, "sync_source").select("user_id").distinct()


def snk_raw_users(spark, sf):
    """Records appended once, although the batch comes twice."""
    path, records = work_dir(spark, "raw-users"), _records(spark, sf)
    for _ in range(2):
        sinks.append_once(records, path, ["tenant_id", "user_id", "operation_id"])
    return spark.read.parquet(path).select("tenant_id", "user_id", "key_id", "encryption_version", "email_token", "operation_id", "source_system", F.size("pii_fields").cast("long").alias("n_fields"))


def snk_flat(spark, sf):
    path, records = work_dir(spark, "flat"), _records(spark, sf)
    as_text = records.withColumn("encrypted_pii", crypto.base64_line(F.col("encrypted_pii")))
    sinks.append(P.flat(as_text), path)
    return spark.read.parquet(path).select("tenant_id", "user_id", "email_token", F.octet_length("encrypted_pii").cast("long").alias("pii_bytes"))


def snk_wire(spark, sf):
    rows = P.wire(_records(spark, sf))
    return rows.select("tenant_id", "user_id", F.length("encrypted_pii").cast("long").alias("pii_chars"), F.array_join(F.transform("pii_fields", lambda x: F.concat(x["field_name"], F.lit(":"), F.length(x["encrypted_value"]).cast("string"))), ",").alias("field_chars"))


def snk_purge(spark, sf):
    """A planted row is found by its operation in the stored table, and gone once the table was rewritten without that operation."""
    from shroud.operators.ghost_scan import with_canary

    path, records = work_dir(spark, "purged"), _records(spark, sf).select("tenant_id", "user_id", "operation_id")
    sinks.append(with_canary(records, spark.sql("SELECT 'canary' AS user_id, 'op-canary' AS operation_id")), path)
    counts = lambda name: spark.read.parquet(path).groupBy("operation_id").agg(F.count("*").alias(name))
    before = written(counts("rows_before"), "counts")
    sinks.purge(spark, path, "op-canary")
    return before.join(counts("rows_after"), "operation_id", "left").select("operation_id", "rows_before", F.coalesce("rows_after", F.lit(0)).cast("long").alias("rows_after"))


def snk_compact(spark, sf):
    """A raw table that grew by many small appends, by day, and an append-only copy: the same rows, and the same latest rows, in few files."""
    raw, copy, n = work_dir(spark, "grown"), work_dir(spark, "grown-copy"), F.col("user_id").cast("long")
    users = frame(spark, sf, "users").select("tenant_id", "user_id", F.concat(F.lit("d"), (n % 3).cast("string")).alias("day"), n.alias("n"))
    for k in range(4):
        sinks.append(users.where(n % 4 == k).repartition(4), raw, ["day"])
        sinks.append(users.where(n % 4 <= k).select("tenant_id", "user_id", F.lit(k).alias("synced_at"), (F.col("n") * (k + 1)).alias("v")), copy)
    compaction.compact(spark, raw)
    compaction.compact(spark, copy, latest=("user_id", ("synced_at",)))
    def few(path, parts):
        """One file of each partition, and one more for every SMALL bytes."""
        sizes = [size for _, size in sinks.parquet_files(spark, path)]
        return F.lit(len(sizes) <= parts + sum(sizes) // compaction.SMALL)

    rows = spark.read.parquet(raw).groupBy("day").agg(F.count("*").alias("rows"), F.sum("n").alias("total")).withColumn("few", few(raw, 3))
    held = spark.read.parquet(copy)
    return rows.unionByName(held.agg(F.lit("latest").alias("day"), F.count("*").alias("rows"), F.sum("v").alias("total")).withColumn("few", few(copy, 1)))


def prj_required_columns(spark, sf):
    """The required columns that files lack, for files with every second column of a list that the parts give."""
    given = frame(spark, sf, "part").select((F.col("p_size") % 8).alias("kind")).groupBy("kind").agg(F.count("*").alias("files")).collect()  # eight kinds at most
    kept = lambda kind: [c for bit, c in enumerate(["user_id", *FIELDS]) if kind >> bit & 1]
    return spark.createDataFrame([(int(r.kind), r.files, ",".join(P.missing_columns([*kept(r.kind), "plan"], FIELDS))) for r in given], "kind long, files long, missing string")


def _bundle_chars(v: str) -> str:
    return f"(length(key_id) + 1 + 16 + 1 + 4 * CAST(ceil((octet_length(encode({v})) + 16) / 3.0) AS BIGINT))"


def _b64(n: str) -> str:
    return f"4 * CAST(ceil({n} / 3.0) AS BIGINT)"


_FIELDS_HELD = "(SELECT f.*, k.dek_hex, k.key_id FROM fields f JOIN live k USING (tenant_id, user_id))"
_BASE = ctes("fields", "live", "users", "keys")

QUERIES = {
    "src_csv": (src_csv, ctes("users") + "SELECT user_id, concat('00', user_id) AS code, phone, CASE WHEN CAST(user_id AS BIGINT) % 5 = 0 THEN concat('a \"', plan, '\"', chr(10), 'b, c') ELSE 'x' END AS note, CASE WHEN CAST(user_id AS BIGINT) % 6 < 4 THEN NULL WHEN CAST(user_id AS BIGINT) % 6 = 4 THEN 'None!' ELSE plan END AS plan FROM users WHERE CAST(user_id AS BIGINT) % 9 <> 0"),
    "src_ndjson": (src_ndjson, ctes("users") + "SELECT user_id, email, user_id AS n FROM users WHERE CAST(user_id AS BIGINT) % 50 <> 7"),
    "src_chosen_files": (src_chosen_files, """SELECT concat('inbound/', p_name, CAST(p_partkey AS VARCHAR), CASE p_partkey % 6 WHEN 1 THEN '.json' ELSE '.csv' END) AS name FROM part WHERE p_partkey % 6 IN (0, 1, 4)"""),
    "prj_required_columns": (prj_required_columns, "SELECT CAST(p_size % 8 AS BIGINT) AS kind, count(*) AS files, concat_ws(',', CASE WHEN p_size % 8 // 2 % 2 = 0 THEN 'email' END, CASE WHEN p_size % 8 // 4 % 2 = 0 THEN 'phone' END, CASE WHEN p_size % 2 = 0 THEN 'user_id' END) AS missing FROM part GROUP BY 1, 3"),
    "prj_accepted_rows": (prj_accepted_rows, ctes("users") + f"SELECT tenant_id, user_id, email, phone FROM users WHERE {ACCEPTED}"),
    "prj_quarantine": (prj_quarantine, ctes("users") + f"SELECT user_id, CASE WHEN email IS NULL OR phone IS NULL THEN 'missing_field' ELSE 'malformed_email' END AS reason FROM users WHERE NOT coalesce({ACCEPTED}, FALSE)"),
    "prj_legacy_columns": (prj_legacy_columns, _BASE + f"SELECT 'both' AS declared, tenant_id, user_id, {hmac_sql('dek_hex', 'email')} AS email_token, {hmac_sql('dek_hex', 'email')} AS data_hash, {_bundle_chars('email')} AS pii_bytes FROM {HELD} UNION ALL SELECT 'phone', u.tenant_id, u.user_id, '', '', 0 FROM users u JOIN live USING (tenant_id, user_id) WHERE phone IS NOT NULL"),
    "prj_tenant": (prj_tenant, ctes("users") + f"SELECT user_id, tenant_id AS tenant FROM {MESSAGES}"),
    "prj_rejected_messages": (prj_rejected_messages, ctes("users") + f"SELECT concat('op-', user_id) AS operation_id, CASE WHEN tenant_id IS NULL THEN 'missing_tenant' ELSE 'missing_email' END AS reason FROM {MESSAGES} WHERE tenant_id IS NULL OR email IS NULL"),
    "prj_key_documents": (prj_key_documents, ctes("keys") + "SELECT user_id, tenant_id, CASE CAST(user_id AS BIGINT) % 4 WHEN 1 THEN 'k9' WHEN 3 THEN 'v3' ELSE 'v1' END AS key_id, dek_hex AS dek, CASE CAST(user_id AS BIGINT) % 4 WHEN 2 THEN 'v2' ELSE 'v1' END AS encryption_version, status FROM keys WHERE status = 'ACTIVE'"),
    "prj_json_safe": (prj_json_safe, "SELECT o_orderkey, concat(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), '') AS ordered, concat(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), CASE o_orderkey % 3 WHEN 1 THEN '.125000' WHEN 2 THEN '.250000' ELSE '' END, '+00:00') AS later, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS state FROM orders"),
    "cry_round_trip": (cry_round_trip, _BASE + f"SELECT tenant_id, user_id, field_name, {hmac_sql('dek_hex', 'value')} AS token, value AS opened, {_b64('(octet_length(encode(value)) + 28)')} AS payload_chars FROM {_FIELDS_HELD}"),
    "cry_wrong_key": (cry_wrong_key, _BASE + f"SELECT user_id, field_name, CAST(NULL AS VARCHAR) AS other_user, CAST(NULL AS VARCHAR) AS other_key FROM {_FIELDS_HELD}"),
    "cry_tokens": (cry_tokens, _BASE + f"SELECT tenant_id, user_id, field_name, {hmac_sql('dek_hex', 'value')} AS token FROM {_FIELDS_HELD}"),
    "cry_bundles": (cry_bundles, _BASE + f"SELECT user_id, field_name, key_id, {_bundle_chars('value')} AS bundle_chars, {_b64(_bundle_chars('value'))} AS stored_chars, value AS opened FROM {_FIELDS_HELD}"),
    "cry_open_after_shred": (cry_open_after_shred, _BASE + "SELECT tenant_id, user_id, field_name, CASE WHEN status = 'ACTIVE' THEN value END AS opened FROM fields JOIN keys USING (tenant_id, user_id)"),
    "cry_envelope": (cry_envelope, ctes("keys") + "SELECT tenant_id, user_id, dek_hex, CAST(NULL AS VARCHAR) AS other FROM keys"),
    "cry_record_fields": (cry_record_fields, _BASE + f"SELECT tenant_id, user_id, CAST(0 AS BIGINT) AS position, 'email' AS field_name, {hmac_sql('dek_hex', 'email')} AS token, email AS opened FROM {HELD} UNION ALL SELECT tenant_id, user_id, 1, 'phone', {hmac_sql('dek_hex', 'phone')}, phone FROM {HELD}"),
    "cry_single_messages": (cry_single_messages, _BASE + f"SELECT m.tenant_id, m.user_id, k.key_id, concat('op-', m.user_id) AS operation_id, m.email AS opened FROM {MESSAGES} m JOIN live k ON m.tenant_id = k.tenant_id AND m.user_id = k.user_id WHERE m.email IS NOT NULL"),
    "joi_users_without_key": (joi_users_without_key, _BASE + "SELECT tenant_id, user_id FROM users ANTI JOIN keys USING (tenant_id, user_id)"),
    "joi_new_keys": (joi_new_keys, _BASE + "SELECT tenant_id, user_id, 'v1' AS key_id, 'v2' AS encryption_version, 'ACTIVE' AS status, CAST(64 AS BIGINT) AS dek_digits FROM users ANTI JOIN keys USING (tenant_id, user_id)"),
    "joi_attach_keys": (joi_attach_keys, _BASE + "SELECT tenant_id, user_id, key_id, dek_hex FROM users JOIN live USING (tenant_id, user_id)"),
    "joi_skipped_users": (joi_skipped_users, _BASE + "SELECT tenant_id, user_id FROM users ANTI JOIN live USING (tenant_id, user_id)"),
    "set_distinct_users": (set_distinct_users, ctes("sync_source") + "SELECT DISTINCT user_id FROM sync_source"),
    "snk_raw_users": (snk_raw_users, _BASE + f"SELECT tenant_id, user_id, key_id, encryption_version, {hmac_sql('dek_hex', 'email')} AS email_token, 'op-1' AS operation_id, 'landing' AS source_system, CAST(2 AS BIGINT) AS n_fields FROM {HELD}"),
    "snk_flat": (snk_flat, _BASE + f"SELECT tenant_id, user_id, {hmac_sql('dek_hex', 'email')} AS email_token, {_bundle_chars('email')} AS pii_bytes FROM {HELD}"),
    "snk_wire": (snk_wire, _BASE + f"SELECT tenant_id, user_id, {_b64(_bundle_chars('email'))} AS pii_chars, concat('email:', CAST({_b64(_bundle_chars('email'))} AS VARCHAR), ',phone:', CAST({_b64(_bundle_chars('phone'))} AS VARCHAR)) AS field_chars FROM {HELD}"),
    "snk_compact": (snk_compact, ctes("users") + """, n AS (SELECT CAST(user_id AS BIGINT) AS n FROM users)
      SELECT concat('d', CAST(n % 3 AS VARCHAR)) AS day, count(*) AS rows, CAST(sum(n) AS BIGINT) AS total, TRUE AS few FROM n GROUP BY 1 UNION ALL SELECT 'latest', count(*), CAST(sum(4 * n) AS BIGINT), TRUE FROM n"""),
    "snk_purge": (snk_purge, _BASE + f"SELECT 'op-1' AS operation_id, count(*) AS rows_before, count(*) AS rows_after FROM {HELD} UNION ALL SELECT 'op-canary', 1, 0"),
}
