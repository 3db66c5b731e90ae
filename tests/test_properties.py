"""What random ciphertext must satisfy, and rules that reject, quarantine or isolate."""

import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from shroud.functions import crypto, text
from shroud.operators import catalog_drift, compaction, discovery, encrypted_copy, ghost_scan, keys, lineage, numbering, protect, sync_run, sync_state, vault_sync
from shroud.plans.support import written
from shroud.sources import landing, manifest, registry, sinks

DEK = hashlib.sha256(b"one").hexdigest()


@pytest.fixture
def people(spark):
    rows = [("t1", "u1", "a@b.com", "+15551234567"), ("t1", "u2", "é@x.org", None), ("t2", "u1", "a@b.com", "0"), ("t1", None, "c@d.com", "1"), ("t1", "u4", "no-mail", "1"), ("t1", "u5", "x@y.com", "2")]
    return spark.createDataFrame(rows, "tenant_id string, user_id string, email string, phone string")


@pytest.fixture
def some_keys(spark):
    rows = [("t1", "u1", "v1", "v2", DEK, "ACTIVE"), ("t2", "u1", "v1", "v2", DEK[::-1], "ACTIVE"), ("t1", "u4", "v1", "v2", DEK, "ACTIVE"), ("t1", "u5", "v1", "v2", DEK, "SHREDDED")]
    return spark.createDataFrame(rows, "tenant_id string, user_id string, key_id string, encryption_version string, dek_hex string, status string")


def test_token_is_hmac(spark):
    values = ["", "a@b.com", "é日本", "x" * 300]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", crypto.token(F.col("v"), F.lit(DEK)).alias("t")).collect()
    assert all(r.t == hmac.new(bytes.fromhex(DEK), r.v.encode(), hashlib.sha256).hexdigest() for r in got)


def test_ciphertext_is_random_and_tampering_gives_null(spark):
    rows = spark.createDataFrame([("secret", DEK, "u")] * 50, "v string, k string, u string")
    made = written(rows.select("*", crypto.encrypt(F.col("v"), F.col("k"), F.col("u")).alias("p"), crypto.bundle(F.col("v"), F.col("k"), F.col("u"), F.lit("v1")).alias("b")), "random")
    assert made.select("p").distinct().count() == 50
    assert made.select(F.split_part("b", F.lit(":"), F.lit(2))).distinct().count() == 50
    flipped = F.concat(F.when(F.substring("p", 1, 1) == "A", "B").otherwise("A"), F.expr("substring(p, 2)"))
    got = made.select(crypto.decrypt(F.col("p"), F.col("k"), F.col("u")).alias("right"), crypto.decrypt(flipped, F.col("k"), F.col("u")).alias("changed"), crypto.open_bundle(F.col("b"), F.col("k"), F.col("u")).alias("bundle"), crypto.open_bundle(F.col("p"), F.col("k"), F.col("u")).alias("bare")).distinct().collect()
    assert [tuple(r) for r in got] == [("secret", None, "secret", "secret")]


def test_long_values_have_no_line_breaks(spark):
    made = spark.range(1).select(crypto.vault_value(crypto.bundle(F.lit("x" * 500), F.lit(DEK), F.lit("u"), F.lit("v1"))).alias("s"))
    assert "\n" not in made.first().s and "\r" not in made.first().s


def test_records_hold_no_plain_text(spark, people, some_keys):
    records = protect.protect(people, some_keys, ["email", "phone"], "op", "src").collect()
    assert [(r.tenant_id, r.user_id) for r in sorted(records)] == [("t1", "u1"), ("t2", "u1")]
    assert [f.field_name for f in records[0].pii_fields] == ["email", "phone"]
    assert "a@b.com" not in str(records) and records[0].email_token != records[1].email_token
    reasons = {(r.user_id, r.reason) for r in protect.quarantine(people, ["email", "phone"]).collect()}
    assert reasons == {("u2", "missing_field"), (None, "missing_user"), ("u4", "malformed_email")}


def test_declared_fields_and_fallback(spark):
    columns = spark.createDataFrame([("r1", 1, "phone", "ENCRYPT"), ("r1", 0, "name", "ENCRYPT"), ("r2", 0, "plan", None)], "resource_id string, position int, name string, handling string")
    assert protect.encrypted_fields(columns, "r1") == ["name", "phone"]
    assert protect.encrypted_fields(columns, "r2") == []
    assert protect.encrypted_fields(columns, "gone") == protect.encrypted_fields(None, "r1") == ["email"]
    assert protect.missing_columns(["userId", "age"], ["email"]) == ["email", "user_id"]


def test_landing_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('user_id,email,phone\n01,"x,y@b.com",+1555\n02,NA,null\n')
    rows = landing.read_file(spark, str(tmp_path / "a.csv"), ["email", "phone"]).collect()
    assert [tuple(r) for r in rows] == [("01", "x,y@b.com", "+1555"), ("02", None, None)]
    (tmp_path / "b.json").write_text('{"user_id": 7, "email": "a@b.com"}\n{broken\n\n{"user_id": "8", "phone": "+1"}\n')
    rows = landing.read_file(spark, str(tmp_path / "b.json"), ["email", "phone"]).collect()
    assert [tuple(r) for r in rows] == [("7", "a@b.com", None), ("8", None, "+1")]
    assert landing.bad_lines(spark, str(tmp_path / "b.json"), ["user_id"]).first().bad_lines == 1
    with pytest.raises(ValueError, match="phone"):
        (tmp_path / "c.csv").write_text("user_id,email\n1,a@b.com\n")
        landing.read_file(spark, str(tmp_path / "c.csv"), ["email", "phone"])
    with pytest.raises(ValueError, match="only"):
        landing.require_suffix("x.parquet")


@pytest.fixture
def key_table(some_keys, tmp_path):
    table = keys.KeyTable(some_keys.sparkSession, str(tmp_path / "key-table"))
    table.add(some_keys)
    return table


def test_sync_is_idempotent_and_keeps_tenants_apart(spark, people, key_table):
    none = spark.createDataFrame([], "tenant_id string, user_id string, resource_id string, field_name string")
    first = written(vault_sync.sync(people, none, key_table, "r", ["email", "phone"], "t0"), "vault")
    assert {(r.tenant_id, r.user_id) for r in first.collect()} == {("t1", "u1"), ("t1", "u2"), ("t2", "u1"), ("t1", "u4")}  # u2 is new, u5 shredded
    assert first.count() == 7 and key_table.read().where("user_id = 'u2'").count() == 1
    assert vault_sync.sync(people, first, key_table, "r", ["email", "phone"], "t0").count() == 0
    assert vault_sync.sync(people, first, key_table, "other", ["email"], "t0").count() == 4
    one = first.where("tenant_id = 't1'")
    fields = vault_sync.long_fields(people, "r", ["email"], "t0")
    assert vault_sync.not_yet_synced(fields, one).where("user_id = 'u1'").count() == 1
    assert vault_sync.not_yet_synced(fields, one, tenant_in_key=False).where("user_id = 'u1'").count() == 0


def test_only_lacking_fields_are_synced_and_users_stay_dealt(spark):
    rows = spark.createDataFrame([("t1", "u1", "a@b.com", None, 1), ("t1", "u1", "c@d.com", "+1", 0), (None, "u2", "e@f.com", "+2", 0)], "tenant_id string, user_id string, email string, phone string, at int")
    vault = spark.createDataFrame([("t1", "u1", "email"), ("t9", "u2", "email"), ("t0", "u2", "other")], "tenant_id string, user_id string, field_name string")
    latest = vault_sync.latest_fields(rows, ["email", "phone"], "t0", "at")
    assert {r.user_id: [tuple(f) for f in r.f] for r in latest.collect()} == {"u1": [("email", "a@b.com"), ("phone", "+1")], "u2": [("email", "e@f.com"), ("phone", "+2")]}
    missing = vault_sync.lacking(latest, vault, ["email", "phone"])
    assert {r.user_id: [tuple(f) for f in r.f] for r in missing.collect()} == {"u1": [("phone", "+1")], "u2": [("email", "e@f.com"), ("phone", "+2")]}
    plan = missing.dropDuplicates(["tenant_id", "user_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # one of the source, one of the vault


def test_wide_copy_never_shows_plain_text(spark, people, key_table):
    none = spark.createDataFrame([], "tenant_id string, user_id string, resource_id string, field_name string")
    vault = written(vault_sync.sync(people, none, key_table, "r", ["email"], "t0"), "vault")
    copy = encrypted_copy.wide_copy(people.withColumn("born", F.to_date(F.lit("2001-02-03"))), vault.unionByName(vault), "r", ["email", "phone"]).collect()
    stored = {(r.tenant_id, r.user_id): r.encrypted_value for r in vault.collect()}
    assert {(r.tenant_id, r.user_id): r.email for r in copy} == stored
    assert {r.phone for r in copy} == {None} and {r.born for r in copy} == {"2001-02-03"}


def declared(spark, *ids):
    doc = {"tenantIdColumn": "tenant_id", "userIdColumn": "user_id", "ownerConnector": "manual", "sourceRedactionStrategy": "ENCRYPTED_COPY", "columns": [{"name": "email", "handling": "ENCRYPT"}]}
    return registry.normalise(registry.parse_resources(spark.createDataFrame([(k, json.dumps(doc | {"id": i})) for k, i in enumerate(ids)], "pos long, value string")))


def test_sync_run_writes_copies_of_new_users_only(spark, people, key_table, tmp_path):
    """Two tables of one name in two datasets have a copy each."""
    resources, state = declared(spark, "bigquery:p.d.users", "bigquery:p.e.users"), sync_state.SyncState(spark, str(tmp_path / "state"))
    run = sync_run.Run(spark, lambda _: people, key_table, str(tmp_path / "v"), "t0", state, str(tmp_path / "copies"))
    for _ in range(2):
        assert [(r.status, r.succeeded, r.reason) for r in run.all(resources).collect()] == [("SYNCED", True, None)] * 2
    assert spark.read.parquet(str(tmp_path / "v")).count() == 8
    for dataset in "de":
        assert spark.read.parquet(str(tmp_path / "copies" / f"p.{dataset}.users_encrypted_raw")).count() == 4


def test_a_copy_that_failed_is_made_up_for(spark, people, key_table, tmp_path, monkeypatch):
    resources, state = declared(spark, "bigquery:p.d.users"), sync_state.SyncState(spark, str(tmp_path / "state"))
    run = sync_run.Run(spark, lambda _: people, key_table, str(tmp_path / "v"), "t0", state, str(tmp_path / "copies"))
    copy = encrypted_copy.wide_copy
    monkeypatch.setattr(encrypted_copy, "wide_copy", lambda *_: 1 / 0)
    assert [(r.status, r.reason) for r in run.all(resources).collect()] == [("SYNCED", "copy: division by zero")]
    monkeypatch.setattr(encrypted_copy, "wide_copy", copy)
    assert [(r.status, r.reason) for r in run.all(resources).collect()] == [("SYNCED", None)]
    assert spark.read.parquet(str(tmp_path / "copies" / "p.d.users_encrypted_raw")).count() == spark.read.parquet(str(tmp_path / "v")).count() == 4


def test_a_failing_resource_says_why(spark, people, key_table, tmp_path):
    def source(resource_id):
        if resource_id.endswith("users"):
            raise RuntimeError("quota of 7 exceeded\nsecond line")
        return people

    state = sync_state.SyncState(spark, str(tmp_path / "state"))
    run = sync_run.Run(spark, source, key_table, str(tmp_path / "v"), "t0", state)
    assert [(r.resource_id[-5:], r.status, r.reason) for r in run.all(declared(spark, "bigquery:p.d.users", "bigquery:p.d.other")).collect()] == [("other", "SYNCED", None), ("users", "ERROR", "quota of 7 exceeded")]
    assert [r.resource_id for r in state.read().collect()] == ["bigquery:p.d.other"]  # a failed one is tried again from where it was


def test_a_run_that_only_writes_units(spark, people, key_table, tmp_path):
    state = sync_state.SyncState(spark, str(tmp_path / "state"))
    run = sync_run.Run(spark, lambda _: people, key_table, str(tmp_path / "v"), "t0", state, units=str(tmp_path / "units"), run_id="r1")
    run.all(declared(spark, "bigquery:p.d.users"))
    rows = spark.read.json(str(tmp_path / "units")).collect()
    assert [(r.run_id, r.resource_id) for r in rows] == [("r1", "bigquery:p.d.users")] and "email" not in rows[0] and not (tmp_path / "v").exists()


def test_runs_that_overlap_never_move_a_mark_back(spark, tmp_path, monkeypatch):
    import datetime as dt

    state = sync_state.SyncState(spark, str(tmp_path / "state"))
    result = lambda name, day: spark.createDataFrame([(name, dt.datetime(2024, 1, day), True, "at")], "resource_id string, started_at timestamp, succeeded boolean, updated_at_column string")
    state.advance(result("a", 5))
    commit, first = state.versions.commit, []

    def interrupted(after, names):
        if not first:  # another run commits between this one's read and its commit
            first.append(after)
            sync_state.SyncState(spark, str(tmp_path / "state")).advance(result("a", 9))
            sync_state.SyncState(spark, str(tmp_path / "state")).advance(result("b", 2))
        return commit(after, names)

    monkeypatch.setattr(state.versions, "commit", interrupted)
    state.advance(result("a", 7))
    assert {r.resource_id: r.last_synced_at.day for r in state.read().collect()} == {"a": 9, "b": 2}
    assert state.versions.newest() == 4


def test_two_writers_make_one_key(spark, tmp_path, monkeypatch):
    mine, other = (keys.KeyTable(spark, str(tmp_path / "keys"), buckets=4) for _ in range(2))
    users = spark.createDataFrame([("t", f"u{i}") for i in range(30)], "tenant_id string, user_id string")
    commit, first = mine.versions.commit, []

    def interrupted(after, names):
        if not first:
            first.append(after)
            other.ensure(users.limit(20))
        return commit(after, names)

    monkeypatch.setattr(mine.versions, "commit", interrupted)
    held = mine.ensure(users)
    assert held.count() == held.select("user_id").distinct().count() == other.read().count() == 30
    assert {r.dek_hex for r in held.collect()} == {r.dek_hex for r in other.read().collect()}


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    table = keys.KeyTable(spark, str(tmp_path / "keys"), buckets=8)
    users = spark.createDataFrame([("t", f"u{i}") for i in range(200)], "tenant_id string, user_id string")
    table.ensure(users)
    one = table.ensure(users.limit(1))
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    read = lambda rows: rows.select(F.input_file_name()).distinct().count()
    assert 0 < one.count() < 60 and read(one) == 1 and read(table.read()) == 8


def test_many_batches_leave_few_files(spark, tmp_path):
    table = keys.KeyTable(spark, str(tmp_path / "keys"), buckets=2)
    for k in range(keys.MERGED + 3):
        table.ensure(spark.createDataFrame([("t", f"u{k}")], "tenant_id string, user_id string"))
    assert table.read().count() == keys.MERGED + 3 and len(table.versions.folders(table.versions.newest())) < keys.MERGED


def test_numbers_have_no_gaps(spark):
    rows = spark.createDataFrame([(g, i * 37 % 1000) for g, n in (("a", 1000), ("b", 1), (None, 40)) for i in range(n)], "g string, v int").repartition(7)
    got = numbering.numbered(rows, ["g"], ["v"]).collect()
    for g in ("a", "b", None):
        own = sorted((r.number, r.v) for r in got if r.g == g)
        assert [n for n, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted(v for _, v in own)


def test_purge_leaves_other_partitions_alone(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"d{i % 3}", f"u{i}", "op" if i in (0, 3) else None if i == 6 else f"o{i}") for i in range(12)], "day string, user_id string, operation_id string")
    path = str(tmp_path / "t")
    sinks.append(rows, path, ["day"])
    files = lambda day: sorted(f.name for f in (tmp_path / "t" / f"day={day}").iterdir() if f.name.endswith(".parquet"))
    before = files("d1"), files("d2")
    finish = sinks.finish_replacing
    calls = []
    monkeypatch.setattr(sinks, "finish_replacing", lambda *a: calls.append(a) or (finish(*a) if len(calls) == 1 else 1 / 0))
    with pytest.raises(ZeroDivisionError):  # interrupted once all is written
        sinks.purge(spark, path, "op")
    assert spark.read.parquet(path).count() == 12
    monkeypatch.setattr(sinks, "finish_replacing", finish)
    sinks.purge(spark, path, "op")
    held = spark.read.parquet(path)
    assert sorted(r.user_id for r in held.collect()) == sorted(f"u{i}" for i in range(12) if i not in (0, 3))
    assert (files("d1"), files("d2")) == before and held.where("operation_id IS NULL").count() == 1
    sinks.purge(spark, path, "nobody's")
    assert spark.read.parquet(path).count() == 10


def test_small_files_are_joined(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"r{i % 3}", f"u{i}", i) for i in range(60)], "resource_id string, user_id string, v int")
    for k in range(5):
        sinks.append(rows.where(f"v % 5 = {k} AND (v % 3 < 2 OR v % 5 = 0)").repartition(2), path, ["resource_id"])
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    alone = [f for f in sinks.parquet_files(spark, path) if f[0].startswith("resource_id=r2")]
    assert compaction.compact(spark, path) > 10
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before
    assert len(sinks.parquet_files(spark, path)) <= 3 and len(alone) >= 1
    assert compaction.compact(spark, path) == 0


def test_a_copy_keeps_its_latest_rows(spark, tmp_path):
    path = str(tmp_path / "copy")
    for k in range(4):
        sinks.append(spark.createDataFrame([(f"u{i}", k * 10 + i, k) for i in range(k, 6)], "user_id string, v int, synced_at int"), path)
    want = sorted(map(tuple, encrypted_copy.latest(spark.read.parquet(path)).collect()))
    compaction.compact(spark, path, latest=("user_id", ("synced_at",)))
    held = spark.read.parquet(path)
    assert sorted((r.user_id, r.v, r.synced_at) for r in held.collect()) == want and len(sinks.parquet_files(spark, path)) == 1


def test_files_are_counted_by_their_bytes(spark, tmp_path):
    """Rows that a shuffle would deal to several tasks make one file if their bytes fit, by partition and of a copy, and else as many as they fill."""
    rows = spark.range(240_000).selectExpr("concat('u', id) AS user_id", "id AS v", "id % 3 AS day")
    for k in range(4):
        sinks.append(rows.where(f"v % 4 = {k}"), str(tmp_path / "raw"), ["day"])
        sinks.append(rows.selectExpr("user_id", f"{k} AS synced_at", "v"), str(tmp_path / "copy"))
        sinks.replace_part(rows.where(f"v % 4 = {k}"), str(tmp_path / "side"), k, 0)
    sizes = lambda name: [size for _, size in sinks.parquet_files(spark, str(tmp_path / name))]
    small = sum(sizes("side"))
    assert compaction.compact(spark, str(tmp_path / "raw"), sum(sizes("raw")) // 3 + 10_000) > 10 and len(sizes("raw")) == 3
    compaction.compact(spark, str(tmp_path / "copy"), sum(sizes("copy")) // 2, latest=("user_id", ("synced_at",)))
    assert len(sizes("copy")) == 1
    compaction.merge_batches(spark, str(tmp_path / "side"), small, open_=0)
    assert len(sizes("side")) == 1
    sinks.append(rows.repartition(16), str(tmp_path / "raw"), ["day"])
    compaction.compact(spark, str(tmp_path / "raw"), max(sizes("raw")) // 2)
    assert 6 < len(sizes("raw")) <= 12
    assert spark.read.parquet(str(tmp_path / "raw")).agg(F.count("*"), F.sum("v")).first()[:] == (480_000, 240_000 * 239_999)
    assert spark.read.parquet(str(tmp_path / "copy")).agg(F.count("*"), F.min("synced_at"), F.sum("v")).first()[:] == (240_000, 3, 120_000 * 239_999)


def test_closed_batches_are_merged(spark, tmp_path):
    path = str(tmp_path / "side")
    part = lambda n: spark.createDataFrame([(n, f"x{i}") for i in range(3)], "n int, v string")
    for n in range(6):
        sinks.replace_part(part(n), path, n, 0)
        sinks.replace_part(part(n + 100), path, n, 1)
    assert compaction.merge_batches(spark, path) >= 8
    sinks.replace_part(part(5), path, 5, 0)  # the newest may come again
    rows = spark.read.parquet(path)
    assert rows.count() == 36 and sorted(r.batch for r in rows.select("batch").distinct().collect()) == [-1, 4, 5]
    assert len([f for f in sinks.parquet_files(spark, path) if f[0].startswith("batch=-1")]) == 1


def test_incremental_rules(spark):
    import datetime as dt

    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (None, dt.datetime(2024, 1, 3))], "id long, at timestamp")
    ids = lambda **k: sorted(r.user_id for r in vault_sync.changed_users(rows, "id", **k).collect())
    mark = dt.datetime(2024, 1, 2)
    assert ids(updated_column="at", last_synced=mark) == ["2"]
    assert ids(updated_column="at", last_synced=mark, force_full=True) == ids(last_synced=mark) == ids(updated_column="at") == ["1", "2"]


@pytest.mark.parametrize("users,sizes", [(250, [100, 100, 50]), (100, [100]), (101, [100, 1]), (0, [])])
def test_units_are_full_but_for_the_last(spark, users, sizes):
    rows = spark.range(users).select(F.lit("r").alias("resource_id"), F.col("id").cast("string").alias("user_id")).repartition(5)
    units = vault_sync.work_units(rows.unionByName(rows)).orderBy("unit").collect()
    assert [len(u.user_ids) for u in units] == sizes and [u.unit for u in units] == list(range(len(sizes)))
    assert [i for u in units for i in u.user_ids] == sorted(str(i) for i in range(users))


@pytest.mark.parametrize("cell,kind", [(" a@b.co ", "EMAIL"), ("+1 (415) 555-0100", "PHONE"), ("Ada King Lovelace", "NAME"), ("Ada", None), ("12345", None), ("", None), (None, None), (" a@b.co ", "EMAIL"), ("a@b", None), ("O'Neil Shaw", None)])
def test_classify(spark, cell, kind):
    assert spark.createDataFrame([(cell,)], "v string").select(text.classify(F.col("v"))).first()[0] == kind


def test_disabled_pattern_has_no_successor(spark):
    rows = spark.createDataFrame([("a@b.co", "+1 415 555 0100")], "notes string, other string")
    got = ghost_scan.findings(rows, set(), ["PHONE"]).collect()
    assert [tuple(r) for r in got] == [("other", "PHONE", 1)]
    assert ghost_scan.findings(rows, {"notes", "other"}).collect() == []


@pytest.mark.parametrize("pattern,name,hit", [("tmp_*", "tmp_a", True), ("tmp_*", "TMP_a", False), ("t?", "ab", False), ("t[!a-c]x", "tdx", True), ("t[!a-c]x", "tbx", False), ("a.b", "axb", False), ("[", "[", True), ("a[]]b", "a]b", True), ("a\\b", "a\\b", True)])
def test_globs(spark, pattern, name, hit):
    import fnmatch

    assert fnmatch.fnmatchcase(name, pattern) == hit
    got = spark.createDataFrame([("ds", name)], "s string, t string").select(text.excluded(F.col("s"), F.col("t"), [pattern])).first()[0]
    assert got == hit


def test_redaction_at_any_depth(spark):
    doc = {"Email": "x", "n": 1, "deep": [{"full_name": "y", "ok": [1, {"ssn": 2}]}], "table_name": "t"}
    got = spark.createDataFrame([(json.dumps(doc),), (None,), ("no json a@b.com",)], "v string").select(lineage.redact_json("v").alias("v")).collect()
    assert json.loads(got[0].v) == {"Email": "<redacted>", "n": 1, "deep": [{"full_name": "<redacted>", "ok": [1, {"ssn": "<redacted>"}]}], "table_name": "<redacted>"}
    assert got[1].v is None and got[2].v == "<redacted>"


def test_new_keys_are_random_and_only_for_users_without_one(spark, people, some_keys):
    made = keys.new_keys(people, some_keys)
    a, b = written(made, "keys").collect(), written(made, "keys").collect()
    assert {(r.tenant_id, r.user_id) for r in a} == {("t1", "u2")}
    assert a[0].dek_hex != b[0].dek_hex and len(a[0].dek_hex) == 64


def test_discovery_of_a_missing_place(spark, tmp_path):
    assert discovery.read_locations(spark, [str(tmp_path / "gone")]).count() == 0


def test_crawl_statuses(spark):
    catalog = spark.createDataFrame([("p", "d", "a", "x", 1), ("p", "d", "b", "y", 2), ("p", "d", "b", "x", 1), ("p", "d", "c", "x", 1), ("p", "d", "tmp", "x", 1)], "table_catalog string, table_schema string, table_name string, column_name string, ordinal_position int")
    known = spark.createDataFrame([("bigquery:p.d.a", "x"), ("bigquery:p.d.b", "x"), ("bigquery:p.d.b", "gone")], "resource_id string, column_name string")
    got = {r.table_name: (r.status, r.new_columns, r.missing_columns) for r in catalog_drift.crawl(catalog, known, ["tmp*"]).collect()}
    assert got == {"a": ("REGISTERED", [], []), "b": ("DRIFTED", ["y"], ["gone"]), "c": ("UNREGISTERED", ["x"], [])}


def test_registry_file(spark, tmp_path):
    doc = {"version": 3, "resources": [{"id": "bigquery:a.b.c", "tenantIdColumn": "t", "columns": [{"name": "email", "classification": "DIRECT_IDENTIFIER"}]}, {"resource_id": "x", "pii_fields": []}]}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    got = registry.normalise(registry.read_documents(spark, str(tmp_path / "r.json"))).orderBy("pos").collect()
    assert [(r.id, r.type, r.system, r.tenant_scoped) for r in got] == [("bigquery:a.b.c", "bigquery_table", "bigquery", True), ("x", "external", None, False)]
    assert registry.file_version(registry.read_documents(spark, str(tmp_path / "r.json"))).first().version == 3


def test_approval_under_another_key(spark, tmp_path):
    node = lambda key: {"resource_type": "model", "name": "m", "schema": "s", "meta": {key: {"mart_manual_review_approved": True}}}
    (tmp_path / "m.json").write_text(json.dumps({"nodes": {"a": node("privacy"), "b": node("other")}}))
    approved = lambda **k: {r.node_id: r.approved for r in manifest.read_models(spark, str(tmp_path / "m.json"), **k).collect()}
    assert approved() == {"a": True, "b": False} and approved(meta_key="other") == {"a": False, "b": True}


def test_times_as_iso_text(spark):
    import datetime as dt

    at = [dt.datetime(2024, 1, 2, 3, 4, 5, 123456), dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120000), None]
    rows = spark.createDataFrame([(a,) for a in at], "t timestamp_ntz")
    got = [tuple(r) for r in rows.select(text.json_safe(F.col("t"), "timestamp_ntz"), text.json_safe(F.col("t").cast("timestamp"), "timestamp")).collect()]
    assert got == [(a and a.isoformat(), a and f"{a.isoformat()}+00:00") for a in at]


def test_keys_are_made_once(spark, people, key_table):
    for _ in range(2):
        key_table.ensure(people)
    assert sorted((r.tenant_id, r.user_id) for r in key_table.read().collect()) == [("t1", "u1"), ("t1", "u2"), ("t1", "u4"), ("t1", "u5"), ("t2", "u1")]
