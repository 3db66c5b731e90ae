"""Landing files are taken once, deleted when good and moved when bad; messages and units may come again."""

import os

import pytest
from pyspark.sql import functions as F

from shroud.functions import crypto
from shroud.operators import keys as K
from shroud.operators import vault_sync as S
from shroud.streaming import landing as T

DEK = "ab" * 32


def some_keys(spark, path):
    """Keys of u0 to u5, the last one shredded."""
    rows = [("t1", f"u{i}", "v1", "v2", DEK, "SHREDDED" if i == 5 else "ACTIVE") for i in range(6)]
    table = K.KeyTable(spark, str(path))
    table.add(spark.createDataFrame(rows, K.KEY_SCHEMA))
    return table


def test_landing_files(spark, tmp_path):
    inbound, failed = tmp_path / "inbound", tmp_path / "failed"
    inbound.mkdir()
    (inbound / "a.csv").write_text("user_id,email\nu1,a@b.com\nu9,new@user.com\nu5,gone@user.com\n")
    (inbound / "b.csv").write_text("email,plan,user_id\nc@d.com,x,u2\nNA,y,u3\n")
    (inbound / "c.json").write_text('{"user_id": "u4", "email": "e@f.com"}\n{broken\n')
    (inbound / "bad.csv").write_text("userId,age\nu5,3\n")
    (inbound / "empty.csv").write_text("")
    (inbound / "note.txt").write_text("u5")
    keys, side = some_keys(spark, tmp_path / "keys"), str(tmp_path / "side")
    sink = T.landing_batch("t1", keys, ["email"], str(tmp_path / "out"), str(failed), side, "landing")
    for _ in range(2):
        T.watch_landing(spark, str(inbound), str(tmp_path / "check"), sink, files_per_trigger=2).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    held = rows.join(K.live(keys.read()).select(*K.KEY, "dek_hex"), K.KEY)
    opened = {r.user_id: r.v for r in held.select("user_id", crypto.open_bundle(F.decode("encrypted_pii", "UTF-8"), F.col("dek_hex"), F.col("user_id")).alias("v")).collect()}
    assert opened == {"u1": "a@b.com", "u2": "c@d.com", "u4": "e@f.com", "u9": "new@user.com"}  # a new user has a key and a record, a shredded one has neither
    assert [r.status for r in keys.read().where("user_id = 'u9'").collect()] == ["ACTIVE"] and keys.read().where("user_id = 'u5'").count() == 1
    assert rows.select("operation_id").distinct().count() == 3
    lost = {(r.user_id, r.reason) for r in spark.read.parquet(f"{side}/quarantine").collect()}
    assert lost == {("u3", "missing_field"), ("u5", "no_live_key"), (None, "malformed_line")}
    kinds = {r.event_type: r["count"] for r in spark.read.parquet(f"{side}/lineage").groupBy("event_type").count().collect()}
    assert kinds == {"DATA_READ": 3, "DATA_PUBLISHED_TO_TOPIC": 3, "DATA_ENCRYPTED": 4, "DATA_PROVISIONED_TO_SINK": 4}
    assert sorted(os.listdir(inbound)) == ["empty.csv", "note.txt"] and {"bad.csv"} <= {f for f in os.listdir(failed) if not f.startswith(".")}


def landing_sink(spark, tmp_path, fields=("email",)):
    keys, side, out = some_keys(spark, tmp_path / "keys"), str(tmp_path / "side"), str(tmp_path / "out")
    return keys, side, out, T.landing_batch("t1", keys, list(fields), out, str(tmp_path / "failed"), side, "landing")


def files_of(spark, tmp_path, *names):
    return spark.createDataFrame([(f"file:{tmp_path}/{n}",) for n in names], "path string")


def test_a_landing_batch_that_comes_again(spark, tmp_path, monkeypatch):
    """A batch that fails while its side tables are written is written again whole; one that fails later only disposes of its files."""
    (tmp_path / "a.csv").write_text("user_id,email\nu1,a@b.com\nu9,new@user.com\n")
    keys, side, out, sink = landing_sink(spark, tmp_path)
    written = T.sinks.put_text
    monkeypatch.setattr(T.sinks, "put_text", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sink(files_of(spark, tmp_path, "a.csv"), 0)
    assert (tmp_path / "a.csv").exists()
    monkeypatch.setattr(T.sinks, "put_text", written)
    sink(files_of(spark, tmp_path, "a.csv"), 0)
    assert not (tmp_path / "a.csv").exists()
    assert spark.read.parquet(out).count() == 2 and keys.read().where("user_id = 'u9'").count() == 1
    assert spark.read.parquet(f"{side}/lineage").count() == 6


def test_a_landing_batch_that_stops_between_its_files(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("user_id,email\nu1,a@b.com\nu2,NA\n")
    (tmp_path / "b.json").write_text('{"user_id": "u3", "email": "c@d.com"}\n')
    (tmp_path / "c.csv").write_text("user_id,age\nu3,1\n")
    _, side, out, sink = landing_sink(spark, tmp_path)
    dispose, calls = T.dispose, []

    def second_fails(*given):
        calls.append(given)
        if len(calls) == 2:
            raise OSError("no such host")
        dispose(*given)

    monkeypatch.setattr(T, "dispose", second_fails)
    with pytest.raises(OSError):
        sink(files_of(spark, tmp_path, "a.csv", "b.json", "c.csv"), 0)
    assert not (tmp_path / "a.csv").exists() and (tmp_path / "b.json").exists()
    sink(files_of(spark, tmp_path, "b.json", "c.csv"), 0)  # what is still there
    assert sorted(f for f in os.listdir(tmp_path / "failed") if not f.startswith(".")) == ["c.csv"] and not (tmp_path / "b.json").exists()
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == ["u1", "u3"]
    assert [(r.user_id, r.reason) for r in spark.read.parquet(f"{side}/quarantine").collect()] == [("u2", "missing_field")]
    events = spark.read.parquet(f"{side}/lineage")
    assert events.count() == 8 and {r.source.rpartition("/")[2] for r in events.where("event_type = 'DATA_READ'").collect()} == {"a.csv", "b.json"}


def test_a_sink_that_fails_keeps_the_files(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("user_id,email\nu1,a@b.com\n")
    _, _, out, sink = landing_sink(spark, tmp_path)
    append = T.sinks.append_once
    monkeypatch.setattr(T.sinks, "append_once", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sink(files_of(spark, tmp_path, "a.csv"), 0)
    assert (tmp_path / "a.csv").exists() and not (tmp_path / "failed").exists()
    monkeypatch.setattr(T.sinks, "append_once", append)
    sink(files_of(spark, tmp_path, "a.csv"), 0)
    assert spark.read.parquet(out).count() == 1 and not (tmp_path / "a.csv").exists()


def test_cells_with_line_breaks_and_rows_with_a_cell_too_many(spark, tmp_path):
    (tmp_path / "a.csv").write_text('user_id,email,n\nu1,a@b.com,1\nu2,"c@\nd.com",2\nu3,"say ""hi""\n, twice",3\nu4,e@f.com,4,EXTRA\nu0,g@h.com\n')
    (tmp_path / "b.csv").write_text("user_id,email,n\nu5,x@y.com,1,2,3\n")
    keys, side, out, sink = landing_sink(spark, tmp_path)
    sink(files_of(spark, tmp_path, "a.csv", "b.csv"), 0)
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == ["u0", "u1"]
    lost = sorted(((r.user_id, r.reason) for r in spark.read.parquet(f"{side}/quarantine").collect()), key=str)
    assert lost == [("u2", "malformed_email"), ("u3", "malformed_email"), (None, "malformed_line"), (None, "malformed_line")]
    assert keys.read().count() == 6  # no piece of a cell became a user


def test_one_stream_serves_all_tenants(spark, tmp_path):
    for tenant, user in (("t1", "u1"), ("t2", "u1"), ("t2", "u7")):
        folder = tmp_path / "in" / tenant
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{user}.csv").write_text(f"user_id,email\n{user},{user}@{tenant}.com\n")
    keys, out = some_keys(spark, tmp_path / "keys"), str(tmp_path / "out")
    sink = T.landing_batch(lambda path: F.element_at(F.split(path, "/"), -2), keys, ["email"], out, str(tmp_path / "failed"), str(tmp_path / "side"), "landing")
    T.watch_landing(spark, str(tmp_path / "in" / "*"), str(tmp_path / "check"), sink).awaitTermination()
    assert sorted((r.tenant_id, r.user_id) for r in spark.read.parquet(out).collect()) == [("t1", "u1"), ("t2", "u1"), ("t2", "u7")]
    assert keys.read().where("tenant_id = 't2'").count() == 2


def test_records_come_twice(spark, tmp_path):
    source = tmp_path / "m"
    source.mkdir()
    good = '{"tenant_id":"t1","user_id":"u1","encrypted_pii":"YWJj","operation_id":"o1","ingested_at":"2024-05-06T01:02:03+00:00","pii_fields":[{"field_name":"email","token":"x","encrypted_value":"YWJj"}]}'
    lines = [good, good.replace("YWJj", "%%%"), good.replace("u1", "u2").replace("2024", "2023"), '{"user_id":"u3"}', "{broken"]
    for name in "ab":
        (source / f"{name}.txt").write_text("\n".join(lines) + "\n")
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    T.take_records(T.parse_records(spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))), str(tmp_path / "check"), out, dead)
    rows = sorted(spark.read.parquet(out).collect(), key=lambda r: r.user_id)
    assert [(r.user_id, bytes(r.encrypted_pii), bytes(r.pii_fields[0].encrypted_value), str(r.day)) for r in rows] == [("u1", b"abc", b"abc", "2024-05-06"), ("u2", b"abc", b"abc", "2023-05-06")]
    assert spark.read.parquet(dead).agg(F.sum("n")).first()[0] == 6


def test_messages_come_twice(spark, tmp_path):
    source = tmp_path / "m"
    source.mkdir()
    good = '{"header_tenant":"","body_tenant":"t1","user_id":"u1","payload":{"email":"a@b.com"},"operation_id":"o1"}'
    lines = [good, '{"user_id":"u2","payload":{"email":"x@y.com"},"operation_id":"o2"}', '{"header_tenant":"t1","user_id":"u3","payload":{},"operation_id":"o3"}', "{broken"]
    for name in "ab":
        (source / f"{name}.txt").write_text("\n".join(lines) + "\n")
    out, events, dead = (str(tmp_path / n) for n in ("out", "events", "dead"))
    T.take_messages(T.parse_messages(spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))), str(tmp_path / "check"), some_keys(spark, tmp_path / "keys"), out, events, dead)
    assert [(r.tenant_id, r.user_id, r.operation_id) for r in spark.read.parquet(out).collect()] == [("t1", "u1", "o1")]
    assert [tuple(r.payload_keys) for r in spark.read.parquet(events).collect()] == [("email",)]
    reasons = {r.reason: r.n for r in spark.read.parquet(dead).groupBy("reason").agg(F.sum("n").alias("n")).collect()}
    assert reasons == {"missing_tenant": 2, "missing_email": 2, "malformed": 2}


def test_units_come_twice(spark, tmp_path):
    source = spark.createDataFrame([("t1", f"u{i}", f"m{i}@x.org") for i in range(6)], "tenant_id string, user_id string, email string")
    units = spark.createDataFrame([("r", ["u1", "u2"]), ("gone", ["u3"]), ("r", ["u2", "u5"])], "resource_id string, user_ids array<string>")
    keys = some_keys(spark, tmp_path / "keys")
    sink = T.unit_batch({"r": (source, ["email"])}, keys, str(tmp_path / "vault"), "t0", str(tmp_path / "outcomes"))
    for batch in range(2):
        sink(units, batch)
    vault = spark.read.parquet(str(tmp_path / "vault"))
    assert sorted(r.user_id for r in vault.collect()) == ["u1", "u2"]  # u5's key is shredded
    assert keys.read().count() == 6
    settled = S.settled(spark.read.schema(S.OUTCOME).parquet(str(tmp_path / "outcomes")))
    assert sorted((r.resource_id, r.status) for r in settled.collect()) == [("gone", "DROPPED"), ("r", "COMPLETED"), ("r", "COMPLETED")]


def test_a_unit_that_fails_stands_alone(spark, tmp_path):
    rows = spark.createDataFrame([("t1", f"u{i}", f"m{i}@x.org") for i in range(40)], "tenant_id string, user_id string, email string")
    source = rows.withColumn("email", F.when(F.col("user_id") == "u13", F.raise_error(F.lit("bad cell"))).otherwise(F.col("email")))
    units = spark.createDataFrame([("run", r, [f"u{i}", f"u{i + 1}"]) for r in ("bad", "good") for i in range(0, 40, 2)], "run_id string, resource_id string, user_ids array<string>")
    paths = [str(tmp_path / p) for p in ("vault", "outcomes", "dead", "copies")]
    sources = {"bad": (source, ["email"]), "good": (lambda: rows, ["email"])}
    T.unit_batch(sources, some_keys(spark, tmp_path / "keys"), paths[0], "t0", *paths[1:], tries=1)(units, 0)
    held = spark.read.parquet(paths[0]).groupBy("resource_id").count().collect()
    assert {r.resource_id: r["count"] for r in held} == {"bad": 37, "good": 39}  # u5's key is shredded
    progress = S.run_progress(S.settled(spark.read.schema(S.OUTCOME).parquet(paths[1]))).collect()
    assert [tuple(r) for r in progress] == [("run", 40, 39, 1)]
    assert "bad cell" in spark.read.schema(S.OUTCOME).parquet(paths[1]).where("status = 'FAILED'").first().error
    again = spark.read.schema(units.schema).json(paths[2])
    assert [r.user_ids for r in again.collect()] == [["u12", "u13"]]
    T.unit_batch({"bad": (rows, ["email"])}, some_keys(spark, tmp_path / "keys"), paths[0], "t0", *paths[1:])(again, 1)
    assert spark.read.parquet(paths[0]).where("resource_id = 'bad'").count() == 39
    assert [r.failed for r in S.run_progress(S.settled(spark.read.schema(S.OUTCOME).parquet(paths[1]))).collect()] == [0]
    assert [spark.read.parquet(f"{paths[3]}/{r}_encrypted_raw").count() for r in ("bad", "good")] == [39, 39]


def test_a_bad_row_fails_its_unit_only_when_joins_shuffle(spark, tmp_path):
    """Nothing is small enough to be sent to all tasks, so a join reads all rows of its sides."""
    rows = spark.range(400).selectExpr("'t1' AS tenant_id", "concat('u', id) AS user_id", "concat('m', id, '@x.org') AS email")
    source = rows.withColumn("email", F.when(F.col("user_id").isin("u130", "u391"), F.raise_error(F.lit("bad cell"))).otherwise(F.col("email")))
    units = spark.createDataFrame([("run", "bad", [f"u{i + k}" for k in range(10)]) for i in range(0, 400, 10)], "run_id string, resource_id string, user_ids array<string>")
    vault, outcomes, dead = (str(tmp_path / p) for p in ("vault", "outcomes", "dead"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    try:
        T.unit_batch({"bad": (source, ["email"])}, some_keys(spark, tmp_path / "keys"), vault, "t0", outcomes, dead, tries=1)(units, 0)
    finally:
        spark.conf.unset(setting)
    assert spark.read.parquet(vault).count() == 379  # u5's key is shredded
    assert {r.user_ids[0] for r in spark.read.json(dead).collect()} == {"u130", "u390"}
    assert spark.read.schema(S.OUTCOME).parquet(outcomes).where("status = 'COMPLETED'").count() == 38


def test_a_stream_remembers_what_it_took(spark, tmp_path):
    """The same message in a later run of the stream adds nothing, and no batch reads the table of records."""
    source = tmp_path / "m"
    source.mkdir()
    line = '{"header_tenant":"t1","user_id":"u%d","payload":{"email":"a@b.com"},"operation_id":"o1"}'
    out, events, dead = (str(tmp_path / n) for n in ("out", "events", "dead"))
    keys = some_keys(spark, tmp_path / "keys")
    for k, users in enumerate([(1, 2), (2, 3), (3, 1)]):
        (source / f"{k}.txt").write_text("\n".join(line % u for u in users) + "\n")
        T.take_messages(T.parse_messages(spark.readStream.text(str(source))), str(tmp_path / "check"), keys, out, events, dead)
        if k == 1:
            (tmp_path / "out" / "batch=0").rename(tmp_path / "aside")  # the table is not what is asked
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == ["u3"]
    assert sorted(r.user_id for r in spark.read.parquet(str(tmp_path / "aside")).collect()) == ["u1", "u2"]


def test_messages_that_share_an_operation(spark, tmp_path):
    message = lambda tenant, user: f'{{"header_tenant":"{tenant}","user_id":"{user}","payload":{{"email":"{user}@b.com"}},"operation_id":"o1"}}'
    keys = some_keys(spark, tmp_path / "keys")
    keys.add(keys.read().withColumn("tenant_id", F.lit("t2")))
    source, want = tmp_path / "m", [("t1", "u1", "o1"), ("t1", "u2", "o1"), ("t2", "u1", "o1")]
    source.mkdir()
    for name, lines in {"a": want[:2], "b": want, "c": want[1:]}.items():
        (source / f"{name}.txt").write_text("\n".join(message(t, u) for t, u, _ in lines) + "\n")
    out, events, dead = (str(tmp_path / n) for n in ("out", "events", "dead"))
    T.take_messages(T.parse_messages(spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))), str(tmp_path / "check"), keys, out, events, dead)
    for path in (out, events):
        assert sorted((r.tenant_id, r.user_id, r.operation_id) for r in spark.read.parquet(path).collect()) == want


def test_landing_files_grow_in_number_not_in_size():
    from shroud.plans import streams

    assert streams._rounds(15) == streams._rounds(15_000) == 3
    assert all(users / streams._rounds(users) <= streams.ROUND for users in (900_000, 5_400_001))
