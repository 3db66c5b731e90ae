"""Structured Streaming forms of the jobs: landing files, single messages, and work units for the vault.

Every sink is a foreachBatch that adds only what its table doesn't hold yet, or takes the place of what the same batch wrote before, so a batch that comes again adds nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shroud.operators import encrypted_copy as C
from shroud.operators import keys as K
from shroud.operators import lineage as L
from shroud.operators import protect as P
from shroud.operators import vault_sync as S
from shroud.sources import landing, sinks

FILE = "path string, modificationTime timestamp, length long, content binary"
PII_FIELDS = "array<struct<field_name:string,token:string,encrypted_value:binary>>"
RECORD = (
    "tenant_id string, user_id string, email_token string, encryption_version string, key_id string, encrypted_pii string, data_hash string, operation_id string, "
    "ingested_at string, source_system string, pii_fields array<struct<field_name:string,token:string,encrypted_value:string>>"
)
#: Users that can't be read which a batch of units looks for before its units are halved instead.
SEARCHED = 1000
MESSAGE = "header_tenant string, body_tenant string, user_id string, payload map<string,string>, operation_id string"


def _paths(batch: DataFrame) -> list[str]:
    """Files of a batch: as many as maxFilesPerTrigger allows."""
    return [r.path for r in batch.select("path").distinct().collect()]


def dispose(spark: SparkSession, path: str, failed_dir: str | None = None) -> None:
    """Deletes a file that was taken, or moves it to a folder for failed ones; one that is gone already is passed over."""
    fs, source = sinks.hadoop_path(spark, path)
    if failed_dir is None:
        fs.delete(source, False)
    elif fs.exists(source):
        _, target = sinks.hadoop_path(spark, failed_dir)
        fs.mkdirs(target)
        _, place = sinks.hadoop_path(spark, f"{failed_dir}/{source.getName()}")
        fs.rename(source, place)


def landing_batch(tenant_id: str | Callable[[Column], Column], keys: K.KeyTable, fields: list[str], out: str, failed_dir: str, side: str, source_system: str, topic: str = "raw_users") -> Callable[[DataFrame, int], None]:
    """Protects all new files of a batch at once and appends their records; good files are deleted, bad ones moved, and neither stops the others.

    ``tenant_id`` is a tenant, or what gives it from a file's path, so one stream serves all tenants.
    Users without a key get one before their rows are protected. Below ``side`` stand, for each batch,
    ``quarantine`` (file, user_id and reason of each row that gave no record, a line that isn't JSON, a CSV row
    with more cells than the header and a user whose key is gone among them; never a value) and ``lineage``
    (two events for each record and two for each file).

    A first job reads the files' headers. Files that lack a declared column are set aside, and those
    of one suffix and header are read together. Only if they can't be read are they read one by one, to find
    the bad ones; a sink that fails makes the batch fail, which comes again whole. No file goes before all of
    the batch is written, and first the list of what becomes of each file is: a batch that comes again replaces its
    side tables and adds no record twice, and one whose list stands only finishes it.
    """

    own = f"tenant={tenant_id if isinstance(tenant_id, str) else 'by-path'}"

    def readable(spark: SparkSession, paths: list[str], kind: tuple) -> DataFrame | None:
        suffix, columns, breaks = kind
        rows = landing.read_files(spark, paths, suffix, list(columns), fields, breaks).withColumn("tenant_id", F.lit(tenant_id) if isinstance(tenant_id, str) else tenant_id(F.col("file"))).persist()
        try:
            rows.count()
        except Exception:  # noqa: BLE001  nothing is written here, so it is the input that is bad
            rows.unpersist()
            return None
        return rows

    def take(spark: SparkSession, rows: DataFrame, batch_id: int, part: int) -> None:
        try:
            good = rows.where("NOT bad")
            held = keys.ensure(good)
            records = P.protect(good, held, fields, F.col("operation_id"), source_system, keep=("day", "file"))
            staged = f"{side}/staged/{own}/batch={batch_id}/part={part}"  # ciphertext is random: all that follows reads the same
            records.write.mode("overwrite").parquet(staged)
            records = spark.read.schema(records.schema).parquet(staged)
            sinks.append_once(records.drop("file"), out, ["tenant_id", "user_id", "operation_id"], "day")
            gone = K.without_key(P.accepted(good, fields), held).select("file", "operation_id", "user_id", F.lit("no_live_key").alias("reason"))
            broken = rows.where("bad").select("file", "operation_id", F.lit(None).cast("string").alias("user_id"), F.lit("malformed_line").alias("reason"))
            sinks.replace_part(P.quarantine(good, fields, "file", "operation_id").unionByName(gone).unionByName(broken), f"{side}/quarantine/{own}", batch_id, part)
            figures = L.batch_figures(good, records, ("tenant_id", "file", "operation_id")).withColumnRenamed("file", "source")
            events = L.batch_events(figures, topic).unionByName(L.row_events(records, F.col("file"), topic))
            sinks.replace_part(events, f"{side}/lineage/{own}", batch_id, part)
            fs, place = sinks.hadoop_path(spark, staged)
            fs.delete(place, True)
        finally:
            rows.unpersist()

    def write(spark: SparkSession, paths: list[str], batch_id: int) -> dict[str, bool]:
        """Writes all that the files give; for each file whether it was good."""
        groups: dict[tuple, list[str]] = {}
        tables = [p for p in paths if p.endswith(".csv")]
        found = {r.path: r for r in landing.headers(spark, tables).collect()} if tables else {}
        good = dict.fromkeys(paths, True)
        for path in paths:
            columns = landing.header_columns(found[path].header if path in found else "") if path.endswith(".csv") else None
            if columns is not None and P.missing_columns(columns, fields):
                good[path] = False
            else:
                groups.setdefault((".csv" if columns is not None else ".json", tuple(columns or ()), path in found and found[path].breaks), []).append(path)
        for kind, group in groups.items():
            rows = readable(spark, group, kind)
            for some in [group] if rows is not None else [[p] for p in group]:
                rows = rows if rows is not None else readable(spark, some, kind)
                if rows is None:
                    good[some[0]] = False
                else:
                    take(spark, rows, batch_id, paths.index(some[0]))
                rows = None
        return good

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, listed = batch.sparkSession, f"{side}/batches/{own}/{batch_id}"
        if not sinks.exists(spark, listed):
            sinks.put_text(spark, listed, json.dumps(write(spark, sorted(_paths(batch)), batch_id)))
        for path, good in json.loads(sinks.get_text(spark, listed)).items():
            dispose(spark, path, None if good else failed_dir)

    return run


def watch_landing(spark: SparkSession, inbound: str, checkpoint: str, sink: Callable[[DataFrame, int], None], files_per_trigger: int = 1000) -> StreamingQuery:
    """A query over new .csv and .json files of a folder. Only their names are read by the stream; a batch reads the files themselves. Files without a byte are not seen."""
    names = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.{csv,json}").option("maxFilesPerTrigger", files_per_trigger).load(inbound).select("path")
    return names.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parse_messages(lines: DataFrame) -> DataFrame:
    """Messages of JSON lines (column ``value``); a line that isn't one has null fields and ``bad`` is true."""
    parsed = F.from_json("value", MESSAGE + ", _corrupt_record string", {"mode": "PERMISSIVE"})
    return lines.select(parsed.alias("m")).select("m.*").withColumn("bad", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


#: What names a message or a record, however often it is delivered.
ONCE = ["tenant_id", "user_id", "operation_id"]


def once(stream: DataFrame) -> DataFrame:
    """Rows of a stream the first time that their ONCE comes, by state that the stream keeps on disk beside its checkpoint: a batch looks up its own keys only, whatever was delivered before."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    if stream.sparkSession.conf.get(setting, "").endswith("HDFSBackedStateStoreProvider") or not stream.sparkSession.conf.get(setting, ""):
        stream.sparkSession.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return stream.dropDuplicates(ONCE)


def message_batch(keys: K.KeyTable, out: str, events: str) -> Callable[[DataFrame, int], None]:
    """Records and lineage of a batch of taken messages, each written in place of what the same batch wrote before.

    Users without a key get one; a shredded user's message gives neither record nor event.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        held = keys.ensure(batch)
        sinks.replace_part(P.single_messages(batch, held), out, batch_id, 0)
        taken = batch.join(K.live(held).select(*K.KEY), K.KEY, "left_semi")
        sinks.replace_part(L.message_events(taken, out, "tenant_id"), events, batch_id, 0)
        batch.unpersist()

    return run


def rejected_batch(dead: str) -> Callable[[DataFrame, int], None]:
    """Of messages that can't be taken a count by reason, never their text."""

    def run(batch: DataFrame, batch_id: int) -> None:
        reasons = batch.where("NOT bad").transform(P.rejected_messages).select("reason").unionByName(batch.where("bad").select(F.lit("malformed").alias("reason")))
        sinks.replace_part(reasons.groupBy("reason").agg(F.count("*").alias("n")), dead, batch_id, 0)

    return run


def take_messages(messages: DataFrame, checkpoint: str, keys: K.KeyTable, out: str, events: str, dead: str) -> None:
    """All messages that are available now: those that can be taken once for their tenant, user and operation, and counts of the others."""
    run_once(once(P.taken_messages(messages.where("NOT bad"))), f"{checkpoint}/taken", message_batch(keys, out, events))
    run_once(messages, f"{checkpoint}/rejected", rejected_batch(dead))


def parse_records(lines: DataFrame) -> DataFrame:
    """Protected records of JSON lines in wire form (column ``value``), with base64 as bytes again and the ``day`` of their ingestion; ``bad`` is true for a line that isn't one, or whose base64 isn't."""
    parsed = F.from_json("value", RECORD + ", _corrupt_record string", {"mode": "PERMISSIVE"})
    opened = lambda c: F.try_to_binary(c, F.lit("base64"))
    fields = F.transform("pii_fields", lambda f: F.struct(f["field_name"].alias("field_name"), f["token"].alias("token"), opened(f["encrypted_value"]).alias("encrypted_value")))
    rows = lines.select(parsed.alias("m")).select("m.*").withColumn("raw", F.col("encrypted_pii")).withColumn("encrypted_pii", opened(F.col("raw"))).withColumn("pii_fields", F.coalesce(fields, F.array().cast(PII_FIELDS)))
    whole = F.col("user_id").isNotNull() & F.col("operation_id").isNotNull() & F.col("ingested_at").isNotNull() & F.col("encrypted_pii").isNotNull() & F.forall("pii_fields", lambda f: f["encrypted_value"].isNotNull())
    day = F.try_to_timestamp(F.substring("ingested_at", 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    return rows.withColumn("day", day).withColumn("bad", F.col("_corrupt_record").isNotNull() | ~whole | F.col("day").isNull()).drop("_corrupt_record", "raw")


def take_records(records: DataFrame, checkpoint: str, out: str, dead: str) -> None:
    """All records in wire form that are available now into the raw table, each once for its tenant, user and operation, however often it is delivered; of malformed ones a count is left.

    What a batch writes takes the place of what the same batch wrote before, by day, and no batch reads the table.
    """
    good = records.where("NOT bad").drop("bad").withColumn("tenant_id", F.coalesce("tenant_id", F.lit("")))
    run_once(once(good), f"{checkpoint}/taken", lambda batch, n: sinks.replace_part(batch, out, n, 0, ["day"]))
    counted = lambda batch, n: sinks.replace_part(batch.groupBy(F.lit("malformed").alias("reason")).agg(F.count("*").alias("n")), dead, n, 0)
    run_once(records.where("bad"), f"{checkpoint}/rejected", counted)


def unit_batch(sources: dict[str, tuple[DataFrame | Callable[[], DataFrame], list[str]]], keys: K.KeyTable, vault: str, default_tenant: str, outcomes: str, dead: str | None = None, copies: str | None = None, tries: int = 2) -> Callable[[DataFrame, int], None]:
    """Vault rows of work units (run_id, resource_id, user_ids): the users' source rows are read again and only missing fields are added.

    Every unit of a batch leaves an outcome (S.OUTCOME): COMPLETED, FAILED with the error's first line, or
    DROPPED if its resource has vanished. All units of a resource are taken together; if that fails ``tries``
    times, the users whose source rows can't be read are searched by halves, with reads that keep nothing, and the
    units without them are taken together again; only if that fails too are they halved until the bad ones stand alone, so neither
    another resource nor another unit fails with them. Failed units go to ``dead`` as JSON lines, ids only, from where they can be sent again.
    ``sources`` gives rows, or what makes them, and the fields of each resource; wide copies go below ``copies``.
    """

    def rows_of(resource: str) -> tuple[DataFrame, list[str]]:
        source, fields = sources[resource]
        return source() if callable(source) else source, fields

    def attempt(spark: SparkSession, resource: str, users: DataFrame, kept: Column) -> None:
        source, fields = rows_of(resource)
        source = source.where(kept)
        S.sync_users(source, users, vault, keys, resource, fields, default_tenant)
        if copies:
            C.made_up_for(spark, S.reread(source, users), vault, copies, resource, fields)

    def readable(resource: str, kept: Column) -> bool:
        """Whether the source gives the cells of some users; nothing is kept."""
        try:
            source, fields = rows_of(resource)
            source.where(kept).select("tenant_id", *[F.col(f).alias(f"cell_{n}") for n, f in enumerate(fields)]).write.format("noop").mode("overwrite").save()
        except Exception:  # noqa: BLE001  the unit that is left alone is attempted and says why
            return False
        return True

    def unreadable(resource: str) -> list[str]:
        """Users whose rows the source can't give: its users are halved by a hash of their id, and a half beside a good one isn't asked again.

        The hash is a filter, so a read touches its own half only, however it is joined. None if they are more than SEARCHED.
        """
        try:
            source = rows_of(resource)[0].where("user_id IS NOT NULL").select(F.col("user_id").cast("string").alias("user_id"))
            n, found = source.count(), []
        except Exception:  # noqa: BLE001  the source as a whole is gone
            return []
        share = lambda m, r: F.col("user_id").isNotNull() & (F.pmod(F.xxhash64(F.col("user_id").cast("string")), F.lit(m)) == r)
        todo = [(1, 0)] if not readable(resource, share(1, 0)) else []
        while todo and len(found) <= SEARCHED:
            m, r = todo.pop()
            left = [u.user_id for u in source.where(share(m, r)).distinct().take(2)] if m >= n else None
            if left is not None and len(left) < 2:
                found += left
                continue
            if readable(resource, share(2 * m, r)):
                todo.append((2 * m, r + m))
            else:
                todo += [(2 * m, r)] if readable(resource, share(2 * m, r + m)) else [(2 * m, r), (2 * m, r + m)]
        return found if len(found) <= SEARCHED else []

    def failures(spark: SparkSession, resource: str, units: DataFrame, ids: list[str], kept: Column | None = None) -> dict[str, tuple[int, str]]:
        """Tries and error of each of the units that fails alone; ``kept`` are the users that the source is asked for."""
        own = units.where(F.col("unit_id").isin(ids))
        asked = kept
        if len(ids) == 1:  # the ids of a unit are a filter, which no other user's row passes
            asked = F.col("user_id").cast("string").isin(own.first().user_ids)
        for k in range(tries):
            try:
                attempt(spark, resource, own.select(F.explode("user_ids").alias("user_id")).distinct(), F.lit(True) if asked is None else asked)
                return {}
            except Exception as error:  # noqa: BLE001  it is kept as the unit's outcome
                said, tried = (str(error).strip().splitlines() or [type(error).__name__])[0][:500], k + 1
        if len(ids) == 1:
            return {ids[0]: (tried, said)}
        bad = unreadable(resource) if kept is None else []
        if bad:
            touched = [r.unit_id for r in own.where(F.arrays_overlap("user_ids", F.array(*map(F.lit, bad)))).select("unit_id").distinct().collect()]
            rest, others = sorted(set(ids).difference(touched)), ~F.col("user_id").cast("string").isin(bad)
            lost = {i: why for one in sorted(touched) for i, why in failures(spark, resource, units, [one], others).items()}
            return lost | (failures(spark, resource, units, rest, others) if rest else {})
        half = len(ids) // 2
        kept = F.lit(True) if kept is None else kept  # not searched again
        return failures(spark, resource, units, ids[:half], kept) | failures(spark, resource, units, ids[half:], kept)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        units = (batch if "run_id" in batch.columns else batch.withColumn("run_id", F.lit(None).cast("string"))).withColumn("unit_id", S.unit_id()).persist()
        failed: list[tuple] = []
        for resource in sorted(r.resource_id for r in units.where(F.col("resource_id").isin(list(sources))).select("resource_id").distinct().collect()):
            own = units.where(F.col("resource_id") == resource)
            ids = sorted(r.unit_id for r in own.select("unit_id").distinct().collect())  # as many as the trigger lets into a batch
            failed += [(i, *why) for i, why in failures(spark, resource, own, ids).items()]
        lost = spark.createDataFrame(failed, "unit_id string, tries int, error string")
        told = units.join(lost, "unit_id", "left")
        status = F.when(F.col("error").isNotNull(), "FAILED").when(F.col("resource_id").isin(list(sources)), "COMPLETED").otherwise("DROPPED")
        columns = told.select("run_id", "resource_id", "unit_id", F.size("user_ids").cast("long").alias("users"), status.alias("status"), F.coalesce("tries", F.lit(1)).alias("tries"), "error")
        sinks.replace_part(columns, outcomes, batch_id, 0)
        if dead and failed:
            told.where("error IS NOT NULL").select("run_id", "resource_id", "user_ids").write.mode("overwrite").json(f"{dead}/batch={batch_id}")
        units.unpersist()

    return run


def run_once(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> None:
    """All that is available now, batch by batch."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
