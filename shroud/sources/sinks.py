"""Writers of the protected tables. Appends are Parquet; encrypted rows are written once and read back for whatever is derived."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(rows: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Appends rows; partitions are column values of bounded number, such as resource_id, never a tenant alone."""
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_once(rows: DataFrame, path: str, key: list[str], by: str | None = None) -> None:
    """Appends a row for each key that the table doesn't hold yet, so a batch that comes again adds nothing.

    With ``by``, a date column that a key always has the same value of, the table is partitioned by it,
    and only the partitions of the batch's dates are read; else the key columns of the whole table are.
    One writer at a time: two that check at once may both add a key.
    """
    spark, given, rows = rows.sparkSession, rows, rows.dropDuplicates(key)
    if exists(spark, path):
        held = spark.read.schema(rows.schema).parquet(path)  # there may be no row yet
        if by:
            held = held.where(F.col(by).isin([r[0] for r in given.select(by).distinct().collect()]))
        rows = rows.join(held.select(*key), key, "left_anti")
    append(rows, path, [by] if by else None)


def replace_part(rows: DataFrame, path: str, batch: int, part: int, partition_by: list[str] | None = None) -> None:
    """Writes one part of a batch of a table; when the batch comes again the part is replaced."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/batch={batch}/part={part}")


def purge(spark: SparkSession, path: str, operation_id: str) -> None:
    """Takes the rows of one operation out of a stored table; rows without an operation stay.

    Only the files that hold such rows are read whole and replaced, each set within its own partition, so other
    partitions' files aren't touched; see ``replace_files``.
    """
    finish_replacing(spark, path)
    table = spark.read.parquet(path)
    taken = F.col("operation_id").eqNullSafe(operation_id)
    files = [r[0] for r in table.where(taken).select("_metadata.file_path").distinct().collect()]  # names only
    if files:
        replace_files(spark, path, files, lambda rows: rows.where(~taken))


def replace_files(spark: SparkSession, path: str, files: list[str], change: Callable[[DataFrame], DataFrame], target: str | None = None) -> None:
    """Puts what ``change`` makes of the files' rows in the files' place, by the partition columns of the table, or below ``target`` without any.

    The table is always there: what takes the files' place is complete before anything moves, and a list of
    the files stands until they are gone, so the next call finishes one that was interrupted (see
    ``finish_replacing``); a reader that looks meanwhile sees rows twice, never too few. One writer at a time.
    """
    table = spark.read.parquet(path)
    own = spark.read.parquet(files[0]).columns
    within = [] if target else [c for c in table.columns if c not in own]
    rows = change(spark.read.schema(table.schema).option("basePath", path).parquet(*files))
    writer = (rows.select(*own) if target else rows).write.mode("overwrite")
    (writer.partitionBy(*within) if within else writer).parquet(f"{path}/_replacing/rows{'/' + target if target else ''}")
    put_text(spark, f"{path}/_replacing/files", json.dumps(files))
    finish_replacing(spark, path)


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Moves what replaces files to their place and deletes them, if ``replace_files`` has come so far; else forgets what it wrote."""
    fs, below = hadoop_path(spark, f"{path}/_replacing")
    if exists(spark, f"{path}/_replacing/files"):
        for name, _ in parquet_files(spark, f"{path}/_replacing/rows"):
            _, target = hadoop_path(spark, f"{path}/{name}")
            fs.mkdirs(target.getParent())
            fs.rename(hadoop_path(spark, f"{path}/_replacing/rows/{name}")[1], target)
        for name in json.loads(get_text(spark, f"{path}/_replacing/files")):
            fs.delete(hadoop_path(spark, name)[1], False)
    fs.delete(below, True)


def parquet_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Paths of the Parquet files below a folder, relative to it, and their sizes; hidden folders are left out."""
    fs, folder = hadoop_path(spark, path)
    found, listed, above = [], fs.listFiles(folder, True), f"{fs.getFileStatus(folder).getPath().toUri().getPath()}/"
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toUri().getPath().removeprefix(above)
        if name.endswith(".parquet") and not any(part[0] in "._" for part in name.split("/")):
            found.append((name, status.getLen()))
    return found


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete once it is there."""
    fs, place = hadoop_path(spark, path)
    _, draft = hadoop_path(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    stream.write(text.encode())
    stream.close()
    fs.rename(draft, place)


def get_text(spark: SparkSession, path: str) -> str:
    fs, place = hadoop_path(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path on any file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, on any file system."""
    fs, place = hadoop_path(spark, path)
    return fs.exists(place)


def append_vault(records: DataFrame, path: str) -> None:
    """Appends vault rows, by resource, so that a diff reads one resource only."""
    append(records, path, ["resource_id"])


def archive_lineage(events: DataFrame, path: str, run: str, time_column: str = "ts") -> None:
    """Lineage as NDJSON files of one run, by date."""
    events.withColumn("date", F.to_date(time_column)).write.mode("errorifexists").partitionBy("date").json(f"{path}/run={run}")
