"""Few files for tables that grow by small appends: the vault, encrypted copies, raw and side tables. Key tables merge their folders themselves."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.operators.encrypted_copy import latest_combined
from shroud.sources import sinks

#: Files below this size are joined, to files of about this size.
SMALL = 64 << 20
#: Newest batches of a table of batches that are left alone: a stream may write them again.
OPEN = 2


def compact(spark: SparkSession, path: str, small: int = SMALL, latest: tuple[str, tuple[str, ...]] | None = None) -> int:
    """Joins the small files of each partition whose bytes fill fewer files, and gives how many files went.

    With ``latest`` (user column, order) only the newest row of each user stays, for an append-only copy whose
    readers ask for no other; all of its files are taken then, and what the rows that went leave small is joined
    again. Files are counted by the bytes that they have on disk, not by those of a shuffle.
    See ``sinks.replace_files`` for readers meanwhile.
    """
    sinks.finish_replacing(spark, path)
    by_folder = defaultdict(dict)
    for name, size in sinks.parquet_files(spark, path):
        if latest or size < small:
            by_folder[name.rpartition("/")[0]][name] = size
    files = [f"{path}/{n}" for sizes in by_folder.values() if len(sizes) > (1 if latest else _filled(sum(sizes.values()), small)) for n in sizes]  # names only
    if not files:
        return 0

    own = spark.read.parquet(files[0]).columns

    def joined(rows: DataFrame) -> DataFrame:
        within = [c for c in rows.columns if c not in own]
        parts = _parts(rows, within, small)
        if latest:
            return _dealt(latest_combined(rows, *latest), parts, within, F.xxhash64(latest[0]))
        return _dealt(rows.withColumn("__row", F.col("_metadata.row_index")), parts, within, F.col("__row")).drop("__row")

    sinks.replace_files(spark, path, files, joined)
    if latest:
        compact(spark, path, small)
    return len(files)


def merge_batches(spark: SparkSession, path: str, small: int = SMALL, open_: int = OPEN) -> int:
    """Merges the batches of a table of ``sinks.replace_part`` but for the newest, which a stream may still write again, into one; gives how many files went. Their rows have the batch -1 then."""
    sinks.finish_replacing(spark, path)
    batches = defaultdict(list)
    for name, size in sinks.parquet_files(spark, path):
        batches[int(name.split("/")[0].removeprefix("batch="))].append((name, size))
    closed = [f for b in sorted(b for b in batches if b >= 0)[: -open_ or None] for f in batches[b]]
    files = [f"{path}/{n}" for n, _ in closed]
    if len(files) < 2:
        return 0
    sinks.replace_files(spark, path, files, lambda rows: rows.repartition(_filled(sum(size for _, size in closed), small)), target="batch=-1/part=0")
    return len(files)


def _filled(size: int, small: int) -> int:
    """Files of about ``small`` bytes that hold a size."""
    return max(1, -(-size // small))


def _parts(rows: DataFrame, within: list[str], small: int) -> list[tuple]:
    """For each partition its values and how many files the bytes of its files fill."""
    sizes = rows.select(*within, "_metadata.file_path", "_metadata.file_size").distinct().groupBy(*within).agg(F.sum("file_size").alias("size"))
    return [(*r[:-1], _filled(r.size, small)) for r in sizes.collect()]  # a row for each partition


def _dealt(rows: DataFrame, parts: list[tuple], within: list[str], spread: Column) -> DataFrame:
    """The rows in one task for each file: every partition has tasks of its own, to which ``spread`` deals its rows."""
    starts = [0, *accumulate(p[-1] for p in parts)]
    kinds = ", ".join([*(f"`__{c}` {rows.schema[c].dataType.simpleString()}" for c in within), "__first long, __n long"])
    told = rows.sparkSession.createDataFrame([(*p[:-1], start, p[-1]) for p, start in zip(parts, starts, strict=False)], kinds)
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"`__{c}`")), within, F.lit(True))
    held = rows.join(F.broadcast(told), same) if within else rows.crossJoin(F.broadcast(told))  # a row for each partition
    return held.withColumn("__to", (F.col("__first") + F.pmod(spread, "__n")).cast("int")).repartitionById(starts[-1], "__to").select(*rows.columns)
