"""Folders that driver and executors share, for rows that must be the same for all that reads them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shroud.sources.sinks import hadoop_path


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    made = f"{(root or 'file://' + tempfile.mkdtemp(prefix='work-')).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(made)
    return made


_made: list[str] = []


def discard(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Deletes the given folders, or all that ``work_dir`` named in this process: call it once nothing reads them any more."""
    for folder in list(_made if folders is None else folders):
        fs, place = hadoop_path(spark, folder)
        fs.delete(place, True)
        if folder in _made:
            _made.remove(folder)


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows after they were written as a table: what is random, or was dealt by a sample, is the same for all that reads it."""
    path = work_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes, when the block ends, the folders that were named in it."""
    before = len(_made)
    try:
        yield
    finally:
        discard(spark, _made[before:])
