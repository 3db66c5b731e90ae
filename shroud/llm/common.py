"""What the operators of this subpackage share: table access, held-out rows, batches of bounded size, cut lineage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into Python strings at a time (one row at least).
SLICE_BYTES = 1 << 20
#: Characters of the longest word that a worker remembers: memories are bounded by their number of words, so words must be short.
LONGEST = 64
#: Bytes of rows that go to a Python worker at a time (one row at least).
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold at most ``most`` bytes together; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(size), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts as Python strings, null as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same task, which gives memory that it no longer uses back to the system when it ends: workers live on, and the next stage's tasks run in them."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    """Gives memory that this process no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library of Linux has it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Sets spark.sql.execution.arrow.maxBytesPerBatch, where the session has no such setting, to ``most``: Spark and the worker both hold a batch whole, and 10,000 long rows are a large one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder's path below spark.checkpoint.dir, which driver and executors share; ``discard`` deletes it."""
    made = f"{_checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(made)
    return made


_made: list[str] = []


def discard(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Deletes the given folders, or all that ``shared_dir`` named in this process: call it once nothing reads them any more."""
    for folder in list(_made if folders is None else folders):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if folder in _made:
            _made.remove(folder)


def _checkpoint_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset a local master gets a local folder, and a cluster an error: executors would write to disks of their own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return root or f"file://{tempfile.mkdtemp(prefix='checkpoint-')}"


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files, and forget the broadcasts, of frames that are no longer referenced, such as those behind a checkpoint, and gives the memory that the driver no longer uses back to the system."""
    give_back()
    spark.sparkContext._jvm.System.gc()
    _trim(spark)


def _trim(spark: SparkSession) -> None:
    """What ``give_back`` does for Python, for the driver's JVM: freed native memory of plans and of compiled code stays with the C library until it is asked for. A JVM without this command of its management interface keeps it."""
    gateway = spark.sparkContext._gateway
    java, named = gateway.jvm.java, gateway.jvm.java.lang.Class.forName

    def array(kind, *items):
        made = gateway.new_array(kind, len(items))
        for k, x in enumerate(items):
            made[k] = x
        return made

    with contextlib.suppress(Py4JError):
        kinds = [named(x) for x in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")]
        invoke = named("javax.management.MBeanServer").getMethod("invoke", array(java.lang.Class, *kinds))
        commands = gateway.jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        invoke.invoke(java.lang.management.ManagementFactory.getPlatformMBeanServer(), array(java.lang.Object, commands, "systemTrimNativeHeap", array(java.lang.Object), array(java.lang.String)))


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_checkpoint_root(spark))
    return df.checkpoint()
