"""WARC archives with a two-level capture index.

Tasks write archives of gzip members, a record each; a page whose payload another page has already
given is a revisit. Captures are sorted by key (the URL with its host reversed) and page, and written
as index files: compressed blocks of lines, then a sparse directory with the first capture of each
block. A lookup finds the index file among their first captures, binary-searches its directory, reads
one block by range, binary-searches the block, and reads the record by range.

Files are opened through pyarrow.fs, below a folder that driver and executors share. Each attempt of a
task writes files of its own, and what it returns names them, so a lost or repeated task leaves at
most a file that nothing names.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.common import shared_dir, table, text_slices

#: Smallest payload that a revisit can stand for, lines of an index block, most index files.
LEAST_REVISIT, BLOCK_LINES, MOST_FILES = 1000, 512, 4096
#: Captures that have no time of their own get this one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Open archives of a task.
OPEN_FILES = 32
_UNPRINTED = re.compile("[\x00-\x20\x7f]")
_LOWEST = -(1 << 63)


def filesystem(folder: str):
    """(pyarrow file system, path in it) of a folder given as a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def capture_key(url: str | None) -> str:
    """com,example,www)/path?query of a URL: host reversed and lowered, no scheme, user or fragment; control signs and spaces are percent-encoded.

    A null URL has the empty key; one without :// is its own key.
    """
    head, mark, rest = (url or "").partition("://")
    if mark:
        rest = rest.partition("#")[0]
        cut = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
        host, tail = rest[:cut].rpartition("@")[2].lower(), rest[cut:]
        name, colon, port = host.partition(":")
        head = ",".join(reversed(name.split("."))) + colon + port + ")" + (tail if tail[:1] == "/" else "/" + tail)
    return _UNPRINTED.sub(lambda m: f"%{ord(m[0]):02X}", head)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record as a gzip member: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    revisit = refers_to is not None
    block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_UNPRINTED.sub(lambda m: f'%{ord(m[0]):02X}', url)}")
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def read_record(member: bytes) -> dict:
    """payload_bytes, payload_digest, record_type and refers_to of a gzip member; a response's digest is computed anew and compared."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(re.search(rb"Content-Length: (\d+)", http)[1]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = fields.get("WARC-Refers-To")
    if refers is None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} isn't what its record says")
    return {"payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": refers and int(refers[len("<urn:page:") : -1])}


def with_originals(pages: DataFrame, folder: str) -> DataFrame:
    """Pages with ``data``, ``digest`` and ``refers_to``: the largest page_id with the same payload of LEAST_REVISIT bytes or more, null for that page itself.

    The digests that occur twice are written as a table, so Spark knows its size when it picks the join.
    """
    data = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", data.alias("data"), F.sha1(data).alias("digest"))
    large = pages.select("page_id", F.sha1(data).alias("same"), F.octet_length(data).alias("n")).where(F.col("n") >= LEAST_REVISIT)
    large.groupBy("same").agg(F.max("page_id").alias("original"), F.count("*").alias("pages")).where("pages > 1").select("same", "original").write.parquet(f"{folder}/originals")
    twice = pages.sparkSession.read.schema("same string, original long").parquet(f"{folder}/originals")
    joined = rows.join(twice, (rows["digest"] == twice["same"]) & rows["page_id"].isNotNull(), "left")
    return joined.select("page_id", "url", "data", "digest", F.when(F.col("original") != F.col("page_id"), F.col("original")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) and returns the captures: key, page_id, file, offset, length.

    A null html is the empty payload. Rows without an id are responses. Repeated rows get a record each.
    """
    captures = "key string, page_id long, file string, offset long, length long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(f"{root}/archive", recursive=True)
        name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                for part in text_slices(batch, "data"):
                    out = out or store.open_output_stream(f"{root}/archive/{name}", compression=None)
                    rows, places = part.to_pylist(), []
                    for r in rows:
                        member = record(r["page_id"], r["url"], r["data"], r["digest"], r["refers_to"])
                        out.write(member)
                        places.append((capture_key(r["url"]), name, offset, len(member)))
                        offset += len(member)
                    keys, files, offsets, lengths = zip(*places, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), part.column("page_id"), pa.array(files), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    with_originals(pages, folder).mapInArrow(run, captures).write.parquet(f"{folder}/captures")
    return pages.sparkSession.read.schema(captures).parquet(f"{folder}/captures")


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, int, str]]:
    """Writes the index files and returns (first key, first page, file) of each, in order: at most MOST_FILES entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(f"{root}/index", recursive=True)
        name, out, offset, lines, directory = f"{uuid.uuid4().hex}.cdx", None, 0, [], []

        def flush():
            nonlocal offset
            block = zlib.compress("\n".join(lines).encode(), 6)
            out.write(block)
            key, page, *_ = lines[0].split("\t")
            directory.append(f"{key}\t{page}\t{offset}\t{len(block)}")
            offset += len(block)
            lines.clear()

        for batch in batches:
            out = out or store.open_output_stream(f"{root}/index/{name}", compression=None)
            for r in batch.to_pylist():
                lines.append(f"{r['key']}\t{_LOWEST if r['page_id'] is None else r['page_id']}\t{r['file']}\t{r['offset']}\t{r['length']}")
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            footer = zlib.compress("\n".join(directory).encode(), 6)
            out.write(footer + len(footer).to_bytes(8, "big"))
            out.close()
            key, page, *_ = directory[0].split("\t")
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([int(page)], pa.int64()), pa.array([name])], names=["key", "page", "file"])

    spark = captures.sparkSession
    files = min(MOST_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("key"), F.col("page_id"), F.col("file"), F.col("offset")]
    captures.repartitionByRange(files, *order).sortWithinPartitions(*order).mapInArrow(run, "key string, page long, file string").write.parquet(f"{folder}/files")
    return sorted((r.key, r.page, r.file) for r in spark.read.schema("key string, page long, file string").parquet(f"{folder}/files").collect())


class Index:
    """Lookups of one task: index files are found by ``files``, and the last file's directory and block are kept."""

    def __init__(self, folder: str, files: list[tuple[str, int, str]]):
        self.store, self.root = filesystem(folder)
        self.files = files
        self.firsts = [f[:2] for f in files]
        self.handles: OrderedDict = OrderedDict()
        self.at_file, self.directory, self.starts = None, [], []
        self.at_block, self.block, self.keys = None, [], []

    def range(self, path: str, offset: int, length: int) -> bytes:
        if path not in self.handles:
            if len(self.handles) >= OPEN_FILES:
                self.handles.popitem(last=False)[1].close()
            self.handles[path] = self.store.open_input_file(f"{self.root}/{path}")
        self.handles.move_to_end(path)
        return self.handles[path].read_at(length, offset)

    def _open(self, number: int) -> None:
        if self.at_file == number:
            return
        path = f"index/{self.files[number][2]}"
        self.range(path, 0, 0)
        size = self.handles[path].size()
        length = int.from_bytes(self.range(path, size - 8, 8), "big")
        footer = zlib.decompress(self.range(path, size - 8 - length, length)).decode()
        self.directory = [line.split("\t") for line in footer.split("\n")]
        self.starts = [(key, int(page)) for key, page, *_ in self.directory]
        self.at_file, self.at_block = number, None

    def _load(self, number: int) -> None:
        if self.at_block != number:
            _, _, offset, length = self.directory[number]
            text = zlib.decompress(self.range(f"index/{self.files[self.at_file][2]}", int(offset), int(length))).decode()
            self.block = [line.split("\t") for line in text.split("\n")]
            self.keys = [(key, int(page)) for key, page, *_ in self.block]
            self.at_block = number

    def captures(self, key: str, page: int | None) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of every capture of a key and page."""
        want = (key, _LOWEST if page is None else page)
        # the capture before the first that is not lower may share its block
        number = max(0, bisect.bisect_left(self.firsts, want) - 1)
        while number < len(self.files) and self.firsts[number] <= want:
            self._open(number)
            block = max(0, bisect.bisect_left(self.starts, want) - 1)
            while block < len(self.directory) and self.starts[block] <= want:
                self._load(block)
                for line in self.block[bisect.bisect_left(self.keys, want) : bisect.bisect_right(self.keys, want)]:
                    yield line[2], int(line[3]), int(line[4])
                block += 1
            number += 1


def lookup(queries: DataFrame, folder: str, files: list[tuple[str, int, str]]) -> DataFrame:
    """The records of each distinct (key, page_id) of ``queries``, read back by range: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Queries are sorted as the index is, so a task reads a run of neighbouring blocks, each once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, files)
        for batch in batches:
            rows = [{"page_id": q["page_id"]} | read_record(index.range(f"archive/{name}", offset, length)) for q in batch.to_pylist() for name, offset, length in index.captures(q["key"], q["page_id"])]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, so that few bytes of keys still mean many readers
    ordered = queries.select("key", "page_id").distinct().repartitionByRange(tasks, F.col("key"), F.col("page_id")).sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def keys_of(pages: DataFrame) -> DataFrame:
    """``key`` and page_id of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(u) for u in batch.column("url").to_pylist()], pa.string()), batch.column("page_id")], names=["key", "page_id"])

    return pages.select("url", "page_id").mapInArrow(run, "key string, page_id long")


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Archives ``pages`` below ``folder``, indexes them, and reads every page's record back through the index.

    One row per row of ``pages``, other columns unread: page_id, payload_bytes, payload_digest,
    record_type, refers_to. A null html is the empty payload, a null url has the empty key, and a row
    without an id is a response. Rows that repeat an id have a record each; of equal payloads that share
    the largest id all are responses. A very long payload is one record. Other names may clash. An empty
    table gives no rows.
    """
    files = write_index(write_archives(pages, folder), folder)
    return lookup(keys_of(pages), folder, files)


def query() -> Callable:
    """The registered query over the whole table of pages."""
    return lambda spark, sf_dir: archive_and_read(spark, table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))


SQL = f"""
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS data FROM pages
), digests AS (
  SELECT page_id, octet_length(data) AS payload_bytes, sha1(data) AS payload_digest FROM payloads
), originals AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND original <> page_id THEN original END AS refers_to
FROM originals
"""
