"""Near-duplicates by 64-bit SimHash fingerprints and vantage-point trees over Hamming distance.

Fingerprints are made row by row, then only distinct ones go on. A vantage-point tree over a bounded
sample deals them into shards: a node's vantage point and radius send a fingerprint inside or
outside, and one whose ball of the search radius crosses the boundary visits the other side as well,
so any two fingerprints within the radius meet in the shard of one of them. Within a shard a second
vantage-point tree, over all of its fingerprints, prunes branches by the triangle inequality and
compares what is left. A shard returns a spanning forest of its links, never all pairs; components
over the forests are taken by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.llm.common import cut, shared_dir, table, text_slices, texts_of
from shroud.llm.components import connected_components

#: Fingerprints from which the shards' tree is built, at most (512 kB); the only ones that the driver sees.
SAMPLE = 1 << 16
#: Fingerprints of the sample for each shard.
PER_SHARD = 16
#: Comparisons made at once within a shard.
BLOCK = 1 << 21
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACE = 256 * np.arange(8)


def fingerprint(text: str, width: int) -> int:
    """Signed 64-bit SimHash of a text's shingles of ``width`` words; 0 without words.

    A-Z are lowered, words end at ASCII white space, shorter texts are one shingle. A bit is set if
    it is in over half of the shingles' XXH64 (seed 42), repeats counted.
    """
    from xxhash import xxh64_digest

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = xxh64_digest(b" ".join(words), 42)
    else:
        joined, stops = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
        starts = [0, *stops[: -width].tolist()]
        hashes = b"".join([xxh64_digest(joined[i:j], 42) for i, j in zip(starts, (stops[width - 1 :] - 1).tolist(), strict=True)])
    return majority(hashes)


def majority(hashes: bytes) -> int:
    """The bits that over half of big-endian 64-bit hashes have, as a signed number."""
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = (np.bincount((rows + _PLACE).ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > len(rows)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``key`` (a hash of the text) and ``fp`` (signed long) of every row, repeated rows and null ids included; a null text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array([fingerprint(t, width) for t in texts_of(part, "text")], pa.int64())], names=["id", "key", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.selectExpr(f"`{id_col}` AS id", f"xxhash64(`{text_col}`) AS key", f"`{text_col}` AS text").mapInArrow(run, f"id {kind}, key long, fp long")


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int, np.ndarray] | None:
    """The vantage point, of a few evenly spaced candidates, that splits most evenly; its radius and all distances."""
    best = None
    for at in range(0, len(points), max(1, len(points) // 8)):
        d = _distance(points, points[at])
        middle = int(np.median(d))
        for radius in (middle - 1, middle):
            inside = int((d <= radius).sum())
            if 0 < inside < len(d) and (best is None or abs(2 * inside - len(d)) < best[0]):
                best = (abs(2 * inside - len(d)), points[at], radius, d)
    return best and best[1:]


def shard_tree(sample: np.ndarray, shards: int) -> list:
    """A nested [vantage point, radius, inside, outside] with shard numbers as leaves, over at most ``shards`` shards."""
    number = iter(range(shards + 1))

    def grow(points: np.ndarray, many: int):
        found = _vantage(points) if many > 1 and len(points) >= 4 else None
        if found is None:
            return next(number)
        v, radius, d = found
        return [v, radius, grow(points[d <= radius], many - many // 2), grow(points[d > radius], many // 2)]

    return grow(sample, shards)


def deal(tree, fps: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, positions in fps, whether the shard is their own) for own and visited shards."""

    def walk(node, at: np.ndarray, own: np.ndarray):
        if not len(at):
            return
        if not isinstance(node, list):
            yield node, at, own
            return
        v, radius, inside, outside = node
        d = _distance(fps[at], v)
        for child, near, mine in ((inside, d <= radius + reach, d <= radius), (outside, d > radius - reach, d > radius)):
            yield from walk(child, at[near], (own & mine)[near])

    yield from walk(tree, np.arange(len(fps)), np.ones(len(fps), bool))


def forest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of each pair of positions; a label is a group's first position."""
    while len(a):
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(labels, high, low)
        while not np.array_equal(up := labels[labels], labels):
            labels = up
    return labels


def link_shard(points: np.ndarray, queries: np.ndarray, reach: int) -> np.ndarray:
    """Group label of each query; ``points`` are the positions in ``queries`` that can be met. A tree of vantage points."""
    labels, work = np.arange(len(queries)), [(points, np.arange(len(queries)))]
    while work:
        p, q = work.pop()
        if not len(p) or not len(q):
            continue
        found = _vantage(queries[p]) if len(p) > 64 and len(p) * len(q) > BLOCK // 8 else None
        if found is None:
            step = max(1, BLOCK // len(p))
            for at in range(0, len(q), step):
                some = q[at : at + step]
                i, j = np.nonzero(np.bitwise_count(queries[some][:, None] ^ queries[p][None, :]) <= reach)
                labels = forest(labels, some[i], p[j])
            continue
        v, radius, d = found
        dq = _distance(queries[q], v)
        work += [(p[d <= radius], q[dq <= radius + reach]), (p[d > radius], q[dq > radius - reach])]
    return labels


def how_many_shards(fingerprints_: int) -> int:
    """Small tables are dealt finely, for the sake of tasks; large ones into shards of 100,000, as each level of the tree deals half as many again."""
    return max(1, min(64, fingerprints_ // 2000), min(fingerprints_ // 100_000, SAMPLE // PER_SHARD))


def links(nodes: DataFrame, reach: int, shards: int | None = None) -> DataFrame:
    """Edges ``a``, ``b`` between the ``rep`` of distinct fingerprints ``fp``: in every shard a spanning forest of the pairs within ``reach`` bits."""
    shards = shards or how_many_shards(nodes.count())
    some = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(PER_SHARD * shards).collect() if shards > 1 else []
    tree = shard_tree(np.array([r.fp for r in some], np.int64).view(np.uint64), shards)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, rep = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("fp", "rep"))
            home = np.zeros(len(fp), np.int64)
            dealt = list(deal(tree, fp.view(np.uint64), reach))
            for number, at, own in dealt:
                home[at[own]] = number
            for number, at, own in dealt:
                keep = number >= home[at]  # of two shards the pair meets in the later one
                at, own = at[keep], own[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(fp[at]), pa.array(rep[at]), pa.array(own)], names=["shard", "fp", "rep", "own"])

    def search(_key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        label = link_shard(np.flatnonzero(rows["own"].to_numpy()), rows["fp"].to_numpy().view(np.uint64), reach)
        a, b = rows["rep"].to_numpy(), rows["rep"].to_numpy()[label]
        return pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    dealt = nodes.select("fp", "rep").mapInArrow(route, "shard long, fp long, rep long, own boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, reach: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Two fingerprints link if they differ in at most ``reach`` bits; a component is what links reach,
    named by its smallest id. A null text counts as empty and has fingerprint 0, which links like any
    other. A row with a null id takes the component of its fingerprint, null if no row has an id
    there. Repeated rows stay. A very long text is hashed whole. Other columns aren't read, so their
    names may clash. An empty table gives no rows.
    """
    made, named = _components(docs, width, reach, id_col, text_col)
    return made.join(named, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(docs: DataFrame, width: int, reach: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and ``component_id`` of each distinct ``fp``."""
    made = cut(fingerprints(docs, width, id_col, text_col))
    nodes = cut(made.groupBy("fp").agg(F.min("id").alias("rep")))
    edges = cut(links(nodes.where("rep IS NOT NULL"), reach))
    found = connected_components(edges)
    return made, cut(nodes.join(found, nodes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id")))


def keep_one(docs: DataFrame, width: int = 3, reach: int = 2) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component, all columns as they are; see ``keep_smallest``."""
    return keep_smallest(docs, *_components(docs.select("doc_id", "text"), width, reach, "doc_id", "text"))


def keep_smallest(docs: DataFrame, made: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component, all columns as they are.

    Of rows that repeat a kept doc_id in one component, one stays. Rows without an id name no
    component and stay. What is dropped is written as a table, so Spark knows its size when it picks
    the join: texts are shuffled only if that table is too large to send to all tasks.
    """
    linked = made.where("id IS NOT NULL").join(named, "fp")
    path = shared_dir(docs.sparkSession, "near-duplicates")
    linked.where("id <> component_id").select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct().write.parquet(path)
    dropped = docs.sparkSession.read.schema("__id long, __key long").parquet(path)
    kept = docs.join(dropped, (docs["doc_id"] == dropped["__id"]) & (F.xxhash64(docs["text"]) == dropped["__key"]), "left_anti")
    twice = cut(linked.where("id = component_id").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("__id")))
    if not twice.isEmpty():  # ids should be unique; where they aren't, one row of each is taken
        again = kept.join(twice, kept["doc_id"] == twice["__id"], "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(twice, kept["doc_id"] == twice["__id"], "left_anti").unionByName(again)
    return kept


def query() -> Callable:
    """The registered query over the whole table of documents."""
    return lambda spark, sf_dir: near_duplicates(table(spark, sf_dir, "documents"))
