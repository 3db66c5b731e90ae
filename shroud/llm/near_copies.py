"""SimHash near-dedup of texts by five-word shingles, with links that are exact at a Jaccard similarity of 0.8.

Texts with the same set of shingles are one from the start. Every set has a SimHash fingerprint, and the
vantage-point trees of ``simhash`` offer pairs of sets whose fingerprints are close; each pair is
confirmed on the whole sets. Sets of a similarity near 0.8 lie up to 20 bits apart, where no branch of
such a tree can be pruned, so an exact way takes what lies beyond the trees' reach: the shingles of a set
are put in one order for all texts, rare ones first; of two sets that are similar enough, the first fifth
of one and of the other share a shingle, so sets meet by the shingles of their prefixes only. The order
takes common shingles from a bounded sample; a poor order costs time, never a pair.

A large group of near copies is linked by a few pairs of each set before any pairs are listed: a set belongs to
the hub that it meets most often, and is compared with the hub and some members of its neighbourhood, the
closest of them by their sketches; then components that share a shingle are compared by some members of each.
Only sets that are in different components after that, and share a shingle, are compared pair by pair, which
loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shroud.llm import simhash
from shroud.llm.common import cut, release, text_slices, texts_of, tidy
from shroud.llm.components import connected_components

#: Bits within which the vantage-point trees search.
REACH = 2
#: Words of a shingle. Sets link if their intersection is at least four fifths of their union.
WIDTH = 5
#: Members of a hub's neighbourhood that stand for it, and how many of them, the closest, a set is compared with.
PIVOTS, CLOSEST = 12, 2
#: Members of a component that stand for it at a shingle, and how many pairs of two components, the closest, are compared.
STANDING, BRIDGES = 3, 4
#: Posts of a block, about, and how many a task holds at most before it hands them on.
BLOCK_POSTS, HELD_POSTS = 1 << 16, 1 << 21
#: Common shingles are taken from one in ONE_IN texts, of few texts from about SAMPLE; how many of them tasks are told, at most.
SAMPLE, ONE_IN, COMMON = 1 << 12, 10, 1 << 18
#: Buckets of text hashes of which tasks are told, at most.
BUCKETS = 1 << 20
#: 64-bit words of a sketch that travel with the posts of sets that are compared pair by pair.
BRIEF = 8


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42) of a text's shingles; a shorter text is one shingle, a text without words has none. Words as in ``simhash.fingerprint``."""
    from xxhash import xxh64_digest

    words = text.encode().lower().split()
    if len(words) <= WIDTH:
        hashes = xxh64_digest(b" ".join(words), 42) if words else b""
    else:
        joined, stops = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
        starts = [0, *stops[:-WIDTH].tolist()]
        hashes = b"".join([xxh64_digest(joined[i:j], 42) for i, j in zip(starts, (stops[WIDTH - 1 :] - 1).tolist(), strict=True)])
    return np.unique(np.frombuffer(hashes, ">i8").astype(np.int64))


def set_key(shingles: np.ndarray) -> int:
    """A hash that stands for a set."""
    from xxhash import xxh64_digest

    return int(np.frombuffer(xxh64_digest(shingles.tobytes(), 42), ">i8")[0])


def prefix(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first fifth, and one more, of a set's shingles, rare ones first: sets that share four fifths of their union share one of these."""
    often = np.zeros(len(shingles), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        often = np.where(common[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, often))][: len(shingles) // 5 + 1]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """A bit for each shingle by its hash, set if an odd number of shingles fall there: at least as many bits as shingles, a power of two of 64-bit words."""
    words = 1 << max(0, int(len(shingles) - 1) >> 6).bit_length()
    odd = np.bincount(shingles & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample hold, sorted, and in how many they are.

    The sample grows with the texts: with one of a fixed size the shingles that it doesn't see come ever more
    often, and pairs of sets that share one with their square.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = [shingle_set(t) for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))], names=["h"])

    rows = docs.count()
    some = docs.where(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(max(1, min(rows // SAMPLE, ONE_IN)))) == 0)
    found = some.select("text").mapInArrow(tidy(run), "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(COMMON).toPandas()
    found = found.sort_values("h")
    return found["h"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def _similar(n: Column, m: Column, shared: Column) -> Column:
    """Whether sets of n and m shingles that share so many reach 0.8, in whole numbers."""
    return 9 * shared >= 4 * (n + m)


def _may(a: str, b: str) -> Column:
    """Whether two sets whose first common shingle is at places ``i`` can reach 0.8: what follows is all that they can share."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return _similar(n, m, F.least(n - F.col(f"{a}.i"), m - F.col(f"{b}.i")))


@dataclass
class Nodes:
    """Where the texts of sets are: ``texts`` (id, key, text) and the ``keys`` (id, key, rep, fp, n, sketch) of one text for each set."""

    texts: DataFrame
    keys: DataFrame


def _bucket() -> Column:
    return F.pmod("key", F.lit(BUCKETS))


def _folded(sketch: Column, size: Column) -> Column:
    """A sketch of that size, or of twice that."""
    halves = F.zip_with(F.slice(sketch, F.lit(1), size), F.slice(sketch, size + 1, size), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(sketch) > size, halves).otherwise(sketch)


def _brief(sketch: Column) -> Column:
    """A sketch folded to BRIEF words at most."""
    xor = lambda x, y: F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b))
    rest = F.sequence(F.lit(1), (F.size(sketch) / BRIEF).cast("int") - 1)
    folded = F.aggregate(rest, F.slice(sketch, 1, BRIEF), lambda made, k: xor(made, F.slice(sketch, k * BRIEF + 1, F.lit(BRIEF))))
    return F.when(F.size(sketch) > BRIEF, folded).otherwise(sketch)


def _differ(x: Column, y: Column) -> Column:
    """By how many bits two sketches differ, the larger one folded to the smaller one's size."""
    size = F.least(F.size(x), F.size(y))
    bits = F.zip_with(_folded(x, size), _folded(y, size), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda s, b: s + b)


def _may_reach(pairs: DataFrame, nodes: Nodes) -> DataFrame:
    """The distinct pairs whose sizes and sketches don't rule 0.8 out, and by how many bits their sketches ``differ``: where they do in a bit, the sets do in a shingle."""
    of = lambda end, *names: nodes.keys.select(F.col("rep").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in names])
    met = pairs.distinct().join(of("a", "n", "sketch"), "a").join(of("b", "n", "sketch"), "b")
    sizes = met.where(_similar(F.col("n_a"), F.col("n_b"), F.least("n_a", "n_b")))
    differ = sizes.withColumn("differ", _differ(F.col("sketch_a"), F.col("sketch_b")))
    return differ.where(9 * F.col("differ") <= F.col("n_a") + F.col("n_b")).select("a", "b", "differ")


def _confirmed(pairs: DataFrame, nodes: Nodes) -> DataFrame:
    """Those of the pairs ``a``, ``b``, as sketches leave them, whose sets reach 0.8: they are compared on sets made again from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("rep"), _lists([shingle_set(t) for t in texts_of(part, "text")])], names=["rep", "s"])

    pairs = cut(pairs.select("a", "b").distinct())
    release(pairs.sparkSession)
    named = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    wanted = cut(nodes.keys.join(named, "rep", "left_semi").select("id", "key", "rep"))
    buckets = wanted.select(_bucket().alias("bucket")).distinct()  # BUCKETS of them at most: most texts that aren't wanted go no further
    texts = nodes.texts.join(F.broadcast(buckets), _bucket() == F.col("bucket"), "left_semi").join(wanted, ["id", "key"])
    sets = cut(texts.select("rep", "text").mapInArrow(tidy(run), "rep long, s array<long>").dropDuplicates(["rep"]))
    met = pairs.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("s").alias("y")), "b")
    found = cut(met.where(_similar(F.size("x"), F.size("y"), F.size(F.array_intersect("x", "y")))).select("a", "b"))
    release(found.sparkSession)
    return found


def _ends(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def tree_pairs(sets: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of sets (rep, sim) with the same fingerprint or one that the trees reach."""
    prints = cut(sets.groupBy("sim").agg(F.min("rep").alias("first")))
    same = sets.join(prints, "sim").where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b"))
    near = simhash.links(prints.select(F.col("sim").alias("fp"), F.col("first").alias("rep")), REACH)
    return same.unionByName(near).select(*_ends(F.col("a"), F.col("b")))


def _packed(block: int, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([len(columns[0])], pa.int32()), pa.array([b"".join([c.astype("<u4").tobytes() for c in columns])])], names=["block", "many", "data"])


def meetings(sets: DataFrame, early: bool = False) -> DataFrame:
    """Of the shingles ``h`` in the prefixes of ``sets`` (rep, size n, prefix) those that several sets hold: each set with its place i as ``p`` (n, rep, i), beside ``first``, a small set with the shingle.

    Posts travel in packed blocks by ranges of their hash, a few bytes each, and tasks sort block by block. A
    block has about BLOCK_POSTS; of one that a hot shingle makes larger a task keeps one set for each shingle
    and hands on the others as they come. 32 bits tell the shingles of a block apart: two that agree
    in them make sets meet in vain, no more. With ``early`` shingles go that no set holds within the first
    ninth of its own, but for those of a block that is handed on in parts (``parted``).
    """
    total = sets.agg(F.sum(F.size("prefix"))).first()[0] or 0
    bits = max(1, (total // BLOCK_POSTS).bit_length())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        many = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, rep, n, i = (np.concatenate(c) for c in zip(*held, strict=True))
            block, low = h >> np.uint64(64 - bits), (h << np.uint64(bits)) >> np.uint64(32)
            order = np.argsort(block, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(block[order])) + 1, [len(h)]])
            for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                at = order[start:stop]
                if len(at):
                    yield _packed(int(block[at[0]]), low[at], rep[at] & 0xFFFFFFFF, rep[at] >> 32, n[at], i[at])

        for batch in batches:
            lists = batch.column("prefix")
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            of_set = [np.repeat(batch.column(c).to_numpy(), sizes) for c in ("rep", "n")]
            held.append((lists.flatten().to_numpy().astype(np.uint64), *of_set, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)))
            many += len(held[-1][0])
            if many >= HELD_POSTS // 2:
                yield from flush()
                held, many = [], 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, at, many = None, [], None, 0

        def settled(last: bool) -> Iterator[pa.RecordBatch]:
            """Posts whose shingle came twice; keeps the first post of each shingle and whether it was handed on, until the block's end."""
            nonlocal kept, held, many
            parted = kept is not None or not last
            rows = np.concatenate([*([kept] if kept is not None else []), *held])  # h, n, rep, i, handed on
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            start = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            size = np.diff(start, append=len(rows))
            first, several = np.repeat(start, size), np.repeat(size > 1, size)
            wanted = several & (rows[:, 4] == 0)
            if early and not parted:
                wanted &= np.repeat(np.logical_or.reduceat(9 * rows[:, 3] <= rows[:, 1], start), size)
            out = np.flatnonzero(wanted)
            if len(out):
                p, f = rows[out], rows[first[out]]
                yield pa.RecordBatch.from_arrays([pa.array((at << 32) | p[:, 0]), *[pa.array(c) for c in (p[:, 1], p[:, 2], p[:, 3], f[:, 1], f[:, 2], f[:, 3])], pa.array(np.full(len(out), parted))], names=["h", "n", "rep", "i", "fn", "frep", "fi", "parted"])
            rows[:, 4] |= several
            kept, held, many = None if last else rows[start], [], 0

        for batch in batches:
            for block, m, data in zip(batch.column("block").to_pylist(), batch.column("many").to_pylist(), batch.column("data"), strict=True):
                if block != at and held:
                    yield from settled(True)
                if block != at:
                    kept, at = None, block
                h, low, high, n, i = np.frombuffer(data.as_buffer(), "<u4").reshape(5, m).astype(np.int64)
                held.append(np.stack([h, n, high << 32 | low, i, np.zeros(m, np.int64)], axis=1))
                many += m
                if many >= HELD_POSTS:
                    yield from settled(False)
        if held:
            yield from settled(True)

    dealt = sets.select("rep", "n", "prefix").mapInArrow(tidy(deal), "block long, many int, data binary")
    met = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(meet), "h long, n long, rep long, i long, fn long, frep long, fi long, parted boolean")
    return met.select("h", F.struct("n", "rep", "i").alias("p"), F.struct(F.col("fn").alias("n"), F.col("frep").alias("rep"), F.col("fi").alias("i")).alias("first"), "parted")


def neighbours(shared: DataFrame, nodes: Nodes) -> DataFrame:
    """For each set the CLOSEST of its hub and the PIVOTS members that stand for its hub's neighbourhood, as pairs ``a``, ``b``.

    The hub's row holds the sketches of all that stand for it, so a set is one row until its closest are known.
    """
    of = nodes.keys.select("rep", "n", "sketch")
    own = cut(shared.where("p.rep <> first.rep").where(_may("first", "p")).groupBy("p.rep").agg(F.mode("first.rep", True).alias("hub")).join(of, "rep"))
    chosen = own.groupBy("hub").agg(F.array_distinct(F.array("hub", *[F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(PIVOTS)])).alias("pivots"))
    pivots = chosen.select("hub", F.explode("pivots").alias("rep")).join(of, "rep").groupBy("hub").agg(F.collect_list(F.struct("rep", "n", "sketch")).alias("pivots"))
    near = F.transform("pivots", lambda x: F.struct(_differ(F.col("sketch"), x["sketch"]).alias("differ"), x["rep"].alias("b"), x["n"].alias("m")))
    may = F.filter(near, lambda x: (x["b"] != F.col("rep")) & _similar(F.col("n"), x["m"], F.least("n", x["m"])) & (9 * x["differ"] <= F.col("n") + x["m"]))
    tried = own.join(pivots, "hub").select(F.col("rep").alias("a"), F.slice(F.array_sort(may), 1, CLOSEST).alias("nearest"))
    return tried.select("a", F.explode("nearest.b").alias("b")).select(*_ends(F.col("a"), F.col("b")))


def _held(shared: DataFrame, near: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """The posts with the ``label`` of their set's component under the edges ``near``, and of each shingle with several components the labels, with members that stand for each, and which is the ``main`` one.

    Labels are what so many rounds reach: a component that keeps several of them costs pairs, no link.
    """
    group = connected_components(near, most_rounds=rounds, whole=False)
    release(shared.sparkSession)
    held = cut(shared.join(group, F.col("p.rep") == F.col("node"), "left").select("h", "p", F.coalesce("component", F.col("p.rep")).alias("label")))
    standing = F.array_distinct(F.array(*[F.min_by("p", F.xxhash64("p.rep", F.lit(k))) for k in range(STANDING)])).alias("standing")
    mixed = held.groupBy("h").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("h")
    labels = cut(held.join(mixed, "h", "left_semi").groupBy("h", "label").agg(F.count("*").alias("sets"), standing))
    main = labels.groupBy("h").agg(F.max_by("label", F.struct("sets", "label")).alias("main"))
    return held, labels.join(main, "h")


def bridges(labels: DataFrame, nodes: Nodes) -> DataFrame:
    """For each two components that share a shingle, one of them its largest, the BRIDGES closest pairs ``a``, ``b`` of members that stand for them."""
    largest = labels.where("label = main").select("h", F.col("label").alias("other"), F.explode("standing").alias("q"))
    tried = labels.where("label <> main").select("h", "label", F.explode("standing").alias("p")).join(largest, "h").where(_may("p", "q"))
    pairs = cut(tried.select("label", "other", F.col("p.rep").alias("a"), F.col("q.rep").alias("b")).distinct())
    nearest = Window.partitionBy("label", "other").orderBy("differ", "a", "b")
    close = _may_reach(pairs.select("a", "b"), nodes).join(pairs, ["a", "b"]).withColumn("place", F.row_number().over(nearest))
    return close.where(F.col("place") <= BRIDGES).select(*_ends(F.col("a"), F.col("b")))


def across(held: DataFrame, labels: DataFrame, nodes: Nodes) -> DataFrame:
    """Pairs ``a``, ``b`` of sets that share a shingle and are in different components, as far as their brief sketches don't rule 0.8 out.

    Of a shingle's sets those outside its largest component are paired with all that aren't in theirs. Posts carry
    their set's brief sketch, so what can't reach 0.8 makes no row.
    """
    several = labels.where("label = main").select("h", "main")
    brief = nodes.keys.select("rep", _brief(F.col("sketch")).alias("s"))
    posts = cut(held.join(several, "h").join(brief, F.col("p.rep") == F.col("rep")).select("h", "p", "label", "main", "s"))
    rest = posts.where("label <> main").select("h", F.col("p").alias("q"), F.col("label").alias("other"), F.col("s").alias("t"))
    n, m = F.col("p.n"), F.col("q.n")
    pairs = posts.drop("main").join(rest, "h").where("label <> other").where(_may("p", "q") & (9 * _differ(F.col("s"), F.col("t")) <= n + m))
    return pairs.select(*_ends(F.col("p.rep"), F.col("q.rep")))


def links(sets: DataFrame, nodes: Nodes, offered: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` that join all sets (rep, size n, prefix) that reach 0.8; ``offered`` are pairs to try first.

    The smaller set of a pair holds a shingle of both within the first ninth of its own, so a shingle
    that stands there in no set joins none.
    """
    shared = cut(meetings(sets, True))
    release(shared.sparkSession)
    if not shared.where("parted").isEmpty():
        shared = cut(shared.join(shared.where("9 * p.i <= p.n").select("h").distinct(), "h", "left_semi"))
    near = _confirmed(neighbours(shared, nodes).unionByName(_may_reach(offered, nodes).select("a", "b")), nodes)
    near = cut(near.unionByName(_confirmed(bridges(_held(shared, near, 2)[1], nodes), nodes)))
    apart = across(*_held(shared, near, 3), nodes)
    del shared
    release(near.sparkSession)
    return near.unionByName(_confirmed(_may_reach(apart, nodes), nodes))


def groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id``, ``key`` (a hash of the text) and ``fp`` (the key of its set) of every row, and ``component_id`` of each distinct ``fp`` of rows with an id.

    A null or empty text has the empty set, which links to itself alone.
    """
    release(docs.sparkSession)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))
    release(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = common.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = [shingle_set(t) for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array([set_key(s) for s in sets], pa.int64()), pa.array([simhash.majority(s.astype(">i8").tobytes()) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), _lists([sketch(s) for s in sets]), _lists([prefix(s, *order) for s in sets])], names=["id", "key", "fp", "sim", "n", "sketch", "prefix"])

    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), "text")
    made = cut(texts.mapInArrow(tidy(run), "id long, key long, fp long, sim long, n int, sketch array<long>, prefix array<long>"))
    first = made.where("id IS NOT NULL").groupBy("fp").agg(F.min(F.struct("id", "key")).alias("f"), F.first("sim").alias("sim"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"))
    sets, rows = cut(first.select("fp", "f.*", "sim", "n", "sketch", "prefix").withColumn("rep", F.monotonically_increasing_id())), cut(made.select("id", "key", "fp"))
    del made, first
    release(docs.sparkSession)
    nodes = Nodes(texts, cut(sets.select("id", "key", "rep", "fp", "n", "sketch")))
    offered = cut(tree_pairs(sets.select("rep", "sim")))
    release(docs.sparkSession)
    found = connected_components(links(sets.select("rep", "n", "prefix"), nodes, offered))
    label = nodes.keys.select("rep", "fp", "id").join(found, F.col("rep") == F.col("node"), "left").select("fp", "id", F.coalesce("component", "rep").alias("group"))
    least = label.groupBy("group").agg(F.min("id").alias("component_id"))
    return rows, cut(label.join(least, "group").select("fp", "component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of what links of 0.8 reach, all columns as they are.

    Null and empty texts are copies of each other, and shorter texts than a shingle of texts with the
    same words; very long ones are compared whole. For null and repeated ids see
    ``simhash.keep_smallest``. An empty table stays empty.
    """
    return simhash.keep_smallest(docs, *groups(docs.select("doc_id", "text")))
