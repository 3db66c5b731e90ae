"""Benchmark decontamination by greedy string tiling over word seeds.

Items and documents are hashed over every run of SEED words, or of all words of a shorter item
(Karp-Rabin, modulo 2**64). A bitmap of the items' hashes, of bounded size, lets a document send only
the runs that an item may share, each once; they are joined to the items' seeds by hash, and a text and
an item that share enough seeds are a candidate. Both texts of a candidate come together in one row and
are tiled word by word: a running Karp-Rabin search finds the longest run of unmarked words that both
hold, compares the words themselves, marks it, and goes on with equal and then shorter runs until none
of a seed's length is left. The share of an item's words that is marked is its coverage, whatever the
order of the passages.

Copies of a text are one text here: hits are made distinct before they are shuffled, so a group of
copies, or a passage in a third of all documents, costs one text's work. No list of pairs of positions
is ever made, so a text that repeats itself takes memory in line with its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shroud.llm.common import LONGEST, cut, shared_dir, table, text_slices, texts_of, tidy
from shroud.llm.ngrams import SIGNS

SEED, COVERAGE = 5, 0.8
#: Bits of the bitmap of seeds: as many for each seed, between the least and the most (16 MB).
BITS_PER_SEED, LEAST_BITS, MOST_BITS = 256, 1 << 20, 1 << 27
#: Items that may share a seed before it counts as common, and items that a text is tiled with at a time.
COMMON, TOGETHER = 64, 64
#: Words of at most LONGEST characters whose hash a worker remembers.
MEMORY = 150_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        found = xxh64_intdigest(word)
        if len(word) <= LONGEST:
            self[word] = found
        return found


_hashes = _Hashes()


def words_of(text: str) -> list[str]:
    """Lower-cased words without the signs around them; signs alone are no word."""
    return [w for chunk in text.lower().split() if (w := chunk.strip(SIGNS))]


def forget_hashes() -> None:
    """Empties the worker's memory of words, so that it doesn't stand beside what later tasks need."""
    _hashes.clear()


def seed_hashes(texts: list[str], widths: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(text, hash) of every run of each width in words, repeats included, and each text's number of words. A shorter text has no run."""
    split = [words_of(t) for t in texts]
    if len(_hashes) > MEMORY:
        _hashes.clear()
    sizes = [len(t) for t in split]
    codes = np.fromiter(map(_hashes.__getitem__, (w for t in split for w in t)), np.uint64, sum(sizes))
    owner = np.repeat(np.arange(len(texts)), sizes)
    rolled, owners, hashes = np.zeros(len(codes), np.uint64), [owner[:0]], [np.zeros(0, np.uint64)]
    for width in range(1, max(widths, default=0) + 1):
        many = max(0, len(codes) - width + 1)
        rolled = rolled[:many] * np.uint64(_BASE) + codes[width - 1 : width - 1 + many]
        if width in widths:
            inside = owner[:many] == owner[width - 1 :]
            owners.append(owner[:many][inside])
            hashes.append(rolled[inside])
    return np.concatenate(owners), np.concatenate(hashes), sizes


class Runs:
    """Hashes of runs of any length over word codes, and which words are still unmarked."""

    def __init__(self, codes: np.ndarray):
        self.codes, n = codes, len(codes)
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        powers = np.cumprod(np.full(n, _BASE, np.uint64))
        self.back = np.cumprod(np.full(n, _INVERSE, np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers)])
        self.free = codes > 0

    def starts(self, length: int) -> np.ndarray:
        """Where a run of unmarked words of that length starts."""
        free = np.concatenate([[0], np.cumsum(self.free)])
        return np.flatnonzero(free[length:] - free[:-length] == length)

    def hashes(self, starts: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.back[starts]


def _shared(text: Runs, item: Runs, length: int) -> bool:
    """Whether a run of that length, by its hash, is in both."""
    return bool(np.isin(item.hashes(item.starts(length), length), text.hashes(text.starts(length), length)).any())


def _mark(text: Runs, item: Runs, length: int) -> list[tuple[int, int, int]]:
    """Marks all equal runs of that length, one after the other: first in the item, then in the text. Words are compared after a hash agrees."""
    i, j, found = text.starts(length), item.starts(length), []
    hashes = text.hashes(i, length)
    order = np.argsort(hashes, kind="stable")
    i, hashes, wanted = i[order], hashes[order], item.hashes(j, length)
    low, high = np.searchsorted(hashes, wanted), np.searchsorted(hashes, wanted, side="right")
    open_ = np.zeros(len(text.codes), bool)
    open_[i] = True
    end = 0
    for at in np.flatnonzero(high > low):
        b = int(j[at])
        if b < end:
            continue  # marked since
        some = i[low[at] : high[at]]
        for a in some[open_[some]].tolist():
            if np.array_equal(text.codes[a : a + length], item.codes[b : b + length]):
                open_[max(0, a - length + 1) : a + length] = False
                text.free[a : a + length] = item.free[b : b + length] = False
                found.append((a, b, length))
                end = b + length
                break
    return found


def tiles(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start in the text, start in the item, words) of the greedy tiling of two arrays of word codes; code 0 is a word that the other lacks."""
    text, item, found = Runs(text), Runs(item), []
    high = min(len(text.codes), len(item.codes))
    while high >= least and _shared(text, item, least):
        low, above = least, high + 1  # the longest run that both hold lies between
        while above - low > 1:
            middle = min((low + above) // 2, 2 * low)
            low, above = (middle, above) if _shared(text, item, middle) else (low, middle)
        found += _mark(text, item, low)
        high = low - 1
    return found


def tile_words(text: list[str], item: list[str]) -> list[tuple[int, int, int]]:
    """The tiling of two lists of words; no tile is shorter than SEED words, or than the item if it is shorter."""
    number: dict[str, int] = {}
    item_codes = np.array([number.setdefault(w, len(number) + 1) for w in item], np.int64)
    return tiles(np.fromiter(map(number.get, text, repeat(0)), np.int64, len(text)), item_codes, min(SEED, max(1, len(item))))


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item``, ``item_key`` (of its text) and ``item_text`` of each distinct item; null texts are left out."""
    rows = benchmark.select(F.col("item_id").alias("item"), F.xxhash64("text").alias("item_key"), F.col("text").alias("item_text"))
    return rows.where("item_text IS NOT NULL").dropDuplicates(["item", "item_key"])


def item_seeds(items: DataFrame) -> DataFrame:
    """``item``, ``item_key``, ``words``, ``width``, ``h`` and ``n``, how often it occurs, for every seed of every item; items without a word have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "item_text"):
                texts = texts_of(part, "item_text")
                owner, h, sizes = seed_hashes(texts, [SEED])
                width = np.full(len(owner), SEED)
                for at in (k for k, n in enumerate(sizes) if 0 < n < SEED):
                    _, short, _ = seed_hashes([texts[at]], [sizes[at]])
                    owner, h, width = np.append(owner, at), np.append(h, short), np.append(width, sizes[at])
                take = pa.array(owner.astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("item").take(take), part.column("item_key").take(take), pa.array(np.array(sizes, np.int64)[owner.astype(np.int64)]), pa.array(width.astype(np.int64)), pa.array(h.astype(np.uint64).view(np.int64))], names=["item", "item_key", "words", "width", "h"])

    kind = items.schema["item"].dataType.simpleString()
    made = items.mapInArrow(run, f"item {kind}, item_key long, words long, width long, h long")
    return made.groupBy("item", "item_key", "words", "width", "h").agg(F.count("*").alias("n"))


def telling_seeds(seeds: DataFrame, threshold: float) -> DataFrame:
    """The seeds but for common ones, and ``least``, how many starts of an item's seeds that are left a text must share.

    A text that covers the threshold shares so many starts of an item's seeds that it shares others even where
    the item's commonest ones are left out, as long as those have fewer starts. So a phrase of many items
    doesn't join all of them with all texts that hold it; an item of nothing but such phrases keeps them.
    """
    often = seeds.groupBy("h").agg(F.count("*").alias("items"))
    need = F.ceil(F.col("words") * threshold / F.col("width") - 1e-9)
    commonest = Window.partitionBy("item", "item_key").orderBy(F.desc("items"), "h")
    ranked = seeds.join(often, "h").withColumn("so_far", F.sum("n").over(commonest)).withColumn("out", (F.col("items") > COMMON) & (F.col("so_far") < need))
    left_out = F.sum(F.when(F.col("out"), F.col("n")).otherwise(0)).over(Window.partitionBy("item", "item_key"))
    return ranked.withColumn("least", need - left_out).where("NOT out").select(*seeds.columns, "least")


def seed_bitmap(seeds: DataFrame) -> np.ndarray:
    """The bitmap of the seeds' hashes as 64-bit words, made by Spark; at most MOST_BITS."""
    bits = LEAST_BITS
    while bits < MOST_BITS and bits < BITS_PER_SEED * seeds.count():
        bits *= 2
    place = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1))
    rows = seeds.select(place.alias("p")).selectExpr("shiftright(p, 6) AS word", "shiftleft(1L, cast(p & 63 AS int)) AS bit")
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def text_key() -> list:
    """Two hashes that stand for a text; a null text has those of the empty one."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("key"), F.crc32(text.cast("binary")).alias("check")]


def candidates(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """``key``, ``check``, ``item``, ``item_key`` of every text and item whose shared seeds could cover the threshold, as a table of known size."""
    seeds = cut(telling_seeds(cut(item_seeds(items)), threshold))
    widths = [int(r.width) for r in seeds.select("width").distinct().collect()]  # SEED of them at most
    shared = docs.sparkSession.sparkContext.broadcast(seed_bitmap(seeds))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        shift = np.uint64(64 - (64 * len(bitmap)).bit_length() + 1)
        for batch in batches:
            for part in text_slices(batch, "text"):
                owner, h, _ = seed_hashes(texts_of(part, "text"), widths)
                place = h >> shift
                hit = (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                take = pa.array(owner[hit])
                yield pa.RecordBatch.from_arrays([part.column("key").take(take), part.column("check").take(take), pa.array(h[hit].view(np.int64))], names=["key", "check", "h"])
        forget_hashes()

    rows = docs.select(*text_key(), "text").mapInArrow(tidy(hits), "key long, check long, h long").distinct()
    met = rows.join(seeds, "h").groupBy("key", "check", "item", "item_key", "least").agg(F.sum("n").alias("starts"))
    may = met.where(F.col("starts") >= F.col("least")).select("key", "check", "item", "item_key")
    return _written(may, "candidates")


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def coverages(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """``key``, ``check``, ``item_id``, ``coverage``, ``tiles`` of every text and item that may share ``threshold`` of the item's words."""
    items = items_of(benchmark)
    found = candidates(docs, items, threshold)
    texts = docs.select(*text_key(), F.coalesce("text", F.lit("")).alias("text")).join(found.select("key", "check").distinct(), ["key", "check"], "left_semi").dropDuplicates(["key", "check"])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = []
                for k, (text, listed) in enumerate(zip(texts_of(part, "text"), part.column("items").to_pylist(), strict=True)):
                    words = words_of(text)
                    for one in listed:
                        item_words = words_of(one["item_text"])
                        found = tile_words(words, item_words)
                        rows.append((k, one["item"], sum(n for *_, n in found) / len(item_words), len(found)))
                of, item, covered, n_tiles = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(k).take(pa.array(of)) for k in ("key", "check")] + [pa.array(item, part.schema.field("items").type.value_type.field("item").type), pa.array(covered, pa.float64()), pa.array(n_tiles, pa.int64())], names=["key", "check", "item_id", "coverage", "tiles"])

    place = F.row_number().over(Window.partitionBy("key", "check").orderBy("item", "item_key")) - 1
    lists = found.withColumn("part", F.floor(place / TOGETHER)).join(items, ["item", "item_key"]).groupBy("key", "check", "part").agg(F.collect_list(F.struct("item", "item_text")).alias("items"))  # TOGETHER of them at most
    kind = items.schema["item"].dataType.simpleString()
    return lists.join(texts, ["key", "check"]).select("key", "check", "items", "text").mapInArrow(tidy(tile), f"key long, check long, item_id {kind}, coverage double, tiles long")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """``key``, ``check`` of the texts that cover an item to the threshold, with the item covered most (smallest id of equals) and how many there are.

    They are written as a table, so Spark knows its size when it picks a join: documents are shuffled
    only if it is too large to send to all tasks.
    """
    over = coverages(docs, benchmark, threshold).where(F.col("coverage") >= threshold)
    best = F.max_by(F.struct("item_id", "coverage", "tiles"), F.struct("coverage", -F.col("item_id"))).alias("best")
    return _written(over.groupBy("key", "check").agg(best, F.count_distinct("item_id").alias("n_items")).select("key", "check", "best.*", "n_items"), "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, item_id, coverage, tiles, n_items.

    A document is contaminated if its tiles cover at least ``threshold`` of some item's words; of
    items that are covered equally the smallest id is named; else item_id is null and the figures are
    0. Tiles have at least SEED words; an item of fewer words is found where it stands whole. Null and
    empty texts and items share nothing; a very long text, or one that repeats a few words, is tiled
    whole. Equal texts, and repeated rows and items, get equal results, and null ids come back as
    they are. Other columns aren't read, so their names may clash; without documents there are no rows,
    and without items nothing is contaminated.
    """
    found = contaminated_texts(docs, benchmark, threshold)
    rows = docs.select("doc_id", *text_key()).join(found, ["key", "check"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast(found.schema[c].dataType)).alias(c)
    return rows.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), "item_id", zero("coverage"), zero("tiles"), zero("n_items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` whose text isn't contaminated, all columns as they are, whatever their names; null, empty, long and repeated texts as in ``decontaminate``."""
    found = contaminated_texts(docs, benchmark, threshold)
    key, check = text_key()
    return docs.join(found, (key == found["key"]) & (check == found["check"]), "left_anti")


def query() -> Callable:
    """The registered query over the whole tables of documents and benchmark items."""
    return lambda spark, sf_dir: decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
