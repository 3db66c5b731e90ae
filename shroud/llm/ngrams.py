"""Hashed character n-grams of words, their scores with a bounded memory, and bounded samples of labelled rows."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shroud.llm.common import LONGEST, cut

#: Words whose scores a worker remembers.
MEMORY = 200_000
#: Ids that are ranked for each one taken into a sample.
SLACK = 1.5
#: Signs around a word, which are no part of its n-grams.
SIGNS = ".,;:!?\"'()[]{}<>|#$%&*+-/\\=@^_`~…«»“”„’‘¿¡"
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(1_000_003)


def word_ngrams(words: list[str], low: int, high: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word, bucket) of every n-gram of <word>, without SIGNS around it, low <= n <= high, hashed to 2**bits buckets."""
    words = [w.strip(SIGNS) for w in words]
    marked = "".join([f"<{w}>" for w in words])
    codes = np.frombuffer(marked.encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters from here to the word's end
    rolled, owners, buckets = np.zeros(len(codes), np.uint64), [], []
    for n in range(1, high + 1):
        rolled = rolled[: len(codes) - n + 1] * _STEP + codes[n - 1 :]
        if n >= low:
            fits = left[: len(rolled)] >= n
            owners.append(owner[: len(rolled)][fits])
            buckets.append(((rolled[fits] + np.uint64(n)) * _MIX >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


class WordScores:
    """Mean scores of the n-grams of words under a table (buckets x columns)."""

    def __init__(self, scores: np.ndarray, low: int, high: int, memory: int = MEMORY):
        self.scores, self.low, self.high, self.memory = scores, low, high, memory
        self.index: dict[str, int] = {}
        self.used = 0  # rows of values
        self.values = np.zeros((0, scores.shape[1]), np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word."""
        if self.used > self.memory:
            self.index, self.values, self.used = {}, self.values[:0], 0
        if new := list(set(words).difference(self.index)):
            owner, bucket = word_ngrams(new, self.low, self.high, int(len(self.scores)).bit_length() - 1)
            many = np.maximum(np.bincount(owner, minlength=len(new)), 1)
            made = np.stack([np.bincount(owner, self.scores[bucket, k], len(new)) / many for k in range(self.scores.shape[1])], axis=1)
            start = self.used
            self.used += len(new)
            self.index.update(zip(new, range(start, self.used), strict=True))
            if self.used > len(self.values):
                room = np.zeros((max(self.used, 2 * len(self.values)), self.values.shape[1]), np.float32)
                room[:start] = self.values[:start]
                self.values = room
            self.values[start : self.used] = made
        found = self.values[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]
        for word in new:
            if len(word) > LONGEST:
                del self.index[word]
        return found


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, most: int, most_bytes: int) -> list[tuple[str, object]]:
    """(text, label) of about ``most`` ids of each label at most, picked by a hash of the id, whole texts of any length: what a model is fitted on.

    ``labels`` has doc_id; ``docs`` has doc_id and text. An id counts once however often it is
    repeated: of several texts the smallest, and of several labels none, for it teaches neither. Null
    labels, ids and texts aren't fitted on. Both bounds hold on the driver: ids of a label are taken
    in order of their hash until there are ``most`` of them or their texts reach ``most_bytes`` shared
    out among the labels; the text that passes that mark is the last. A count of ids comes first, so
    only ids below a hash that keeps about ``most`` of each label are shuffled and ranked.
    """
    spark, hashed = docs.sparkSession, F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    local = lambda rows, *more: F.broadcast(spark.createDataFrame(rows, StructType([docs.schema["doc_id"], *more])))  # noqa: E731  rows that were bounded before they came to the driver
    named = labels.select("doc_id", label.alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    low = F.lit(0)
    for r in named.groupBy("label").agg(F.approx_count_distinct("doc_id").alias("n")).collect():
        low = F.when(F.col("label") == r["label"], F.lit(int(min(1, SLACK * most / r["n"]) * (1 << 30)))).otherwise(low)
    near = local([(r["doc_id"],) for r in named.where(hashed < low).select("doc_id").distinct().collect()])
    once = named.join(near, "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    ranked = defaultdict(list)
    for r in once.select("doc_id", "label", hashed.alias("h")).collect():
        ranked[r["label"]].append((r["h"], r["doc_id"]))
    picked = local([(i, str(y)) for y in ranked for _, i in sorted(ranked[y])[:most]], StructField("label", StringType()))
    found = docs.where("text IS NOT NULL").select("doc_id", "text").join(picked, "doc_id")
    texts = cut(found.groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    sizes = texts.select("doc_id", "label", F.octet_length("text").alias("size"), hashed.alias("h")).collect()
    room, taken = {str(y): most_bytes // len(ranked) for y in ranked}, []
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if room[r["label"]] > 0:
            room[r["label"]] -= r["size"]
            taken.append((r["doc_id"],))
    kind = {str(y): y for y in ranked}
    whole = texts if len(taken) == len(sizes) else texts.join(local(taken), "doc_id")
    return sorted((r["text"], kind[r["label"]]) for r in whole.collect())
