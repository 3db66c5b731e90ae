"""A hashed maximum-entropy language model with a class-factored softmax.

A word is a path of three choices among 16: its class, the class within that class, and its slot there. The
most frequent words have slots of their own, in an order in which words spelt alike stand together; all
other words share slots by their last letters, and within a shared slot a word has its add-one share of the
slot's count. Each choice is a softmax over features of what stands before: the bigram feature of the word before
and the skip feature of the second word before, each hashed together with the choices made so far
to a row of 16 weights. (A trigram feature of both words made held-out texts less likely: its hashes are too many
for the rows.) Without features the model is the unigram distribution of the slots.

Training goes through every training document once, in rounds. In a round each task takes gradient steps over its
part of the documents, beginning with the weights of the round before, and sends what it changed; a row of
weights moves by the mean of the tasks' changes, weighted by how often each task saw the row. Counts of
words, and the weights, come from the whole corpus. What tasks are told has a fixed size: the weights and a
table of frequent words; counts of rarer words are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.common import cut, release, remainder, shared_dir, table, text_slices, texts_of, tidy

#: Choices of a word's path, and options of each, 4 bits of the slot.
DEPTH, WAYS, BITS = 3, 16, 4
#: Slots in all, and those that words share by their last letters.
SLOTS, SHARED = WAYS**DEPTH, 512
#: Rows of weights of each feature and choice.
ROWS_BITS, FEATURES = 15, 2
ROWS = 1 << ROWS_BITS
#: Rounds of training, documents' text for a task, words of a gradient step and its rate.
ROUNDS, TASK_BYTES, STEP, RATE = 2, 32 << 20, 1 << 16, 0.7
#: Frequent words whose counts tasks are told, at most.
TABLE = 1 << 19
#: Words that a task counts before it sends them on (those of more than LONG bytes at once), and bytes of words that it remembers.
COUNTED, MEMORY, LONG = 300_000, 48 << 20, 64
#: Powers of options are bounded by that of this number.
HIGHEST = np.float32(60)
#: Rows of weights that are sent together.
BLOCK = 2048
#: What ends a text, and what stands before it: no words, as they hold a space.
END, START = b" ", b"  "
_MIX, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def numbered_words(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts without their ASCII capitals, the number of each text's words in a row, and where each text starts there, with a last stop. Arrow splits and numbers them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    coded = lists.values.dictionary_encode()
    words, numbers = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
    stops = lists.offsets.to_numpy().astype(np.int64)
    if b"" in words:  # what white space at either end of a text leaves
        keep = numbers != words.index(b"")
        numbers, stops = numbers[keep], np.append(0, np.cumsum(keep))[stops]
    return words, numbers, stops


def word_keys(words: list[bytes]) -> np.ndarray:
    """64 bits by which words are told apart."""
    from xxhash import xxh64_intdigest

    return (np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)) ^ np.uint64(1 << 63)).view(np.int64)


def word_key(word: bytes) -> int:
    """The key of one word."""
    return int(word_keys([word])[0])


def shared_slot(word: bytes) -> int:
    """The slot of a word that has none of its own."""
    return SLOTS - SHARED + zlib.crc32(word[-2:]) % SHARED


def word_counts(docs: DataFrame) -> DataFrame:
    """``key``, beginning ``word``, shared ``slot`` and count ``n`` of every distinct token of the texts, ends included."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        short = [w[:24].decode("utf-8", "ignore") for w in words]
        return pa.RecordBatch.from_arrays([pa.array(word_keys(words)), pa.array(short, pa.string()), pa.array([shared_slot(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["key", "word", "slot", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, numbers, _ = numbered_words(texts_of(part, "text"))
                found = Counter({w: n for w, n in zip(words, np.bincount(numbers, minlength=len(words)).tolist(), strict=True) if n})
                found[END] = part.num_rows
                if long := {w: n for w, n in found.items() if len(w) > LONG}:
                    yield batch_of(Counter(long))
                    found.subtract(long)
                    found = +found
                held.update(found)
                if len(held) > COUNTED:
                    yield batch_of(held)
                    held = Counter()
        if held:
            yield batch_of(held)

    rows = docs.select("text").mapInArrow(tidy(run), "key long, word string, slot int, n long")
    return rows.groupBy("key").agg(F.min("word").alias("word"), F.min("slot").alias("slot"), F.sum("n").alias("n"))


def spelling_order(words: list[str]) -> np.ndarray:
    """The words' numbers, so ordered that words spelt alike stand together: halves again and again along the main direction of their letter n-grams."""
    vectors = np.zeros((len(words), 512), np.float32)
    for k, word in enumerate(words):
        marked = f"<{word}>"
        for n in (1, 2, 3):
            for i in range(len(marked) - n + 1):
                vectors[k, zlib.crc32(marked[i : i + n].encode()) % 512] += 1
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def split(of: np.ndarray) -> Iterator[np.ndarray]:
        if len(of) <= 2:
            yield of
            return
        own = vectors[of] - vectors[of].mean(axis=0)
        main = own[np.argmax((own**2).sum(axis=1))]
        for _ in range(15):
            main = own.T @ (own @ main)
            main /= max(float(np.linalg.norm(main)), 1e-9)
        order = of[np.argsort(own @ main, kind="stable")]
        yield from split(order[: len(order) // 2])
        yield from split(order[len(order) // 2 :])

    return np.concatenate([np.zeros(0, np.int64), *split(np.arange(len(words)))])


@dataclass
class Vocabulary:
    """Frequent words by ``keys`` in order, with counts and slots; ``sizes`` and ``kinds`` are counts and distinct words of each shared slot; ``tokens`` and ``distinct`` those of the corpus."""

    keys: np.ndarray
    counts: np.ndarray
    slots: np.ndarray
    sizes: np.ndarray
    kinds: np.ndarray
    tokens: int
    distinct: int
    least: int

    def biases(self) -> list[np.ndarray]:
        """For each choice the log share of each option among all words, (choices before, option)."""
        mass = np.where(np.arange(SLOTS) < SLOTS - SHARED, 1e-6, self.sizes + self.kinds * 0.1 + 0.1)
        own = self.slots < SLOTS - SHARED
        np.add.at(mass, self.slots[own], self.counts[own])
        found = []
        for depth in range(DEPTH):
            part = mass.reshape(WAYS**depth, WAYS, -1).sum(axis=2)
            found.append(np.log(part / part.sum(axis=1, keepdims=True)).astype(np.float32))
        return found


def _level() -> Column:
    """Counts by eighths of a doubling."""
    return F.floor(F.log2("n") * 8).cast("int")


def vocabulary(counts: DataFrame, most: int = TABLE) -> Vocabulary:
    """Of the word counts: the words more frequent than a mark that keeps ``most`` of them at most; those ahead of all others get slots of their own."""
    levels = sorted(counts.groupBy(_level().alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect(), key=lambda r: -r["level"])  # a few hundred
    held, least = 0, 1 << 30
    for r in levels:
        held += r["words"]
        if held > most:
            break
        least = r["level"]
    top = counts.where(_level() >= least)
    own = SLOTS - SHARED
    first = top.orderBy(F.desc("n"), "key").limit(own).select("key", "word").collect()
    first.sort(key=lambda r: r["key"])
    slot = dict(zip([first[k]["key"] for k in spelling_order([r["word"] for r in first])], range(len(first)), strict=True))
    frequent = top.select("key", "slot", "n").toPandas().sort_values("key")
    keys, given, n = frequent["key"].to_numpy(np.int64), frequent["slot"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64)
    slots = np.array([slot.get(k, s) for k, s in zip(keys.tolist(), given.tolist(), strict=True)], np.int64)
    sizes, kinds = np.zeros(SLOTS), np.zeros(SLOTS)
    for r in counts.groupBy("slot").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        sizes[r["slot"]], kinds[r["slot"]] = r["n"], r["words"]
    coded = slots < own
    np.subtract.at(sizes, given[coded], n[coded])
    np.subtract.at(kinds, given[coded], 1)
    return Vocabulary(keys, n, slots, sizes, kinds, sum(r["n"] for r in levels), sum(r["words"] for r in levels), least)


class Reader:
    """Turns texts into tokens with the numbers that the model needs, and remembers words."""

    def __init__(self, words: Vocabulary, memory: int = MEMORY):
        self.words, self.memory = words, memory
        self.forget()

    def forget(self) -> None:
        self.index, self.held = {}, 0
        self.key, self.slot, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._add([START, END])

    def _add(self, new: list[bytes]) -> None:
        keys = word_keys(new)
        at = np.minimum(np.searchsorted(self.words.keys, keys), max(len(self.words.keys) - 1, 0))
        known = self.words.keys[at] == keys if len(self.words.keys) else np.zeros(len(new), bool)
        at = at[known]
        slot, count = np.array([shared_slot(w) for w in new], np.int64), np.zeros(len(new), np.int64)
        slot[known], count[known] = self.words.slots[at], self.words.counts[at]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.key, self.slot, self.count = np.concatenate([self.key, keys]), np.concatenate([self.slot, slot]), np.concatenate([self.count, count])
        self.held += sum(map(len, new)) + 120 * len(new)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each token's word, where each text starts), for the texts' tokens in a row; numbers hold until the next call."""
        if self.held > self.memory:
            self.forget()
        words, numbers, stops = numbered_words(texts)
        if new := [w for w in words if w not in self.index]:
            self._add(new)
        own = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        starts = stops[:-1] + np.arange(len(texts))  # an end follows each text
        return np.insert(own[numbers], stops[1:], self.index[END]), starts

    def contexts(self, tokens: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """A hash of each feature's word before each token: the last one, and the one before it."""
        key = self.key.astype(np.uint64) * _MIX
        before = []
        for back in (1, 2):
            number = np.concatenate([np.zeros(back, np.int64), tokens])[: len(tokens)]
            for k in range(back):
                inside = starts + k < np.append(starts[1:], len(tokens))
                number[(starts + k)[inside]] = 0  # START
            before.append(key[number])
        return [before[0], before[1] + _ODD]


def rows_of(contexts: list[np.ndarray], slot: np.ndarray) -> list[list[np.ndarray]]:
    """For each choice and feature the row of weights of each token."""
    found = []
    for depth in range(DEPTH):
        before = choices(slot, depth).astype(np.uint64) * _ODD
        found.append([((c ^ before) * _MIX >> np.uint64(64 - ROWS_BITS)).astype(np.uint16) for c in contexts])
    return found


def choices(slot: np.ndarray, depth: int) -> np.ndarray:
    """The options taken before a choice, as a number."""
    return slot >> BITS * (DEPTH - depth)


def option(slot: np.ndarray, depth: int) -> np.ndarray:
    """Which option of a choice leads to each slot."""
    return choices(slot, depth + 1) & (WAYS - 1)


def choice_powers(weights: np.ndarray, biases: list[np.ndarray], rows: list[np.ndarray], slot: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each token the exponential of every option of one choice, and their sum."""
    z, more = np.take(biases[depth], choices(slot, depth), axis=0), np.empty((len(slot), WAYS), np.float32)
    for f, row in enumerate(rows):
        np.take(weights[depth, f], row, axis=0, out=more, mode="clip")
        z += more
    power = np.exp(np.minimum(z, HIGHEST, out=z), out=z)
    return power, power @ np.ones(WAYS, np.float32)


def log_probabilities(weights: np.ndarray, biases: list[np.ndarray], contexts: list[np.ndarray], slot: np.ndarray) -> np.ndarray:
    """Log probability (natural) of each token's slot."""
    total = np.zeros(len(slot))
    for at in range(0, len(slot), STEP):
        own, here = slot[at : at + STEP], [c[at : at + STEP] for c in contexts]
        for depth, rows in enumerate(rows_of(here, own)):
            power, whole = choice_powers(weights, biases, rows, own, depth)
            total[at : at + STEP] += np.log(power[np.arange(len(own)), option(own, depth)] / whole)
    return total


class Learner:
    """Gradient steps over tokens, from given weights, with a step size for each weight by what it has moved."""

    def __init__(self, weights: np.ndarray, biases: list[np.ndarray]):
        self.weights, self.biases = weights.copy(), biases
        self.seen, self.moved = np.zeros(weights.shape[:3], np.float32), np.ones_like(weights)

    def learn(self, contexts: list[np.ndarray], slot: np.ndarray) -> None:
        for at in range(0, len(slot), STEP):
            own, here = slot[at : at + STEP], [c[at : at + STEP] for c in contexts]
            for depth, rows in enumerate(rows_of(here, own)):
                slope, whole = choice_powers(self.weights, self.biases, rows, own, depth)
                slope *= (-1 / whole)[:, None]
                slope[np.arange(len(own)), option(own, depth)] += 1
                for f, row in enumerate(rows):
                    order = np.argsort(row, kind="stable")  # 16 bits: by counting
                    ordered = row[order]
                    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                    hit, step = ordered[first], np.add.reduceat(np.take(slope, order, axis=0), first, axis=0)
                    moved = np.take(self.moved[depth, f], hit, axis=0)
                    moved += step * step
                    self.moved[depth, f][hit] = moved
                    step *= RATE / np.sqrt(moved)
                    self.weights[depth, f][hit] += step
                    self.seen[depth, f][hit] += np.diff(first, append=len(row))


def _gradient_round(docs: DataFrame, words, weights: np.ndarray, tasks: int) -> np.ndarray:
    """Weights after each task's steps over its documents and the weighted mean of what they changed."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float16))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, before = Reader(words.value), shared.value.astype(np.float32)
        learner = Learner(before, words.value.biases())
        for batch in batches:
            for part in text_slices(batch, "text"):
                tokens, starts = reader.read(texts_of(part, "text"))
                learner.learn(reader.contexts(tokens, starts), reader.slot[tokens])
        change, seen = (learner.weights - before).reshape(-1, WAYS), learner.seen.reshape(-1)
        for block in range(0, len(seen), BLOCK):
            hit = np.flatnonzero(seen[block : block + BLOCK])
            if len(hit):
                data = [hit.astype(np.uint16).tobytes(), seen[block + hit].tobytes(), change[block + hit].astype(np.float16).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([block // BLOCK], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(hit)], pa.int32()), pa.array([b"".join(data)])], names=["block", "task", "n", "data"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, at = np.zeros((BLOCK, WAYS)), np.zeros(BLOCK), None

        def done() -> Iterator[pa.RecordBatch]:
            if at is not None:
                mean = (total / np.maximum(seen, 1)[:, None]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([mean.tobytes()])], names=["block", "data"])

        for batch in batches:
            for block, n, data in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), batch.column("data"), strict=True):
                if block != at:
                    yield from done()
                    total, seen, at = np.zeros((BLOCK, WAYS)), np.zeros(BLOCK), block
                raw = data.as_buffer()
                hit, many = np.frombuffer(raw, np.uint16, n), np.frombuffer(raw[2 * n : 6 * n], np.float32, n)
                total[hit] += many[:, None] * np.frombuffer(raw[6 * n :], np.float16, n * WAYS).reshape(n, WAYS)
                seen[hit] += many
        yield from done()

    sent = docs.select("text").coalesce(tasks).mapInArrow(tidy(learn), "block int, task int, n int, data binary")
    merged = sent.repartition("block").sortWithinPartitions("block", "task").mapInArrow(tidy(merge), "block int, data binary")
    flat = shared.value.astype(np.float32).reshape(-1, WAYS)
    for r in merged.collect():  # as many blocks as the weights have
        flat[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] += np.frombuffer(r["data"], np.float32).reshape(BLOCK, WAYS)
    return flat.reshape(weights.shape)


@dataclass
class Model:
    """Broadcast ``words`` (a Vocabulary) and weights, and the table of all words' counts (key, n)."""

    words: object
    weights: np.ndarray
    counts: DataFrame


def train(docs: DataFrame, rounds: int = ROUNDS, task_bytes: int = TASK_BYTES) -> Model:
    """A model of the texts of ``docs`` (doc_id, text), all of which are counted and gone through once.

    A task takes ``task_bytes`` of text at least, where the cluster has no more cores than that makes tasks, so what
    is sent grows with the input, and for a larger input can be held down by a larger value.
    """
    spark = docs.sparkSession
    counts = cut(word_counts(docs))
    words = spark.sparkContext.broadcast(vocabulary(counts))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // task_bytes))
    weights = np.zeros((DEPTH, FEATURES, ROWS, WAYS), np.float32)
    for k in range(rounds):
        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k)
        weights = _gradient_round(part, words, weights, tasks)
        release(spark)
    return Model(words, weights, counts.select("key", "n"))


NUMBERS = "held_out boolean, n_tokens long, n_known long, base_score double, score double, key long, tf long"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, as log10 probabilities of the whole text.

    Null and empty texts are an end alone; words of any length and texts of any length count whole. Repeated rows and
    null ids (which count as the empty id, so as training documents) come back as they are; other columns aren't read,
    so their names may clash; an empty table gives no rows, and without training documents every count is 0.

    Tasks write a row for each text, with what they know of it, and a row for each word of the text that is beyond
    the table that they are told; those words' counts are joined by key, each once for a text.
    """
    spark = docs.sparkSession
    words, weights = model.words, spark.sparkContext.broadcast(model.weights.astype(np.float16))
    names = ["rid", "doc_id", *[c.split()[0] for c in NUMBERS.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, table_of = words.value, weights.value.astype(np.float32)
        reader, biases = Reader(vocabulary), vocabulary.biases()
        within = np.log10(vocabulary.sizes + vocabulary.kinds + 1)  # a shared slot's words, and one not seen
        whole = np.log10(vocabulary.tokens + vocabulary.distinct + 1)
        for batch in batches:
            for part in text_slices(batch, "text"):
                tokens, starts = reader.read(texts_of(part, "text"))
                slot, count = reader.slot[tokens], reader.count[tokens]
                known = np.log10(count + 1.0)
                own = log_probabilities(table_of, biases, reader.contexts(tokens, starts), slot) / np.log(10)
                own += np.where(slot >= SLOTS - SHARED, known - within[slot], 0)
                sizes = np.diff(starts, append=len(tokens))
                held, base, full = (np.add.reduceat(x, starts) for x in (np.minimum(count, 1), known, own))
                numbers = [pa.array(x) for x in (sizes, held, base - sizes * whole, full)]
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("doc_id"), part.column("held_out"), *numbers, *[pa.nulls(part.num_rows, pa.int64())] * 2], names=names)
                rare = count == 0
                pair, many = np.unique(np.repeat(np.arange(len(starts)), sizes)[rare] * len(reader.key) + tokens[rare], return_counts=True)
                empty = [pa.nulls(len(pair), t) for t in (part.column("doc_id").type, pa.bool_(), *[n.type for n in numbers])]
                rid = part.column("rid").to_numpy()[pair // len(reader.key)]
                yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), *empty, pa.array(reader.key[pair % len(reader.key)]), pa.array(many, pa.int64())], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "text")
    folder = shared_dir(spark, "lm")
    rows.mapInArrow(tidy(run), f"rid long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, {NUMBERS}").write.parquet(folder)
    found = spark.read.parquet(folder)
    counts = model.counts.where(_level() < words.value.least)
    more = found.where("key IS NOT NULL").select("rid", "key", "tf").join(counts, "key").groupBy("rid").agg(F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("more"), F.sum("tf").alias("seen"))
    plus = lambda a, b, zero: (F.col(a) + F.coalesce(b, F.lit(zero))).alias(a)
    texts = found.where("key IS NULL").join(more, "rid", "left")
    return texts.select("doc_id", "held_out", "n_tokens", plus("n_known", "seen", 0), F.lit(words.value.tokens).cast("long").alias("train_tokens"), plus("base_score", "more", 0.0), plus("score", "more", 0.0))


def query() -> Callable:
    """The registered query: learns from the documents whose remainder modulo 7 isn't 2, and scores all."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        return score(docs, train(docs.where(remainder(F.col("doc_id"), 7) != 2)))

    return run
