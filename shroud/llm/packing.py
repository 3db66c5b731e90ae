"""Packing of tokenised documents into sequences by minimum bin slack.

A task tokenises its rows as they stream by. Whole windows of ``capacity`` tokens leave a document at
once; what remains of each document waits in a bounded pool. Over the pool's histogram of lengths a
subset-sum search picks the multiset that fills a sequence closest to its capacity, and the multiset
found is used as often as the counts allow. A sequence that no multiset fills is topped up by
cutting one more remainder, so every sequence is full, but for the last few of a task, whose lengths
are the powers of two that make up what is left: nothing is padded. No shuffle; a task holds its
pool and no more, whatever the size of a source or a group of copies.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shroud.llm.common import LONGEST, table, text_slices, texts_of, tidy

CAPACITY = 2048
#: Remainders that wait in a task before they are packed.
POOL = 4096
#: Chunks of text whose ids a worker remembers.
MEMORY = 450_000
END_ID = 1


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum comes closest to capacity without passing it.

    Reachable sums are the bits of one integer; a length's copies are added in runs of 1, 2, 4, ...,
    and the sums before each run are kept, from which the counts are traced back. The search ends as
    soon as the capacity itself is reached. Longer lengths are tried first.
    """
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, run = min(counts[length], capacity // length), 1
        while left > 0:
            run = min(run, left)
            steps.append((length, run, reach))
            reach |= (reach << (length * run)) & mask
            left, run = left - run, run * 2
        if reach >> capacity:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, run, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + run
            at -= length * run
    return chosen


class WordEncoder:
    """Token ids of texts as little-endian 32-bit bytes, from a word-level tokenizers file.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    chunks. Texts are split, and their distinct chunks numbered, by Arrow; each distinct chunk of a
    call is looked up once, and the ids of all texts are gathered by numpy. Words are remembered.
    That holds for the characters of SAFE; other texts, and those that may hold the string of a
    special token, are encoded whole.
    """

    #: No white space but the plain kind, and below U+0250 lower case is one to one and composition changes nothing.
    UNSAFE = re.compile("[\x1c-\x1fİɐ-\U0010ffff]|<\\|")
    #: Signs that may follow letters: two pieces before merging. Letters alone are one, which ends with the first token that ends a word.
    SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, tokenizer_file: str, memory: int = MEMORY):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.usual = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.plain = normalizers.Sequence([]), pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.memory = memory
        self.chunks: dict[str, bytes] = {}  # words with signs behind them
        self.words: dict[str, bytes] = {}
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _unsafe(self, text: str) -> bool:
        if text.isascii():  # the common case, by plain searches
            return "<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
        return self.UNSAFE.search(text) is not None

    def encode(self, texts: list[str]) -> list[bytes]:
        unsafe = [self._unsafe(t) for t in texts]
        whole = iter(self.tokenizer.encode_batch_fast([t for t, u in zip(texts, unsafe, strict=True) if u], add_special_tokens=False))
        split = iter(self._encode_split([t for t, u in zip(texts, unsafe, strict=True) if not u]))
        return [_raw(next(whole).ids) if u else next(split) for u in unsafe]

    def _encode_split(self, texts: list[str]) -> list[bytes]:
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        coded = lists.values.dictionary_encode()
        number = coded.indices.to_numpy()
        known = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, sizes = np.frombuffer(b"".join(known), "<u4"), size[number]
        ends = np.cumsum(sizes)
        at = np.repeat((np.cumsum(size) - size)[number] - (ends - sizes), sizes)  # from a place in the texts to that in the distinct chunks
        at += np.arange(len(at))
        raw = ids[at].tobytes()
        stops = 4 * np.append(0, ends)[lists.offsets.to_numpy()]
        return [raw[i:j] for i, j in pairwise(stops.tolist())]

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks."""
        words, pairs = self.words, self.chunks
        for memory in (words, pairs):
            if len(memory) > self.memory:
                memory.clear()
        words[""] = b""  # what white space at either end of a text leaves
        found = list(map(words.get, chunks))
        plain, rest, two = set(), set(), []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            chunk = chunks[k]
            if (ids := pairs.get(chunk)) is not None:
                found[k] = ids
            elif (word := chunk.rstrip(self.SIGNS)).isalpha():
                if word not in words:
                    plain.add(word)
                if word != chunk:
                    two.append((k, word, after := chunk[len(word) :]))
                    if after not in words:
                        rest.add(after)
            else:
                rest.add(chunk)
        self._learn(sorted(plain), sorted(rest))
        for k, word, after in two:
            found[k] = pairs[chunks[k]] = words[word] + words[after]
        for k in [k for k, ids in enumerate(found) if ids is None]:
            found[k] = words[chunks[k]]
        for memory, new in ((words, chain(plain, rest)), (pairs, [chunks[k] for k, _, _ in two])):
            for chunk in [c for c in new if len(c) > LONGEST]:
                del memory[chunk]
        return found

    def _learn(self, plain: list[str], rest: list[str]) -> None:
        """Remembers the ids of letters alone, many of which are encoded as one text that needs splitting at spaces only, and of other chunks."""
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.plain
        for at in range(0, len(plain), 4000):
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain[at : at + 4000])], add_special_tokens=False)[0].ids, "<u4")
            raw, stops = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            self.words.update(zip(plain[at : at + 4000], [raw[i:j] for i, j in zip([0, *stops], stops, strict=False)], strict=True))
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.usual
        for chunk, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.words[chunk] = _raw(found.ids)


def _raw(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Packer:
    """Sequences of one task. ``out`` gathers pieces: id, start, length, crc32, document's tokens, sequence, offset."""

    def __init__(self, task: int, capacity: int = CAPACITY, pool: int = POOL):
        self.capacity, self.pool = capacity, pool
        self.next_id = task << 33
        self.waiting: dict[int, deque] = {}
        self.n_waiting = 0
        self.out: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, c = len(ids) // 4, self.capacity
        for start in range(0, total - c + 1, c):
            self._emit([((doc_id, start, total), ids[4 * start : 4 * (start + c)])])
        if rest := total % c:
            self._wait((doc_id, total - rest, total), ids[-4 * rest :])
        if self.n_waiting >= self.pool:
            self.pack()

    def _wait(self, which: tuple, ids: bytes) -> None:
        self.waiting.setdefault(len(ids) // 4, deque()).append((which, ids))
        self.n_waiting += 1

    def _take(self, length: int) -> tuple:
        found = self.waiting[length]
        piece = found.popleft()
        self.n_waiting -= 1
        if not found:
            del self.waiting[length]
        return piece

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for (doc_id, start, total), ids in pieces:
            self.out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def _fill(self, pieces: list[tuple], room: int) -> None:
        """Tops pieces up to ``room`` more tokens: the shortest remainder that is long enough is cut, else the longest goes in whole."""
        while room:
            longer = [n for n in self.waiting if n >= room]
            which, ids = self._take(min(longer) if longer else max(self.waiting))
            take = min(room, len(ids) // 4)
            pieces.append((which, ids[: 4 * take]))
            if rest := ids[4 * take :]:
                self._wait((which[0], which[1] + take, which[2]), rest)
            room -= take
        self._emit(pieces)

    def pack(self) -> None:
        """Packs the pool into full sequences until less than one sequence waits: first each two lengths that fill a sequence exactly, then multisets."""
        for length in sorted(n for n in self.waiting if 2 * n >= self.capacity):
            other = self.capacity - length
            while length in self.waiting and other in self.waiting and (length != other or len(self.waiting[length]) > 1):
                self._emit([self._take(length), self._take(other)])
        total = sum(n * len(w) for n, w in self.waiting.items())
        while total >= self.capacity:
            chosen = closest_fill({n: len(w) for n, w in self.waiting.items()}, self.capacity)
            filled = sum(n * k for n, k in chosen.items())
            times = min(len(self.waiting[n]) // k for n, k in chosen.items()) if filled == self.capacity else 1
            for _ in range(times):
                self._fill([self._take(n) for n, k in chosen.items() for _ in range(k)], self.capacity - filled)
            total -= times * self.capacity

    def finish(self) -> None:
        """The last tokens, in sequences whose lengths are powers of two."""
        self.pack()
        total = sum(n * len(w) for n, w in self.waiting.items())
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                self._fill([], 1 << bit)


_encoders: dict[tuple[str, int], WordEncoder] = {}


def _encoder(tokenizer_file: str, memory: int) -> WordEncoder:
    """The worker's encoder; tasks reach it by this function's name, as what a task itself refers to comes to it as a copy."""
    if (tokenizer_file, memory) not in _encoders:
        _encoders[tokenizer_file, memory] = WordEncoder(tokenizer_file, memory)
    return _encoders[tokenizer_file, memory]


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, pool: int = POOL, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY, keep: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and END_ID; a null text counts as empty, whose single token is END_ID.
    Repeated rows and null ids are documents of their own; other columns aren't read; an empty table
    gives no rows. A very long text is cut into whole windows as any other; of remainders of one length
    the one that came first goes first. ``memory`` bounds the chunks that a worker remembers,
    and without ``keep`` it forgets them and the tokenizer when its task ends. ``capacity`` should be a power of two, so that full sequences need no padding.
    Sequence ids are unique over the table: the task's number times 2**33, and a count.
    """

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file, memory) if keep else WordEncoder(tokenizer_file, memory)
        packer, kind = Packer(TaskContext.get().partitionId(), capacity, pool), None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.out, strict=True)) or [()] * 7
            packer.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, kind if k == 0 else pa.int64()) for k, c in enumerate(columns)], names=names)

        for batch in batches:
            kind = batch.schema.field("id").type
            for part in text_slices(batch, "text"):
                for doc_id, ids in zip(part.column("id").to_pylist(), encoder.encode(texts_of(part, "text")), strict=True):
                    packer.add(doc_id, ids + END_ID.to_bytes(4, "little"))
                if len(packer.out) > 20_000:
                    yield flush()
        packer.finish()
        if packer.out:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(tidy(run), schema)


def query(tokenizer_file: str) -> Callable:
    """The registered query over the whole table of documents."""
    return lambda spark, sf_dir: pack_documents(table(spark, sf_dir, "documents"), tokenizer_file)
