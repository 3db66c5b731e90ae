"""Token counts by byte-pair merging over a heap and a linked list.

A text's tokens are counted as a sentencepiece byte-pair model with byte fallback splits it: every
character starts as a symbol of its own, the adjacent pair of the lowest rank is merged again and
again (the leftmost of equal rank first), and what is left over is counted. No identifier is made.

Merging is exact within stretches that no piece of the vocabulary can span, so a text is cut between
two characters that stand next to each other in no piece. Counts of stretches are kept in a bounded
memory of each Python worker; forgetting one costs time only.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from shroud.llm.common import LONGEST, text_slices, texts_of

#: Stretches of at most LONGEST characters that a worker remembers.
MEMORY = 500_000
SPACE = "▁"


class PieceCounter:
    """Counts the tokens of texts for one sentencepiece byte-pair model file."""

    def __init__(self, model_file: str, memory: int = MEMORY):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        self.ranks = {model.id_to_piece(i): -model.get_score(i) for i in ids if not special(i)}
        self.pairs = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}
        if any(p[1] == SPACE != p[0] or "\n" in p for p in self.pairs):
            raise ValueError("pieces of this model span words or lines; its texts can't be cut there")
        self.memory = memory
        self.stretches: dict[str, int] = {}
        outer = self

        class Chunks(dict):
            def __missing__(self, key: str) -> int:
                found = outer._chunk(key if key[:1] == "\n" else SPACE + key)
                if len(key) <= LONGEST:
                    self[key] = found
                return found

        self.chunks = Chunks()

    def count(self, text: str) -> int:
        """Tokens of a text; none for the empty text."""
        if not text:
            return 0
        keys = text.replace("\n", " \n").split(" ")
        if "" in keys or SPACE in text:  # runs of spaces belong to what follows them
            whole = SPACE + text.replace(" ", SPACE)
            parts = re.findall(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*", whole)
            keys = [p if p[0] == "\n" else p[1:] for p in parts]
        return sum(map(self.chunks.__getitem__, keys))

    def forget(self) -> None:
        """Empties the memory once it is over its bound."""
        if len(self.chunks) > self.memory:
            self.chunks.clear()
        if len(self.stretches) > self.memory:
            self.stretches.clear()

    def _chunk(self, chunk: str) -> int:
        total, start, pairs, known = 0, 0, self.pairs, self.stretches
        for i in range(1, len(chunk) + 1):
            if i == len(chunk) or chunk[i - 1 : i + 1] not in pairs:
                part = chunk[start:i]
                if (found := known.get(part)) is None:
                    found = self.merged(part)
                    if len(part) <= LONGEST:
                        known[part] = found
                total += found
                start = i
        return total

    def merged(self, part: str) -> int:
        """Initial symbols less merges; a character without a piece stands for its UTF-8 bytes."""
        ranks, end = self.ranks, len(part)
        symbols: list[str | None] = list(part)
        units = [1 if c in ranks else len(c.encode()) for c in part]
        total = sum(units)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(ranks[p], i) for i in range(end - 1) if (p := part[i : i + 2]) in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            left, j = symbols[i], after[i]
            if left is None or j >= end or ranks.get(left + symbols[j]) != rank:
                continue  # one of the two was merged since
            symbols[i], symbols[j] = left + symbols[j], None
            total -= units[i] + units[j] - 1
            units[i] = 1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (found := ranks.get(symbols[i] + symbols[k])) is not None:
                    heapq.heappush(heap, (found, i))
            if (k := before[i]) >= 0 and (found := ranks.get(symbols[k] + symbols[i])) is not None:
                heapq.heappush(heap, (found, k))
        return total


_counters: dict[str, PieceCounter] = {}


def _counter(model_file: str) -> PieceCounter:
    if model_file not in _counters:
        _counters[model_file] = PieceCounter(model_file)
    return _counters[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. A very long text is counted whole, cut where no
    piece can span, and equal texts have equal counts. Repeated rows and null ids come back as they are;
    other columns are not read, so their names may clash. An empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            for part in text_slices(batch, "text"):
                tokens = [counter.count(t) for t in texts_of(part, "text")]
                counter.forget()
                sizes = pc.cast(pc.fill_null(pc.binary_length(part.column("text")), 0), pa.int64())
                tokens = pa.array(tokens, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), sizes, tokens, pc.greater(tokens, limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def query(model_file: str) -> Callable:
    """The registered query over the whole table of documents."""
    from shroud.llm.common import table

    return lambda spark, sf_dir: count_tokens(table(spark, sf_dir, "documents"), model_file)
