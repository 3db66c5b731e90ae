"""Periodic runs of words, by recompression into a run-length grammar.

The words of a batch of texts stand in one row of symbols, before them and after each text a symbol that
occurs nowhere else. Rounds of compression alternate: blocks of equal neighbours become one symbol with a length, then the
letters are split into a left and a right class and every left letter followed by a right one becomes one
symbol. What a text looks like after a round depends on its symbols alone, so equal stretches are compressed
alike but for their ends, and how far two places agree (their longest common extension) is found by climbing
both as long as their symbols agree and descending at the first that differ: a step or two for each round.

A run of period p and at least 4p words holds at least 3p neighbouring places i with word i = word i + p, so
one of them is a multiple of 3p. These places are asked, for each p, how far they and the places p further
agree to either side, which gives the run exactly. No suffix array is made.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from shroud.llm.common import table, text_slices, texts_of, tidy

#: A run has this many periods, and words, at least.
PERIODS, LEAST = 4, 6
#: Splits of the letters that a round of pair compression chooses from, and candidates that are extended at a time.
SPLITS, CHUNK = 4, 1 << 18


@dataclass
class Round:
    """A row of symbols after one step of compression; ``child`` is where each begins in the row before, ``size`` how many of its symbols it holds."""

    symbols: np.ndarray
    child: np.ndarray
    size: np.ndarray
    blocks: bool


def _round(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> Round:
    child = np.flatnonzero(starts).astype(np.int32)
    size = np.diff(child, append=len(symbols)).astype(np.int32)
    first = symbols[child].astype(np.int64)
    rest = size if blocks else np.where(size == 2, symbols[np.minimum(child + 1, len(symbols) - 1)] + 1, 0)
    names, _ = pd.factorize(first * (int(rest.max()) + 1) + rest)
    return Round(names.astype(np.int32), child, size, blocks)


def grammar(symbols: np.ndarray, seed: int = 1) -> list[Round]:
    """The rounds of compression from a row of symbols (numbers from 0) to a single symbol, the row itself first."""
    rng, rounds = np.random.default_rng(seed), [Round(symbols.astype(np.int32), np.arange(len(symbols), dtype=np.int32), np.ones(len(symbols), np.int32), False)]
    while len(row := rounds[-1].symbols) > 1:
        starts = np.concatenate([[True], row[1:] != row[:-1]])
        if not starts.all():
            rounds.append(_round(row, starts, True))
            continue
        best = None
        while best is None or best.all():  # neighbours differ now, so a split that pairs some exists
            for _ in range(SPLITS):
                left = rng.integers(0, 2, int(row.max()) + 1, dtype=np.int8).astype(bool)
                starts = np.concatenate([[True], ~(left[row[:-1]] & ~left[row[1:]])])
                if best is None or starts.sum() < best.sum():
                    best = starts
        rounds.append(_round(row, best, False))
    return rounds


def backward(rounds: list[Round]) -> list[Round]:
    """The same grammar read from the end."""
    found, below = [], len(rounds[0].symbols)
    for r in rounds:
        found.append(Round(r.symbols[::-1], (below - r.child - r.size)[::-1], r.size[::-1], r.blocks))
        below = len(r.symbols)
    return found


def _parents(rounds: list[Round]) -> list[np.ndarray]:
    """For each symbol of a row the symbol of the next one that begins with it, or -1 within one."""
    found = []
    for lower, upper in zip(rounds, rounds[1:], strict=False):
        up = np.full(len(lower.symbols), -1, np.int32)
        up[upper.child] = np.arange(len(upper.child), dtype=np.int32)
        found.append(up)
    return found


def extensions(rounds: list[Round], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols from a[k] on equal those from b[k] on, for a[k] < b[k] and rows whose last symbol occurs once."""
    up, a, b = _parents(rounds), a.astype(np.int64), b.astype(np.int64)
    origin, stopped, active = a.copy(), np.full(len(a), -1), np.arange(len(a))
    for level in range(len(rounds)):
        row = rounds[level].symbols
        same = row[a[active]] == row[b[active]]
        if level + 1 < len(rounds):
            climb = up[level]
            if rounds[level + 1].blocks:  # what is left of the blocks decides
                end = rounds[level + 1].child + rounds[level + 1].size
                number = np.cumsum(climb >= 0) - 1
                x, y = a[active], b[active]
                inside = same & ((climb[x] < 0) | (climb[y] < 0))
                left, right = end[number[x]] - x, end[number[y]] - y
                step = np.where(inside, np.minimum(left, right), 0)
                a[active] += step
                b[active] += step
                same &= ~inside | (left == right)
            else:  # within a pair: one more, and the next symbol of both begins a pair or neither does
                for _ in range(2):
                    x, y = a[active], b[active]
                    inside = same & ((climb[x] < 0) | (climb[y] < 0))
                    a[active[inside]] += 1
                    b[active[inside]] += 1
                    same[inside] = row[a[active[inside]]] == row[b[active[inside]]]
        stopped[active[~same]] = level
        active = active[same]
        if level + 1 < len(rounds):
            a[active], b[active] = up[level][a[active]], up[level][b[active]]
        if not len(active):
            break
    for level in range(int(stopped.max(initial=0)), 0, -1):
        down = np.flatnonzero(stopped >= level)
        upper, row = rounds[level], rounds[level - 1].symbols
        x, y = upper.child[a[down]], upper.child[b[down]]
        common = np.where(row[x] == row[y], np.minimum(upper.size[a[down]], upper.size[b[down]]) if upper.blocks else 1, 0)
        a[down], b[down] = x + common, y + common
    return a - origin


def candidates(words: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods p, some CHUNK at a time: i a multiple of 3p with word i = word i + p, for texts in falling order of their ``sizes`` (each with its end) after a first symbol."""
    ends, places, periods, many = 1 + np.cumsum(sizes), [], [], 0
    for p in range(1, (int(sizes.max(initial=0)) - 1) // PERIODS + 1):
        reach = int(ends[np.searchsorted(-sizes, -PERIODS * p) - 1]) - p  # of texts with 4p words
        at = np.flatnonzero(words[: reach : (PERIODS - 1) * p] == words[p : reach + p : (PERIODS - 1) * p])
        if len(at):
            places.append(at * (PERIODS - 1) * p)
            periods.append(np.full(len(at), p))
            many += len(at)
        if many >= CHUNK:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, many = [], [], 0
    if many:
        yield np.concatenate(places), np.concatenate(periods)


def runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as numbers of words, its runs: rows (start, length, period) by start, then period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) + 1 for k in order], np.int64)
    first = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    words = np.concatenate([[first + len(order)], *[part for n, k in enumerate(order) for part in (texts[k], [first + n])]]).astype(np.int64)
    found, made = np.zeros((0, 3), np.int64), None
    for places, periods in candidates(words, sizes):
        near = (periods == 1) | (words[places + 1] == words[places + periods + 1]) | (words[places - 1] == words[places + periods - 1])
        places, periods = places[near], periods[near]
        if made is None:
            rounds = grammar(words)
            made = rounds, backward(rounds)
        for at in range(0, len(places), CHUNK):
            i, p = places[at : at + CHUNK], periods[at : at + CHUNK]
            ahead = extensions(made[0], i, i + p)
            behind = extensions(made[1], len(words) - i - p, len(words) - i)
            start, length = i - behind, behind + ahead + p
            fits = length >= np.maximum(LEAST, PERIODS * p)
            found = np.concatenate([found, np.stack([start, length, p], axis=1)[fits]])
        # of equal stretches the smallest period counts: greater ones are its multiples
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        found = found[np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])] if len(found) else found
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    begins = 1 + np.cumsum(sizes) - sizes
    owner = np.searchsorted(begins, found[:, 0], side="right") - 1
    found[:, 0] -= begins[owner]
    split = np.searchsorted(owner, np.arange(len(order) + 1))
    result: list[np.ndarray] = [found[:0]] * len(texts)
    for n, k in enumerate(order):
        result[k] = found[split[n] : split[n + 1]]
    return result


def dropped(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 0] + found[:, 1], -1)
    return np.cumsum(step[:n]) > 0


def longest(found: np.ndarray) -> tuple[int, int, int] | None:
    """(start, length, period) of the run with the greatest length / period; of equal ones the first by start, then period."""
    if not len(found):
        return None
    ratio = found[:, 1] / found[:, 2]
    near = found[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    return min(map(tuple, near), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def repeated(numbers: np.ndarray, doc_id: object) -> np.ndarray:
    """A tenth of the texts, picked by the id, with their words from one on in a repeating pattern: word i >= a is word a + (i - a) % p."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(numbers)
    if h % 10 or not n:
        return numbers
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([numbers[:a], numbers[a + np.arange(n - a) % p]])


COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _described(words: list[bytes], numbers: np.ndarray, found: np.ndarray) -> tuple:
    best, gone = longest(found), dropped(len(numbers), found)
    listed = "".join([f"{s},{n},{p}\n" for s, n, p in found.tolist()])
    kept = b" ".join([words[k] for k in numbers[~gone].tolist()])
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def find_runs(docs: DataFrame, change: Callable[[np.ndarray, object], np.ndarray] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the number of runs, the run of the greatest exponent (nulls without a run), and hashes of all runs and of the text without what runs repeat.

    Words are stretches without ASCII white space. ``change`` may replace a text's word numbers, given with its
    id, before runs are sought. Null and empty texts have no words and no runs; a very long text is taken whole,
    alone, in memory of about 300 bytes a word. Repeated rows and null ids come back as they are; other columns
    aren't read, so their names may clash; an empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, number = part.column("id").to_pylist(), {}
                split = [[number.setdefault(w, len(number)) for w in t.encode().split()] for t in texts_of(part, "text")]
                texts = [np.array(t, np.int64) for t in split]
                texts = [change(t, i) for t, i in zip(texts, ids, strict=True)] if change else texts
                words = list(number)
                rows = [_described(words, t, f) for t, f in zip(texts, runs(texts), strict=True)]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.string()] * 2, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=[id_col, *[c.split()[0] for c in COLUMNS.split(", ")]])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(tidy(run), f"`{id_col}` {kind}, {COLUMNS}")


def query() -> Callable:
    """The registered query over the whole table of documents, a tenth of which get a repeating end."""
    return lambda spark, sf_dir: find_runs(table(spark, sf_dir, "documents"), repeated)
