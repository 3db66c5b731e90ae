"""Language by error-correcting output codes over character n-grams.

Each language has a codeword of bits. For every bit a linear classifier of hashed character n-grams
tells the languages with a 1 there from those with a 0. A text's margins are decoded by loss: the
codeword with the smallest sum of weighted losses is the nearest; bits that were told apart badly on
kept-back rows weigh less. A text is ambiguous if its bits lie further from the nearest codeword than
the code can correct, or if the runner-up is close.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.common import remainder, table, text_slices, texts_of
from shroud.llm.ngrams import WordScores, labelled_sample, word_ngrams

LOW, HIGH, BITS = 1, 4, 15
EPOCHS, RATE, SHRINK = 25, 0.5, 1e-5
#: The classifiers are fitted on at most so many ids of each language and so many bytes of their texts, RUNS runs of RUN characters of each.
MOST, MOST_BYTES, RUNS, RUN = 1000, 24 << 20, 2, 150
CLOSE = 0.9
UNKNOWN = "und"
_PLAIN_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; fractions, superscripts and circled digits aren't."""
    return _PLAIN_LETTER.search(text) is not None or any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # of each bit
    scores: np.ndarray  # buckets x bits
    bias: np.ndarray
    scale: float

    def word_scores(self) -> WordScores:
        return WordScores(self.scores, LOW, HIGH)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A row of -1 and 1 for each of n classes: all ways to split up to 6 classes in two, else the best of many random codes."""
    if n <= 6:
        splits = [[1 if k == 0 else (1 if s >> (k - 1) & 1 else -1) for k in range(n)] for s in range(max(1, 2 ** (n - 1) - 1))]
        return np.array(splits, np.int64).reshape(-1, n).T
    rng, best = np.random.default_rng(seed), None
    for _ in range(200):
        code = np.where(rng.random((n, 10 * int(np.ceil(np.log2(n))))) < 0.5, -1, 1)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = least_distance(code)
        if best is None or least > best[0]:
            best = (least, code)
    return best[1]


def least_distance(code: np.ndarray) -> int:
    apart = (code[:, None] != code[None]).sum(axis=2) + code.shape[1] * np.eye(len(code), dtype=int)
    return int(apart.min())


def fit(rows: list[tuple[str, str]]) -> Model:
    """Classifiers of every bit, fitted together by gradient steps; a fifth of the rows is kept back to weigh bits and set the scale."""
    rows = [(t.lower(), y) for t, y in rows if has_letter(t)]
    languages = sorted({y for _, y in rows})
    codes = codewords(len(languages)) if languages else np.zeros((0, 1), np.int64)
    if len(languages) < 2:
        return Model(languages, codes, np.ones(codes.shape[1]), np.zeros((1 << BITS, codes.shape[1]), np.float32), np.zeros(codes.shape[1]), 1.0)
    rows.sort(key=lambda r: zlib.crc32(r[0].encode()))
    texts, y = [t.split() for t, _ in rows], np.array([languages.index(k) for _, k in rows])
    number: dict[str, int] = {}
    flat = np.array([number.setdefault(w, len(number)) for t in texts for w in t])
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    owner, bucket = word_ngrams(list(number), LOW, HIGH, BITS)
    many = np.bincount(owner, minlength=len(number))
    # a text is the mean of its words, a word the mean of its n-grams: one sparse row for each text
    pair, times = np.unique(doc * len(number) + flat, return_counts=True)
    doc, word = pair // len(number), pair % len(number)
    order = np.argsort(owner, kind="stable")
    bucket, first = bucket[order], np.concatenate([[0], np.cumsum(many)])
    grams = many[word]
    where = np.repeat(first[word] - np.concatenate([[0], np.cumsum(grams)[:-1]]), grams) + np.arange(grams.sum())
    key = np.repeat(doc, grams) * (1 << BITS) + bucket[where]
    share = np.repeat(times / np.maximum(grams, 1) / np.bincount(doc, times, len(texts))[doc], grams)
    key, at = np.unique(key, return_inverse=True)
    value = np.bincount(at, share)
    row, feature = key >> BITS, key & ((1 << BITS) - 1)
    kept = np.arange(len(texts)) % 5 == 0 if len(texts) >= 50 else np.zeros(len(texts), bool)
    target = (codes[y] > 0).astype(float)
    balance = (1 / np.bincount(y)[y] / len(languages))[:, None] * ~kept[:, None]
    norm = np.sqrt(np.bincount(row, value**2, len(texts)).mean())
    value = value / norm
    weight, bias = np.zeros((1 << BITS, codes.shape[1])), np.zeros(codes.shape[1])
    total_w, total_b = np.full_like(weight, 1e-8), np.full_like(bias, 1e-8)

    def margins() -> np.ndarray:
        return np.stack([np.bincount(row, value * weight[feature, k], len(texts)) for k in range(len(bias))], axis=1) + bias

    for _ in range(EPOCHS):
        slope = (1 / (1 + np.exp(-np.clip(margins(), -30, 30))) - target) * balance
        g = np.stack([np.bincount(feature, value * slope[row, k], 1 << BITS) for k in range(len(bias))], axis=1) + SHRINK * weight
        b = slope.sum(axis=0)
        total_w += g * g
        total_b += b * b
        weight -= RATE * g / np.sqrt(total_w)
        bias -= RATE * b / np.sqrt(total_b)
    check = kept if kept.any() else ~kept
    m = margins()[check]
    right = ((m > 0) == (target[check] > 0)).mean(axis=0)
    model = Model(languages, codes, np.maximum(right - 0.5, 1e-3) * 2, (weight / norm).astype(np.float32), bias, 1.0)
    losses = decode_losses(m, model)
    scales = [0.25, 0.5, 1, 2, 4, 8]
    model.scale = max(scales, key=lambda s: float(np.log(_chances(losses, s)[np.arange(len(losses)), y[check]] + 1e-12).mean()))
    return model


def decode_losses(margins: np.ndarray, model: Model) -> np.ndarray:
    """Weighted logistic loss of each row of margins under each language's codeword."""
    return np.stack([np.logaddexp(0, -margins * code) @ model.weights for code in model.codes], axis=1) / model.weights.sum()


def _chances(losses: np.ndarray, scale: float) -> np.ndarray:
    e = np.exp(-scale * 10 * (losses - losses.min(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


def predict(texts: list[str], model: Model, scores: WordScores) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, its share among the codewords' chances, and whether it is ambiguous; UNKNOWN with 0 where no letter is or none was learned."""
    known = [has_letter(t) for t in texts]
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    split = [t.lower().split() if k else [] for t, k in zip(texts, known, strict=True)]
    sizes = np.array([len(t) for t in split])
    sums = np.concatenate([np.zeros((1, len(model.bias))), np.cumsum(scores.of([w for t in split for w in t]), axis=0, dtype=np.float64)])
    ends = np.cumsum(sizes)
    margins = (sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)[:, None] + model.bias
    losses = decode_losses(margins, model)
    best = losses.argmin(axis=1)
    chance = _chances(losses, model.scale)
    share = chance[np.arange(len(texts)), best]
    wrong_bits = (np.sign(margins) != model.codes[best]).sum(axis=1)
    unsure = (wrong_bits > (least_distance(model.codes) - 1) // 2) | (share < CLOSE)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return names, np.where(known, share, 0.0), unsure | ~np.array(known)


def runs(text: str) -> list[str]:
    """RUNS evenly spaced runs of RUN characters, from the text's start to its end; a text that isn't longer as a whole."""
    if len(text) <= RUNS * RUN:
        return [text]
    return [text[k * (len(text) - RUN) // (RUNS - 1) :][:RUN] for k in range(RUNS)]


def train(spark: SparkSession, sf_dir: str, most: int = MOST, most_bytes: int = MOST_BYTES) -> Model:
    """Fitted on documents with a language that aren't held out (crc32 of the id modulo 3 is 1), at most ``most`` ids of each language and ``most_bytes`` of text; see ``labelled_sample``."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.where(F.col("lang").isNotNull() & (remainder(F.col("doc_id"), 3) != 1))
    return fit([(part, y) for text, y in labelled_sample(docs, rows, F.col("lang"), most, most_bytes) for part in runs(text)])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    A null text, or one without a letter, is UNKNOWN with score 0 and ambiguous; of codewords that are
    equally near, the first language in order counts. A very long text is read whole. Null ids and
    repeated rows come back as they are; other columns aren't read, so their names may clash; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS x bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scores = shared.value, shared.value.word_scores()
        for batch in batches:
            for part in text_slices(batch, "text"):
                names, share, unsure = predict(texts_of(part, "text"), model, scores)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(share), pa.array(unsure)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def query() -> Callable:
    """The registered query over the whole table of documents."""
    return lambda spark, sf_dir: identify(table(spark, sf_dir, "documents"), train(spark, sf_dir))
