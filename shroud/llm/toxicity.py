"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, so a misspelling that was never seen
shares most of its vector with the word it stands for. A bag is a run of WINDOW words: its mean
embedding goes through a softmax, and a text scores as its worst bag does. A label belongs to the whole
text, so training picks in every round the bag of each text that scores highest and fits embeddings
and softmax to those bags together.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.common import remainder, table, text_slices, texts_of, tidy
from shroud.llm.ngrams import WordScores, labelled_sample, word_ngrams

WINDOW, LOW, HIGH, BITS, DIMENSIONS = 3, 3, 8, 17, 8
LEAST, ROUNDS, STEPS, RATE, SHRINK = 5, 15, 4, 0.03, 1e-3
#: The model is fitted on at most so many ids of each label and so many bytes of their texts.
MOST, MOST_BYTES = 2000, 6 << 20
#: Bags of a text of label 1 that training goes through in turn.
BAGS = 3


@dataclass
class Model:
    """Per bucket the embedding's part in the log-odds, and what the softmax adds and multiplies."""

    scores: np.ndarray
    bias: float
    scale: float

    def word_scores(self) -> WordScores:
        return WordScores(self.scores, LOW, HIGH)


def _words(text: str) -> list[str]:
    return text.lower().split()


def window_means(values: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest mean of ``window`` adjacent values within each run of the given sizes (a shorter run as a whole), and where it starts.

    Empty runs have mean 0.
    """
    best, at = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    starts = np.cumsum(sizes) - sizes
    short = sizes < window
    best[short] = (total[(starts + sizes)[short]] - total[starts[short]]) / np.maximum(sizes[short], 1)
    at[short] = starts[short]
    long = np.flatnonzero(~short)
    if len(long):
        means = (total[window:] - total[:-window]) / window
        # windows that run over the end of a text count as lowest
        owner_end = np.repeat(starts + sizes, sizes)[: len(means)]
        means = np.where(np.arange(len(means)) + window <= owner_end, means, -np.inf)
        edges = starts[long]
        best[long] = np.maximum.reduceat(means, edges) if len(long) == len(sizes) else [means[i : i + n - window + 1].max() for i, n in zip(edges, sizes[long], strict=True)]
        owner = np.repeat(np.arange(len(sizes)), sizes)[: len(means)]
        hit = np.flatnonzero(means == best[owner])
        at[owner[hit[::-1]]] = hit[::-1]
        at[short] = starts[short]
    return best, at


def vocabulary_ngrams(words: list[str], step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of all n-grams, by word, in 32 bits."""
    owners, buckets = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(words), step):
        owner, bucket = word_ngrams(words[at : at + step], LOW, HIGH, BITS)
        order = np.argsort(owner, kind="stable")
        owners.append((owner[order] + at).astype(np.int32))
        buckets.append(bucket[order].astype(np.int32))
    return np.concatenate(owners), np.concatenate(buckets)


def fit(rows: list[tuple[str, int]], seed: int = 7) -> Model:
    """Embeddings and softmax fitted to labelled texts; without texts of both labels, a model that gives all texts their share."""
    rng, labels = np.random.default_rng(seed), np.array([int(y) for _, y in rows])
    share = (labels.sum() + 0.01) / (len(labels) + 1)
    prior = float(np.log(share / (1 - share)))
    number: dict[str, int] = {}
    texts = [np.fromiter((number.setdefault(w, len(number)) for w in _words(t)), np.int32) for t, _ in rows]
    sizes = np.array([len(t) for t in texts], np.int64)
    if len(set(labels[sizes > 0].tolist())) < 2:
        return Model(np.zeros((1 << BITS, 1), np.float32), prior, 1.0)
    flat = np.concatenate(texts)
    owner, bucket = vocabulary_ngrams(list(number))
    many = np.maximum(np.bincount(owner, minlength=len(number)), 1)
    first = np.searchsorted(owner, np.arange(len(number) + 1))
    balance = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))

    def of_words(score: np.ndarray) -> np.ndarray:
        return np.bincount(owner, score[bucket], len(number)) / many

    # at first a bag is picked by how much more often its n-grams are in texts of label 1
    pairs = np.unique(np.repeat(np.arange(len(texts)), sizes) * len(number) + flat)
    doc, word = pairs // len(number), pairs % len(number)
    seen = [np.bincount(word, labels[doc] == y, len(number)) for y in (0, 1)]
    per = [np.bincount(bucket, seen[y][owner], 1 << BITS) for y in (0, 1)]
    odds = np.log((per[1] + 0.5) / (labels.sum() + 1)) - np.log((per[0] + 0.5) / ((1 - labels).sum() + 1))
    known = (per[0] + per[1] >= LEAST)[:, None]  # rarer n-grams have no vector
    embed = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)) * known
    soft, bias = rng.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)
    embed[:, 0] += known[:, 0] * odds / 2  # the first dimension starts from those odds
    soft[0] = -1, 1
    sums = [np.full_like(x, 1e-6) for x in (embed, soft, bias)]
    score = embed @ (soft[:, 1] - soft[:, 0])
    logits = of_words(score)
    toxic = (labels == 1) & (sizes > BAGS * WINDOW)
    for turn in range(ROUNDS):
        left = logits[flat]
        _, at = window_means(left, sizes, WINDOW)
        for _ in range(turn % BAGS):  # a text of label 1 also teaches its next best bags, so its weaker words are learned
            left[(at[toxic, None] + np.arange(WINDOW)).ravel()] = -30
            at = np.where(toxic, window_means(left, sizes, WINDOW)[1], at)
        length = np.minimum(sizes, WINDOW)
        bag = np.repeat(np.arange(len(texts)), length)
        words = flat[np.concatenate([np.arange(a, a + n) for a, n in zip(at, length, strict=True)])]
        grams = first[words + 1] - first[words]
        where = np.repeat(first[words] - np.concatenate([[0], np.cumsum(grams)[:-1]]), grams) + np.arange(grams.sum())
        row, feature = np.repeat(bag, grams), bucket[where]
        weight = np.repeat(1 / (many[words] * length[bag]), grams)
        for _ in range(STEPS):
            mean = np.stack([np.bincount(row, weight * embed[feature, k], len(texts)) for k in range(DIMENSIONS)], axis=1)
            z = mean @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(labels)), labels] -= 1
            p *= balance[:, None] / len(labels) * 50
            back = p @ soft.T
            slope = [np.stack([np.bincount(feature, weight * back[row, k], 1 << BITS) for k in range(DIMENSIONS)], axis=1) * known + SHRINK * embed, mean.T @ p + SHRINK * soft, p.sum(axis=0)]
            for x, g, total in zip((embed, soft, bias), slope, sums, strict=True):
                total += g * g
                x -= RATE * g / np.sqrt(total)
        score = embed @ (soft[:, 1] - soft[:, 0])
        logits = of_words(score)
    best, _ = window_means(logits[flat], sizes, WINDOW)
    return Model(score.astype(np.float32)[:, None], *calibrate(best, labels))


def fit_and_calibrate(rows: list[tuple[str, int]]) -> Model:
    """A model fitted to all rows; the curve from its scores to probabilities comes from two models that each saw the other half."""
    rows = sorted(rows, key=lambda r: zlib.crc32(r[0].encode()))
    model, labels, halves = fit(rows), np.array([int(y) for _, y in rows]), []
    for k in (0, 1):
        other = fit(rows[1 - k :: 2])
        raw = Model(other.scores, 0.0, 1.0)
        p = text_scores([t for t, _ in rows[k::2]], raw, raw.word_scores())
        halves.append((np.log(p / (1 - p)), labels[k::2]))
    x, y = (np.concatenate(c) for c in zip(*halves, strict=True))
    if len(rows) >= 100 and 0 < y.sum() < len(y):
        model.bias, model.scale = calibrate(x, y)
    return model


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(bias, scale) of the logistic curve through scores x and labels y, by Newton steps with a slight pull to 0."""
    w = np.array([0.0, 1.0])
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + 1e-3 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        w = w - move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
    return float(w[0]), float(w[1])


def train(spark: SparkSession, sf_dir: str, most: int = MOST, most_bytes: int = MOST_BYTES) -> Model:
    """Fitted on the labelled documents that aren't held out (crc32 of the id modulo 5 is not 0), at most ``most`` ids of each label and ``most_bytes`` of text; see ``labelled_sample``."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    return fit_and_calibrate(labelled_sample(table(spark, sf_dir, "documents"), labels, F.col("toxic"), most, most_bytes))


def text_scores(texts: list[str], model: Model, scores: WordScores) -> np.ndarray:
    """Probability of label 1 for each text."""
    split = [_words(t) for t in texts]
    values = scores.of([w for t in split for w in t])[:, 0]
    best, _ = window_means(values, np.array([len(t) for t in split], np.int64), WINDOW)
    return 1 / (1 + np.exp(-np.clip(model.bias + model.scale * best, -30, 30)))


def score_batches(batches: Iterator[pa.RecordBatch], column: str, model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    scores = model.word_scores()
    for batch in batches:
        for part in text_slices(batch, column):
            yield part, text_scores(texts_of(part, column), model, scores)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Null and empty texts score as an empty bag does, and equal texts equally; a score of 0.5 exactly
    counts as 1. A very long text is scored whole, by its worst bag. Null ids and repeated rows come
    back as they are; other columns aren't read, so their names may clash; an empty table gives no
    rows. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def run(batches):
        for part, p in score_batches(batches, "text", shared.value):
            p = pa.array(p)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), p, pc.cast(pc.greater_equal(p, 0.5), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they are; null, empty, long and repeated texts as in ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, p in score_batches(batches, "text", shared.value):
            yield part.filter(pa.array(p < threshold))

    return docs.mapInArrow(tidy(run), docs.schema)


def query() -> Callable:
    """The registered query over the whole table of documents."""
    return lambda spark, sf_dir: score(table(spark, sf_dir, "documents"), train(spark, sf_dir))
