"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained, from labelled good and from labelled bad texts. A text is compressed in
chunks with either one, and the difference of the two sizes for each byte of the text says which it is
more like: text that repeats itself needs neither dictionary and lies near 0, far from good text. As a
few bytes say little, every text counts as if PRIOR bytes of average good text stood before it. A
logistic curve fitted to labelled texts that no dictionary has seen turns that normalised difference,
and nothing else, into a probability.
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
from shroud.llm.ngrams import labelled_sample

#: Dictionary bytes, bytes compressed at a time (a dictionary helps most at the start), level.
DICTIONARY, CHUNK, LEVEL = 16 << 10, 512, 3
#: Bytes of average good text that stand before every text.
PRIOR = 128
#: A dictionary is trained from runs of STRETCH bytes, PER_TEXT of them of each text at most.
STRETCH, PER_TEXT = 200, 3
#: The model is fitted on at most so many ids of each label and so many bytes of their texts.
MOST, MOST_BYTES = 3000, 24 << 20


@dataclass
class Model:
    good: bytes
    bad: bytes
    raw: bool  # dictionaries are plain text, for want of samples to train them
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # of 1 and the difference
    usual: float = 0.0  # difference for each byte of good text

    def sizes(self) -> Sizes:
        return Sizes(self)


class Sizes:
    """Compressed sizes under the two dictionaries, without the bytes that any frame has."""

    def __init__(self, model: Model):
        import zstandard

        self.usual = model.usual
        kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_AUTO
        self.by = []
        for content in (model.good, model.bad):
            shared = zstandard.ZstdCompressionDict(content, dict_type=kind) if content else None
            self.by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=shared))
        self.frame = [len(c.compress(b"")) for c in self.by]

    def features(self, texts: list[str]) -> np.ndarray:
        """(size under the dictionary of bad text - size under that of good text) / bytes of each text, with PRIOR bytes of good text before it."""
        out = np.zeros((len(texts), 1))
        (good, bad), (g0, b0) = (c.compress for c in self.by), self.frame
        for i, text in enumerate(texts):
            data, g, b = text.encode(), 0, 0
            for at in range(0, len(data), CHUNK):
                part = data[at : at + CHUNK]
                g += len(good(part)) - g0
                b += len(bad(part)) - b0
            out[i] = (b - g + PRIOR * self.usual) / (len(data) + PRIOR)
        return out


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and spread of the features, and weights of the logistic curve through them, by Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.c_[np.ones(len(x)), (x - mean) / spread]
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(w))
        move = np.linalg.solve(curve, design.T @ (p - y) + 1e-2 * w)
        w = w - move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
    return mean, spread, w


def _dictionary(texts: list[str]) -> tuple[bytes, bytes]:
    """Trained dictionary (empty if there are too few samples), and the plain text it would be made of."""
    import zstandard

    samples = []
    for data in (t.encode() for t in texts):
        start = zlib.crc32(data) % max(1, len(data) - PER_TEXT * STRETCH)
        samples += [data[at : at + STRETCH] for at in range(start, min(len(data), start + PER_TEXT * STRETCH), STRETCH)]
    try:
        trained = zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    return trained, b"\n".join(samples)[:DICTIONARY]


def fit(rows: list[tuple[str, int]]) -> Model:
    """Dictionaries from every second labelled text, the curve from the others; without both labels, the share of label 1 for every text."""
    rows = sorted(((t, int(y)) for t, y in rows if t), key=lambda r: zlib.crc32(r[0].encode()))
    seen, unseen = (rows[::2], rows[1::2]) if len(rows) >= 20 else (rows, rows)
    y = np.array([k for _, k in unseen])
    if len({k for _, k in seen}) < 2 or len(set(y.tolist())) < 2:
        share = (sum(k for _, k in rows) + 1) / (len(rows) + 1)  # no labels: nothing is rejected
        prior = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return Model(b"", b"", True, np.zeros(1), np.ones(1), np.array([prior, 0]))
    (good, plain_good), (bad, plain_bad) = (_dictionary([t for t, k in seen if k == label]) for label in (1, 0))
    raw = not (good and bad)
    model = Model(plain_good if raw else good, plain_bad if raw else bad, raw, np.zeros(1), np.ones(1), np.zeros(2))
    texts = [t for t, _ in unseen]
    size = np.array([len(t.encode()) for t in texts])
    plain = model.sizes().features(texts)[:, 0] * (size + PRIOR)  # nothing is usual as yet
    model.usual = float(plain[y == 1].sum() / size[y == 1].sum())
    model.mean, model.spread, model.weights = logistic(model.sizes().features(texts), y)
    return model


def probabilities(texts: list[str], model: Model, sizes: Sizes) -> np.ndarray:
    z = ((sizes.features(texts) - model.mean) / model.spread) @ model.weights[1:] + model.weights[0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(spark: SparkSession, sf_dir: str, most: int = MOST, most_bytes: int = MOST_BYTES) -> Model:
    """Fitted on the labelled documents that aren't held out (crc32 of the id modulo 3 is 1), at most ``most`` ids of each label and ``most_bytes`` of text; see ``labelled_sample``."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    return fit(labelled_sample(table(spark, sf_dir, "documents"), labels, F.col("quality"), most, most_bytes))


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    sizes = model.sizes()
    for batch in batches:
        for part in text_slices(batch, "text"):
            yield part, probabilities(texts_of(part, "text"), model, sizes)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Null and empty texts score as average good text, and equal texts equally; a score of 0.5 exactly
    counts as 1. A very long text is scored whole, chunk by chunk. Null ids and repeated rows come back
    as they are; other columns aren't read, so their names may clash; an empty table gives no rows. No
    shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries

    def run(batches):
        for part, p in score_batches(batches, shared.value):
            p = pa.array(p)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), p, pc.cast(pc.greater_equal(p, 0.5), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, all columns as they are; null, empty, long and repeated texts as in ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, p in score_batches(batches, shared.value):
            yield part.filter(pa.array(p >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)


def query() -> Callable:
    """The registered query over the whole table of documents."""
    return lambda spark, sf_dir: score(table(spark, sf_dir, "documents"), train(spark, sf_dir))
