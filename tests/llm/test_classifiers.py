"""Held-out accuracy of the trained models, and their defined results at the edges."""

import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from shroud.llm import compression_quality, language_id, ngrams, toxicity

SF = "/root/testdata/sf0.1"
EDGES = [None, "", " ", "1234 !!!", "日本語", "x" * 200_000, "der die das", "der die das", "½", "² ①"]


def edges(spark):
    rows = [(None if i == 2 else i, t, "x", 0.5) for i, t in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id long, text string, held_out string, score double").repartition(2)


@pytest.fixture(scope="module")
def held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "lang", "quality", "toxic").collect()
    return rows


def out(rows, mod, rest):
    return [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % mod == rest]


def test_toxicity(spark, held_out):
    model = toxicity.train(spark, SF)
    rows = out(held_out, 5, 0)
    p = toxicity.text_scores([r.text for r in rows], model, model.word_scores())
    y = np.array([r.toxic for r in rows])
    assert ((p >= 0.5) == y).mean() > 0.96 and ((p >= 0.5) & (y == 0)).mean() < 0.01
    scores = model.word_scores()
    seen, typo, plain = (toxicity.text_scores([f"the of {w} and to"], model, scores)[0] for w in ("disgusting", "disgustingg", "stream"))
    assert seen > 0.5 and typo > 0.5 > plain  # a misspelling shares most n-grams
    got = toxicity.score(edges(spark), model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert [r.held_out for r in got if r.doc_id == 4] == [zlib.crc32(b"4") % 5 == 0]
    kept = toxicity.keep_clean(edges(spark), model)
    assert kept.columns == edges(spark).columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_quality(spark, held_out):
    model = compression_quality.train(spark, SF)
    rows = out(held_out, 3, 1)
    p = compression_quality.probabilities([r.text for r in rows], model, model.sizes())
    y = np.array([r.quality for r in rows])
    assert ((p >= 0.5) == y).mean() > 0.98
    got = compression_quality.score(edges(spark), model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    kept = compression_quality.keep_good(edges(spark), model)
    assert kept.columns == edges(spark).columns and kept.count() == sum(r.predicted for r in got)


def test_language(spark):
    model = language_id.train(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = out(docs, 3, 1)
    names, share, unsure = language_id.predict([r.text for r in rows], model, model.word_scores())
    right = np.array([n == r.lang for n, r in zip(names, rows, strict=True)])
    assert right.mean() > 0.99 and unsure[right].mean() < 0.05
    got = {r.doc_id: r for r in language_id.identify(edges(spark), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, None, 3, 8, 9)] == ["und"] * 6 and got[1].score == 0 and got[1].ambiguous
    assert got[6].lang_pred == got[7].lang_pred == "de"


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 20])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert code.shape[0] == n and len({tuple(c) for c in code.tolist()}) == n and language_id.least_distance(code) >= 1
    assert n < 4 or language_id.least_distance(code) >= 3


def test_sample_of_repeats_conflicts_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "one")] * 60 + [(1, "another one"), (2, "x" * 300_000), (3, None), (4, "four"), (5, "five"), (None, "none")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1)] * 60 + [(2, 1), (3, 1), (4, 0), (4, 1), (5, 0), (6, 0), (7, None), (None, 1)], "doc_id long, y int")
    sample = lambda **k: ngrams.labelled_sample(docs, labels, F.col("y"), **({"most": 100, "most_bytes": 1 << 20} | k))
    assert sample() == [("another one", 1), ("five", 0), ("x" * 300_000, 1)]  # once each, whole, and not what has two labels
    assert max(Counter(y for _, y in sample(most=1)).values()) == 1
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = ngrams.labelled_sample(many.select("doc_id", "text"), many, F.col("y"), 300, 1 << 20)
    assert Counter(y for _, y in got) == {0: 300, 1: 300} and got == ngrams.labelled_sample(many.select("doc_id", "text").repartition(7), many, F.col("y"), 300, 1 << 20)
    assert sum(len(t) for t, _ in ngrams.labelled_sample(many.select("doc_id", "text"), many, F.col("y"), 300, 2000)) < 2000 + 20


def test_quality_against_plain_sizes():
    rows = [(f"good words of one kind {k} and more of them", 1) for k in range(40)] + [(f"### bad $$$ {k} %%% junk &&& {k}", 0) for k in range(40)]
    model = compression_quality.fit(rows)
    kind = zstandard.DICT_TYPE_RAWCONTENT if model.raw else zstandard.DICT_TYPE_AUTO
    for text in ("", "a", "good words of another kind", "### junk %%%" * 200, "é" * 700):
        sizes = []
        for content in (model.good, model.bad):
            packer = zstandard.ZstdCompressor(level=compression_quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind))
            data = text.encode()
            sizes.append(sum(len(packer.compress(data[at : at + compression_quality.CHUNK])) - len(packer.compress(b"")) for at in range(0, len(data), compression_quality.CHUNK)))
        difference = (sizes[1] - sizes[0] + compression_quality.PRIOR * model.usual) / (len(text.encode()) + compression_quality.PRIOR)
        z = (difference - model.mean[0]) / model.spread[0] * model.weights[1] + model.weights[0]
        assert compression_quality.probabilities([text], model, model.sizes())[0] == pytest.approx(1 / (1 + np.exp(-z)))
    assert len(model.weights) == 2  # the difference is all that the score has


def test_toxicity_against_plain_bags():
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=(1 << 10, 1)).astype(np.float32), 0.3, 1.7)
    for text in ("", "one", "one two", "One two, three four five!", "a " * 50):
        words = [w.strip(ngrams.SIGNS) for w in text.lower().split()]
        scores = []
        for w in words:
            _, buckets = ngrams.word_ngrams([w], toxicity.LOW, toxicity.HIGH, 10)
            scores.append(float(np.mean([model.scores[b, 0] for b in buckets])) if len(buckets) else 0.0)
        bags = [scores[k : k + toxicity.WINDOW] for k in range(max(1, len(scores) - toxicity.WINDOW + 1))]
        worst = max(float(np.mean(b)) if b else 0.0 for b in bags)
        assert toxicity.text_scores([text], model, model.word_scores())[0] == pytest.approx(1 / (1 + np.exp(-(0.3 + 1.7 * worst))), rel=1e-4)


def test_decoding_against_a_plain_loop():
    rng = np.random.default_rng(4)
    codes = language_id.codewords(4)
    model = language_id.Model(["de", "en", "es", "fr"], codes, rng.random(codes.shape[1]), np.zeros((2, codes.shape[1]), np.float32), np.zeros(codes.shape[1]), 1.0)
    for margins in rng.normal(size=(50, codes.shape[1])):
        losses = [sum(w * np.log1p(np.exp(-m * b)) for w, m, b in zip(model.weights, margins, code, strict=True)) / sum(model.weights) for code in codes]
        assert language_id.decode_losses(margins[None], model)[0] == pytest.approx(losses)


@pytest.mark.parametrize("text,letter", [("½", False), ("² ①", False), ("1234 !!!", False), ("", False), ("ª", True), ("日", True), ("é", True), ("1a", True)])
def test_letters(text, letter):
    assert language_id.has_letter(text) == letter


def test_models_without_labels():
    for rows in ([], [("a b", 1)], [("", 0), ("", 1)]):
        model = toxicity.fit(rows)
        assert toxicity.text_scores(["", "a b c"], model, model.word_scores()).shape == (2,)
        quality = compression_quality.fit(rows)
        assert compression_quality.probabilities(["", "a"], quality, quality.sizes()).shape == (2,)
    none = language_id.fit([])
    assert language_id.predict(["a"], none, none.word_scores())[0] == ["und"]
    one = language_id.fit([("a b", "en")])
    assert language_id.predict(["a", "1"], one, one.word_scores())[0] == ["en", "und"]


def test_ngrams_against_plain_slices():
    words = ["ab", "", "été!", "x" * 30, "?!"]
    owner, bucket = ngrams.word_ngrams(words, 2, 4, 20)
    for k, w in enumerate(words):
        marked = f"<{w.strip(ngrams.SIGNS)}>"
        grams = [marked[i : i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)]
        own = bucket[owner == k]
        assert len(own) == len(grams) and len(set(own.tolist())) == len(set(grams))
    assert set(bucket[owner == 1].tolist()) <= set(bucket[owner == 4].tolist())


@pytest.mark.parametrize("window", [1, 3])
def test_window_means(window):
    rng = np.random.default_rng(1)
    sizes = np.array([0, 5, 1, 2, 0, 9, 3])
    values = rng.normal(size=sizes.sum())
    best, at = toxicity.window_means(values, sizes, window)
    stops = np.cumsum(sizes)
    for k, (a, b) in enumerate(zip(stops - sizes, stops, strict=True)):
        runs = [(values[i : i + window].mean(), i) for i in range(a, b - window + 1)] or [(values[a:b].mean() if b > a else 0.0, a)]
        assert best[k] == pytest.approx(max(runs)[0])
        assert sizes[k] == 0 or at[k] == max(runs)[1]


def test_a_long_text_of_many_words(spark):
    """A million words, one of them toxic, are scored whole, and like any other text by quality and language."""
    long = "the river and the house of the old man " * 110_000
    docs = spark.createDataFrame([(1, long), (2, f"{long} you disgusting idiot"), (3, long)], "doc_id long, text string").repartition(3)
    tox = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(spark, SF)).collect()}
    assert tox[1].score == tox[3].score < tox[2].score
    assert len({r.score for r in compression_quality.score(docs, compression_quality.train(spark, SF)).collect() if r.doc_id != 2}) == 1
    lang = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, language_id.train(spark, SF)).collect()}
    assert lang[1] == lang[3] and lang[1][0] == lang[2][0]
