"""Counts and base scores against a plain version; the model's probabilities add up and beat the base."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shroud.llm import maxent_lm as M
from shroud.llm.common import remainder, table


def plain(rows):
    """(doc_id, text) to held_out, n_tokens, n_known, train_tokens and base score of each."""
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    tokens = [[*"".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split(), b" "] for _, t in rows]
    counts = Counter(w for h, t in zip(held, tokens, strict=True) for w in t if not h)
    whole = sum(counts.values())
    return [(i, h, len(t), sum(w in counts for w in t), whole, sum(math.log10((counts[w] + 1) / (whole + len(counts) + 1)) for w in t)) for (i, _), h, t in zip(rows, held, tokens, strict=True)]


def scored(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, 7, "clash") for i, t in rows], "doc_id long, text string, n_tokens int, key string").repartition(3)
    return M.score(docs, M.train(docs.where(remainder(F.col("doc_id"), 7) != 2), **more)).collect()


def same(got, want):
    shown = lambda r, base: (str(r[0]), *r[1:5], round(base, 6))
    assert sorted(shown(r, r["base_score"]) for r in got) == sorted(shown(r, r[5]) for r in want)


@pytest.mark.parametrize("told", [1 << 19, 8])
def test_counts_and_base(spark, monkeypatch, told):
    monkeypatch.setattr(M, "TABLE", told)
    texts = [None, "", " \t\n", "The the THE É é", "a b a b a b", "a\x1cb c\x85d \x00 e", "x" * 70_000, "long words " * 20_000, "same text here", "same text here", "rare%d word%d" % (1, 2)]
    rows = [(None if k == 5 else k, texts[k % len(texts)] if k % 3 else f"unique{k} the a{k % 7}") for k in range(90)] + [(3, "repeated id"), (3, "repeated id")]
    got = scored(spark, rows)
    same(got, plain(rows))
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)


def test_no_texts_to_learn_from(spark):
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2]
    got = scored(spark, [(k, "some words") for k in held])
    same(got, plain([(k, "some words") for k in held]))
    assert scored(spark, []) == []


def test_documents_and_what_is_learned(spark, sf_dir):
    got = {r["doc_id"]: r for r in M.query()(spark, sf_dir).collect()}
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    same(got.values(), plain(rows))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    total = lambda pick: sum(r["score"] for r in got.values() if pick(r))
    assert total(lambda r: not r["held_out"]) > sum(r["base_score"] for r in got.values() if not r["held_out"])


def test_order_of_words_counts(spark):
    rng = np.random.default_rng(4)
    step = {k: rng.permutation(40)[:3] for k in range(40)}  # each word is followed by one of three

    def walk(n):
        at, found = 0, []
        for _ in range(n):
            at = int(rng.choice(step[at]))
            found.append(f"w{at}")
        return found

    rows = [(k, " ".join(walk(400))) for k in range(300)]
    mixed = [(k + 1000, " ".join(rng.permutation(t.split()))) for k, t in rows if zlib.crc32(str(k + 1000).encode()) % 7 == 2]
    got = {r["doc_id"]: r for r in scored(spark, rows + mixed)}
    held = [k for k, _ in rows if got[k]["held_out"]]
    mean = lambda ids, what: sum(got[i][what] for i in ids) / sum(got[i]["n_tokens"] for i in ids)
    assert mean(held, "score") > mean(held, "base_score") + 0.3
    assert mean([k for k, _ in mixed], "score") < mean(held, "score") - 0.3


def small_model(words, seed):
    """A vocabulary with slots of words' own and shared ones, and random weights."""
    rng = np.random.default_rng(seed)
    keys = np.sort(np.array([M.word_key(w) for w in words]))
    slots = np.array([rng.integers(0, M.SLOTS) for _ in words])
    sizes, kinds = np.zeros(M.SLOTS), np.zeros(M.SLOTS)
    sizes[-M.SHARED :] = 3
    kinds[-M.SHARED :] = 2
    return M.Vocabulary(keys, rng.integers(1, 50, len(words)), slots, sizes, kinds, 1000, 100, 0), rng.normal(0, 1, (M.DEPTH, M.FEATURES, M.ROWS, M.WAYS)).astype(np.float32)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10**6), st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), min_size=2, max_size=5))
def test_slots_of_a_context_add_up_to_one(seed, before):
    words, weights = small_model([b"a", b"b", b"c"], seed)
    reader = M.Reader(words)
    tokens, starts = reader.read([b" ".join(before).decode()])
    contexts = [np.repeat(c[-1:], M.SLOTS) for c in reader.contexts(tokens, starts)]
    logs = M.log_probabilities(weights, words.biases(), contexts, np.arange(M.SLOTS))
    assert abs(np.exp(logs).sum() - 1) < 1e-3


def test_contexts_stay_within_their_text():
    words, _ = small_model([b"a", b"b", b"c"], 1)
    reader = M.Reader(words, memory=1)
    alone = [reader.contexts(*reader.read([t])) for t in ("a b c", "", "b b", "c")]
    together = reader.contexts(*reader.read(["a b c", "", "b b", "c"]))
    for f in range(M.FEATURES):
        assert np.concatenate([c[f] for c in alone]).tolist() == together[f].tolist()


def test_steps_follow_the_slope():
    words, weights = small_model([b"a", b"b"], 2)
    reader, biases = M.Reader(words), words.biases()
    tokens, starts = reader.read(["a b " * 50])
    contexts, slot = reader.contexts(tokens, starts), reader.slot[tokens]
    learner = M.Learner(weights, biases)
    before = M.log_probabilities(weights, biases, contexts, slot).sum()
    for _ in range(3):
        learner.learn(contexts, slot)
    assert M.log_probabilities(learner.weights, biases, contexts, slot).sum() > before
    assert learner.seen.sum() == 3 * M.DEPTH * M.FEATURES * len(tokens)


def test_words_spelt_alike_stand_together():
    words = [f"{a}{b}" for a in ("schw", "ough", "eaux") for b in ("en", "er", "es", "et")]
    order = [words[k][:4] for k in M.spelling_order(words)]
    assert sorted(M.spelling_order(words)) == list(range(12))
    assert sum(a != b for a, b in zip(order, order[1:])) <= 5


def test_words_are_numbered_as_python_splits_them():
    texts = ["", " ", " A\tb\x0bc \x0c", "\x1c x\x85\xa0É  Q", "\n\nq", "q q", "ÀB \x00 b"]
    words, numbers, stops = M.numbered_words(texts)
    want = [t.encode().lower().split() for t in texts]
    assert [[words[n] for n in numbers[i:j]] for i, j in zip(stops[:-1], stops[1:], strict=True)] == want
    assert len(set(words)) == len(words)
    assert M.word_keys([b"a", "é".encode()]).tolist() == [M.word_key(b"a"), M.word_key("é".encode())]
