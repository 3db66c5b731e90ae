"""Runs of words against a plain search of all periods."""

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shroud.llm import periodic_runs as R


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words, h = (text or "").encode().split(), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed, kept = "".join(f"{s},{m},{q}\n" for s, m, q in found), b" ".join(w for i, w in enumerate(words) if i not in gone)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


#: Words of a small alphabet, with stretches that repeat, some of them within others.
stretch = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 9)).map(lambda x: x[0] * x[1])
row = st.lists(stretch, max_size=5).map(lambda parts: [w for p in parts for w in p])


@settings(max_examples=400, deadline=None)
@given(st.lists(row, max_size=5))
def test_runs_of_a_batch(rows):
    found = R.runs([np.array(r, np.int64) for r in rows])
    assert [[tuple(x) for x in f.tolist()] for f in found] == [plain_runs(r) for r in rows]


@settings(max_examples=200, deadline=None)
@given(row.filter(bool), st.data())
def test_extensions_over_the_grammar(row, data):
    words = np.array([8, *row, 9])
    i = data.draw(st.integers(1, len(row)))
    j = data.draw(st.integers(1, len(row)))
    if i != j:
        i, j = sorted((i, j))
        ahead = next(k for k in range(len(words)) if words[i + k] != words[j + k])
        assert R.extensions(R.grammar(words), np.array([i]), np.array([j])).tolist() == [ahead]


def test_every_round_expands_to_the_row():
    words = np.array([9, *[0, 0, 1] * 9, *range(1, 9), 0])
    for r in R.grammar(words)[1:]:
        assert int(r.size.sum()) == int(r.child[-1] + r.size[-1])
    assert len(R.grammar(words)[-1].symbols) == 1


def test_long_texts_of_one_word_and_of_a_phrase():
    assert R.runs([np.zeros(100_000, np.int64)])[0].tolist() == [[0, 100_000, 1]]
    assert R.runs([np.arange(100_000) % 7])[0].tolist() == [[0, 100_000, 7]]


def test_query_rows(spark):
    texts = [None, "", " \t", "a", "a b " * 40, "x " * 9 + "y", "é É é É é É é É", "a\x1cb\x85c d", "a b c d e f g h i j k l m n o p q r s t", "same same", "same same", "go " * 5000 + "on and on and on and on and on"]
    rows = [(None if i == 1 else i, texts[i % len(texts)], 1, "clash") for i in range(12 * len(texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs int, period string").repartition(3)
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in R.find_runs(docs, R.repeated).collect()), key=key)
    assert got == sorted((plain_row(r[0], r[1]) for r in rows), key=key)
    assert R.find_runs(docs.limit(0), R.repeated).count() == 0
