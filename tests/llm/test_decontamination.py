"""Tiling against a search by hand, the query against brute force over all documents and items."""

import random

import numpy as np
import pytest

from shroud.llm import decontamination as D


def plain_tiles(text, item):
    """Longest unmarked common run first; ties: first in the item, then in the text."""
    least = min(D.SEED, len(item))
    marked_t, marked_i, out = set(), set(), []
    while True:
        best = None
        for b in range(len(item)):
            for a in range(len(text)):
                n = 0
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and a + n not in marked_t and b + n not in marked_i:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return out
        out.append(best)
        marked_t.update(range(best[0], best[0] + best[2]))
        marked_i.update(range(best[1], best[1] + best[2]))


@pytest.mark.parametrize("collide", [False, True])
@pytest.mark.parametrize("seed", range(25))
def test_tiles(seed, collide, monkeypatch):
    rng = random.Random(seed)
    item = [rng.choice("abcd") for _ in range(rng.randrange(1, 30))]
    text = [rng.choice("abcd") for _ in range(rng.randrange(0, 40))] + item[7:] + ["x"] + item[:9] + item
    if collide:  # every hash agrees: the words decide
        monkeypatch.setattr(D.Runs, "hashes", lambda self, starts, length: np.zeros(len(starts), np.uint64))
    assert D.tile_words(text, item) == plain_tiles(text, item)


def test_repetitive_texts(spark):
    same, item = "word " * 30_000, "word " * 2_000
    assert D.tile_words(same.split(), item.split()) == [(0, 0, 2000)]
    mixed = [w for k in range(300) for w in ("a", "a", "a", "a", "a", f"b{k}")]
    assert len(D.tile_words(["a"] * 30_000, mixed)) == 300
    docs = spark.createDataFrame([(1, same), (2, "word " * 1_599), (3, "word " * 1_600), (4, "else " * 30_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "word " * 1_990)], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.n_items) for r in D.decontaminate(docs, bench).collect()}
    assert got == {1: (7, 2), 2: (8, 1), 3: (8, 2), 4: (None, 0)}


def test_short_items(spark):
    docs = spark.createDataFrame([(1, "is it Yes, or"), (2, "three short words"), (3, "short three words"), (4, "a three. short, WORDS b"), (5, "yesterday")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "yes"), (8, "Three short words!"), (9, " ?! "), (10, None)], "item_id long, text string")
    assert {r.doc_id: r.item_id for r in D.decontaminate(docs, bench).collect()} == {1: 7, 2: 8, 3: None, 4: 8, 5: None}


def test_lower_threshold(spark):
    docs = spark.createDataFrame([(1, "a b c d e f x y z")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c d e f 1 2 3 4 5 6")], "item_id long, text string")
    assert [[r.contaminated for r in D.decontaminate(docs, bench, t).collect()] for t in (0.5, 0.6)] == [[True], [False]]


def test_names_that_clash(spark):
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text, 0, 0, 0, 0), (2, "other", 1, 1, 1, 1)], "doc_id long, text string, __key long, __check long, key long, item long")
    kept = D.keep_clean(docs, spark.createDataFrame([(7, text)], "item_id long, text string"))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_query_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 40))) for _ in range(20)] + ["too short item", "", None, "the same item twice over again"] + ["the same item twice over again"]
    docs = []
    for k in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        if k % 3 == 0:
            leak = items[k % 20].split()
            half = len(leak) // 2
            leak = leak[half:] + ["and"] + leak[:half] if k % 2 else leak
            words[10:10] = [w.upper() + "," for w in leak]
        docs.append((k, " ".join(words), "x", 1.5))
    docs += [(200, None, None, None), (None, items[3], "x", 0.0), (3, docs[3][1], "x", 0.0), (201, items[23], "x", 0.0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string, coverage double").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted(D.decontaminate(frame, bench).collect(), key=lambda r: str(tuple(r)))
    want = []
    for doc_id, text, *_ in docs:
        t, best, n = D.words_of(text or ""), (None, 0.0, 0), 0
        for item_id, item in enumerate(items):
            w = D.words_of(item or "")
            found = plain_tiles(t, w) if w else []
            share = sum(x[2] for x in found) / len(w) if found else 0
            if share >= D.COVERAGE:
                n += 1
                if share > best[1]:
                    best = (item_id, share, len(found))
        want.append((doc_id, n > 0, *best, n))
    assert [tuple(r) for r in got] == sorted(want, key=str)
    assert sum(r.contaminated for r in got) >= 28
    kept = D.keep_clean(frame, bench)
    assert kept.columns == frame.columns and kept.count() == sum(not r.contaminated for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert D.decontaminate(none, some.withColumnRenamed("doc_id", "item_id")).collect() == []
    assert [r.contaminated for r in D.decontaminate(some, none.withColumnRenamed("doc_id", "item_id")).collect()] == [False]


def test_a_phrase_in_all_items_and_documents(spark):
    """It joins no item with a document, items are still found, and no text is copied for each of its items."""
    phrase = "answer the following question with one word only please"
    item = lambda k: f"{phrase} " + " ".join(f"q{k}x{i}" for i in range(40))
    items = [(k, item(k)) for k in range(D.COMMON + 20)] + [(1000 + k, phrase) for k in range(D.COMMON + 20)]
    docs = [(k, f"{phrase} and nothing else but k{k}") for k in range(30)] + [(100, item(5)), (101, " ".join(item(k) for k in range(70)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    seeds = D.item_seeds(D.items_of(bench)).cache()
    left = D.telling_seeds(seeds, D.COVERAGE)
    assert left.where("item < 1000 AND n > 0").count() == seeds.where("item < 1000").count() - (D.COMMON + 20) * 5  # the seeds within the phrase
    assert {(r.least, r["count"]) for r in left.where("item >= 1000").groupBy("item", "least").count().collect()} == {(1, 4)}  # an item of nothing else keeps what it needs: two of five seeds
    got = {r.doc_id: r for r in D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert (got[0].contaminated, got[0].n_items, got[0].item_id) == (True, D.COMMON + 20, 1000)
    assert (got[100].n_items, got[101].n_items) == (D.COMMON + 21, D.COMMON + 90)
