"""Fingerprints against a per-bit count, links and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from shroud.llm import components, simhash


def plain_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, pairs):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("text", ["", " \n\t ", "One", "One two", "ÀB c D", "a b c", "a b a b a b a b", "x y\x1cz w v u", "the end of the line " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text)


def near_copies(rng, n):
    base = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(30)) for _ in range(rng.randrange(40, 200))) for _ in range(n)]
    for _ in range(n):
        words = rng.choice(base).split()
        words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
        base.append(" ".join(words))
    return base


def test_whole_query_against_all_pairs(spark):
    rng = random.Random(5)
    texts = [*near_copies(rng, 120), *["same text here again"] * 5, None, "", " ", "ab", "AB"]
    rows = [(i * 7 % 1009, t, "x", "y") for i, t in enumerate(texts)] + [(None, "same text here again", "x", "y"), (0, texts[0], "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp string").repartition(3)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [(i, plain_fingerprint(t)) for i, t, *_ in rows if i is not None]
    pairs = [(a, b) for a, x in prints for b, y in prints if a < b and bin(x ^ y).count("1") <= 2]
    want = plain_components([i for i, _ in prints], pairs)
    assert len(set(want.values())) < len(want) - 20
    for r in got:
        if r.doc_id is not None:
            assert (r.component_id, r.fingerprint) == (want[r.doc_id], f"{dict(prints)[r.doc_id]:016x}")
    (orphan,) = [r for r in got if r.doc_id is None]
    assert orphan.component_id == min(i for i, t, *_ in rows if t == "same text here again" and i is not None)


def test_shards_lose_no_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.int64)
    fps = np.unique(np.concatenate([base, base[:700] ^ (1 << rng.integers(0, 62, 700)), base[:300] ^ (1 << rng.integers(0, 62, 300)) ^ (1 << rng.integers(0, 62, 300))]))
    nodes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, rep long")
    edges = simhash.links(nodes, 2, shards=13)
    assert edges.count() <= 3 * len(fps)
    label = {r.node: r.component for r in components.connected_components(edges).collect()}
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    want = plain_components(range(len(fps)), list(zip(*np.nonzero(np.triu(close, 1)), strict=True)))
    assert {i: label.get(i, i) for i in range(len(fps))} == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_components_of_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(i, i % 7 + 501) for i in range(500, 508)] + [(900, 900), (None, 3), (5, 200)]
    rng = random.Random(2)
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    clean = [e for e in edges if e[0] is not None]
    assert got == plain_components({x for e in clean for x in e}, clean)
