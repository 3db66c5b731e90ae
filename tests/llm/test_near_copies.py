"""The pipeline's stage against brute-force Jaccard over all pairs."""

import random

import numpy as np

import corpus_pipeline
from shroud.llm import near_copies


def plain_set(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_kept(rows):
    sets = {i: plain_set(t) for i, t in rows}
    label = {i: i for i in sets}
    near = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and 5 * len(x & y) >= 4 * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return sorted(i for i in label if label[i] == i)


def made_up(rng):
    """Texts, copies with words changed, chains, and one passage that many texts hold."""
    word = lambda: rng.choice("abcdefgh") * 2 + str(rng.randrange(300))
    line = " ".join(word() for _ in range(20))
    texts = [" ".join(word() for _ in range(rng.randrange(2, 150))) for _ in range(60)]
    texts += [f"{line} {t}" for t in texts[:30]]
    for _ in range(150):
        words = rng.choice(texts).split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    return texts


def test_stage_against_brute_force(spark):
    texts = [*made_up(random.Random(4)), *["the same text again here and there"] * 4, None, "", " ", "ab", "AB", "a b c d e", "a b c d e f"]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = sorted(r.doc_id for r in stage(spark, docs, "").collect())
    want = plain_kept(rows)
    assert len(want) < len(rows) - 40
    assert got == want


def test_stage_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(r.doc_id for r in near_copies.keep_one(docs).collect())
    assert got == plain_kept([(r.doc_id, r.text) for r in docs.collect()])


def test_sketches_never_rule_out_a_link(spark):
    rng = np.random.default_rng(6)
    rows = []
    for n in [1, 2, 63, 64, 65, 128, 129, *rng.integers(1, 900, 60).tolist()]:
        x = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        y = np.unique(np.concatenate([x[: len(x) - len(x) // rng.integers(3, 30)], rng.integers(0, 1 << 62, int(n // rng.integers(3, 30)))]))
        rows.append((x, y))
    keys = [(2 * k + side, len(s), near_copies.sketch(s).tolist()) for k, pair in enumerate(rows) for side, s in enumerate(pair)]
    nodes = near_copies.Nodes(None, spark.createDataFrame(keys, "rep long, n int, sketch array<long>"))
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(rows))] + [(2 * k, 2 * k + 3) for k in range(len(rows) - 1)], "a long, b long")
    left = {(r.a, r.b) for r in near_copies._may_reach(pairs, nodes).collect()}
    near = {2 * k for k, (x, y) in enumerate(rows) if 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y))}
    assert {(a, a + 1) for a in near} <= left and 10 < len(near) < 60
    assert not [p for p in left if p[1] != p[0] + 1 and min(len(rows[p[0] // 2][0]), len(rows[p[1] // 2][1])) > 20]


def test_prefixes_meet(spark):
    rng = np.random.default_rng(2)
    for n in range(1, 120):
        x = np.unique(rng.integers(0, 1 << 40, n))
        y = np.unique(np.concatenate([x[: len(x) - len(x) // 10], rng.integers(0, 1 << 40, n // 10)]))
        common = np.sort(rng.choice(x, len(x) // 2, replace=False))
        order = common, rng.integers(2, 9, len(common))
        if 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y)):
            assert set(near_copies.prefix(x, *order)) & set(near_copies.prefix(y, *order))


def test_stage_with_clashing_names_repeated_ids_and_long_texts(spark):
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60_000))
    cut = " ".join(long.split()[:55_000])  # 0.92 of it
    rows = [(1, long, 1, "x"), (2, cut, 2, "x"), (3, "one text of some seven words here", 3, "x"), (3, "one text of some seven words here", 4, "x"), (4, "one text of some seven words here", 5, "x"), (None, "one text of some seven words here", 6, "x"), (7, "a" * 300_000, 7, "x"), (8, "a" * 300_000, 8, "x"), (9, None, 9, "x"), (10, "", 10, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep long, component_id string").selectExpr("*", "1 AS key", "2 AS fp", "3 AS h", "4 AS sketch", "5 AS label").repartition(4)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text == long) for r in kept.collect()) == [("1", True), ("3", False), ("7", False), ("9", False), ("None", False)]


def test_a_large_group_of_near_copies_is_linked_by_few_pairs(spark, monkeypatch):
    """Copies of one text whose pairs reach 0.8 only in part: one group, though the exact join meets few of their pairs."""
    rng = random.Random(5)
    word = lambda: f"v{rng.randrange(10**6)}"
    base = [word() for _ in range(200)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(200)] = word()
        rows.append((k, " ".join(words)))
    met = []
    across = near_copies.across
    monkeypatch.setattr(near_copies, "across", lambda *given: met.append(across(*given)) or met[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(r.doc_id for r in near_copies.keep_one(docs).collect())
    assert got == plain_kept(rows) and len(got) < 20
    assert met[0].distinct().count() < 1500  # of 11175


def test_meetings_are_those_of_a_plain_join(spark, monkeypatch):
    """Also where a block is handed on in parts."""
    rng = np.random.default_rng(8)
    hashes = rng.integers(-(1 << 63), 1 << 63, 600)
    sets = [(k << 33 | k, int(n), rng.choice(hashes, n).tolist() + [int(hashes[7])]) for k, n in enumerate(rng.integers(0, 12, 80))]
    sets = [(rep, n, sorted(set(h), key=h.index)) for rep, n, h in sets]
    frame = spark.createDataFrame(sets, "rep long, n int, prefix array<long>").repartition(3)
    want = {}
    for rep, n, prefix in sets:
        for i, h in enumerate(prefix):
            want.setdefault(h, set()).add((n, rep, i))
    want = sorted(sorted(v) for v in want.values() if len(v) > 1)
    for held in (1 << 21, 16):
        monkeypatch.setattr(near_copies, "HELD_POSTS", held)
        rows, found = near_copies.meetings(frame).collect(), {}
        for r in rows:
            found.setdefault(r.h, []).append(tuple(r.p))
        assert sorted(sorted(v) for v in found.values()) == want
        assert all(tuple(r.first) <= tuple(r.p) or held == 16 for r in rows)


def test_sets_that_share_a_shingle_without_being_near_make_no_pairs(spark, monkeypatch):
    """Texts with one rare passage in common, in components of their own: their sketches rule the pairs out within the join; none that reaches 0.8 is lost."""
    rng = random.Random(7)
    word = lambda: f"u{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(12))
    rows = [(k, " ".join([passage, *[word() for _ in range(60)]])) for k in range(120)]
    rows += [(200 + k, " ".join([*text.split()[:-2], word(), word()])) for k, text in rows[:10]]
    made = []
    across = near_copies.across
    monkeypatch.setattr(near_copies, "across", lambda *given: made.append(across(*given)) or made[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(r.doc_id for r in near_copies.keep_one(docs).collect())
    assert got == plain_kept(rows) == list(range(120))
    assert made[0].count() < 200  # of 7140 pairs for each shingle of the passage


def test_the_sample_of_common_shingles_grows_with_the_texts(spark, monkeypatch):
    """A shingle that comes as often as one in a few hundred texts is known to be common however many texts there are."""
    monkeypatch.setattr(near_copies, "SAMPLE", 8)
    often = [f"t{i} x{i} same five words in a row y{i}" if i % 10 == 0 else f"a{i} b{i} c{i} d{i} e{i}" for i in range(4000)]
    shingles, counts = near_copies.common_shingles(spark.createDataFrame([(t,) for t in often], "text string"))
    assert len(shingles) == 2 and min(counts) > 15


def test_neighbours_are_the_closest_that_stand_for_a_hub(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 40, 300))
    sets = [np.unique(np.concatenate([base[k:], rng.integers(1 << 41, 1 << 42, k)])) for k in range(20)]
    keys = spark.createDataFrame([(k, len(s), near_copies.sketch(s).tolist()) for k, s in enumerate(sets)], "rep long, n int, sketch array<long>")
    post = lambda k: (len(sets[k]), k, 0)
    shared = spark.createDataFrame([(1, post(k), post(0)) for k in range(20)], "h long, p struct<n:long,rep:long,i:long>, first struct<n:long,rep:long,i:long>")
    asked = []
    may_reach = near_copies._may_reach
    monkeypatch.setattr(near_copies, "_may_reach", lambda pairs, nodes: asked.append(pairs) or may_reach(pairs, nodes))
    got = {(r.a, r.b) for r in near_copies.neighbours(shared, near_copies.Nodes(None, keys)).collect()}
    assert len(got) >= 19 and all(a < b for a, b in got)
    assert not asked  # no row for each of a set's pairs


def test_early_meetings_leave_out_shingles_that_stand_early_in_no_set(spark, monkeypatch):
    """Blocks that are handed on in parts keep them, and say so."""
    sets = [(k, 18, [100 * k + j for j in range(3)] + ([7777] if k % 2 else [])) for k in range(10)] + [(20 + k, 18, [5555, 100 * k + 4000]) for k in range(4)]
    frame = spark.createDataFrame([(rep, n, [h << 40 for h in held]) for rep, n, held in sets], "rep long, n int, prefix array<long>").repartition(2)
    whole = near_copies.meetings(frame, True).collect()
    assert sorted(r.p.rep for r in whole) == [20, 21, 22, 23] and not any(r.parted for r in whole)
    assert len(near_copies.meetings(frame).collect()) == 9
    monkeypatch.setattr(near_copies, "HELD_POSTS", 4)
    parts = near_copies.meetings(frame, True).collect()
    assert {20, 21, 22, 23} <= {r.p.rep for r in parts} and all(r.parted for r in parts if r.p.rep < 20)
