"""Hard negatives against all inner products, and each threshold join against a plain one."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shroud.llm import hard_negatives as H
from tests.support import duck_rows, engine, spark_rows


def plain(rows, positives=5, negatives=5):
    """Rows (vec_id, label, vector) to the result, over all pairs."""
    good = {}
    for i, y, v in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            made = (((y + 1) % 10 if i % 7 == 0 else y), [math.floor(256 * x) for x in v])
            good[i] = min(good.get(i, made), made)
    found = []
    for a, (label, v) in good.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in good.items()}
        first = lambda ids: sorted(ids, key=lambda i: (-score[i], i))
        for p in first(i for i in good if i != a and good[i][0] == label)[:positives]:
            near = first(i for i in good if good[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p])[:negatives]
            found += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(near)]
    return sorted(found)


def mined(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "label AS rank", "label AS shard", "'x' AS query")
    kept = H.clean(frame)
    return sorted(map(tuple, H.mine(kept, kept.where("vec_id % 100 = 0"), **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)), [float(np.float32(x)) for x in rng.normal(0, 0.2, 12)]) for i in range(600)]
    rows += [(i, int(rng.integers(0, 4)), rows[100][2]) for i in range(600, 700)]  # a hot vector, with ties
    assert mined(spark, rows, shard_rows=150) == mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (100, 1, []), (200, 2, None), (None, 1, [1.0]), (300, None, [1.0]), (1, 1, [nan, 1.0]), (2, 1, [inf]), (3, 2, [None, 1.0]), (4, 1, [0.5]), (5, 1, [0.5, 0.25, 3.0]), (6, 3, [0.5]), (8, 3, [0.45]), (9, 4, [-1.0]), (10, 1, [-2.0]), (7, 0, [0.75, 0.1]), (14, 9, [0.5])]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == [] and mined(spark, [(5, 1, [1.0])]) == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 20), st.sampled_from([1, 40, 10**7]), st.booleans())
def test_search_of_a_shard(seed, n, width, size, same):
    rng = np.random.default_rng(seed)
    rows, queries = rng.integers(-size, size + 1, (n, width)), rng.integers(-size, size + 1, (6, width))
    labels, own = rng.integers(0, 2, n), rng.integers(0, 2, 6)
    floors = rng.choice([H.NO_FLOOR, 0, size * size, -size], 6)
    ceilings = np.maximum(rng.choice([H.NO_CEILING, 3 * size * size], 6), floors)
    q, r, score = H.search(H.Shard(np.arange(n), labels, rows), np.arange(6), own, queries, floors, ceilings, 3, same)
    got = sorted(zip(q.tolist(), (-score).tolist(), r.tolist(), strict=True))
    want = []
    for k in range(6):
        fits = [(k, -int(s), i) for i, s in enumerate(rows @ queries[k]) if floors[k] <= s <= ceilings[k] and ((labels[i] == own[k] and i != k) if same else labels[i] != own[k])]
        want += sorted(fits)[:3]
    assert got == sorted(want)


def test_probe_keeps_every_pair_and_leaves_dimensions_out():
    rng = np.random.default_rng(5)
    rows, queries = rng.integers(-60, 60, (500, 32)), rng.integers(-60, 60, (20, 32))
    shard = H.Shard(np.arange(500), np.zeros(500, int), rows)
    asked = queries[:, shard.order]
    least = (0.4 * np.sqrt((asked**2).sum(axis=1)) * shard.rest[:, 0].max()).astype(np.int64)
    kept, _ = shard.index(0.4 * shard.rest[:, 0].max())
    assert 0 < kept.mean() < 30
    q, r, score = H.probe(shard, asked, least)
    all_scores = queries @ rows.T
    assert sorted(zip(q.tolist(), r.tolist(), strict=True)) == sorted(zip(*[x.tolist() for x in np.nonzero(all_scores >= least[:, None])], strict=True))
    assert (score == all_scores[q, r]).all()


def test_query_against_sql(spark, sf_dir):
    assert spark_rows(H.query()(spark, sf_dir)) == duck_rows(engine(sf_dir), H.SQL)
