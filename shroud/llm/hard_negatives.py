"""Hard negatives of anchors by threshold joins over an inverted index with norm bounds, in the manner of L2AP.

Rows are dealt to shards of bounded size. A task holds one shard and is sent the queries in blocks. For a block
it orders the dimensions by weight and keeps, of each row, only as many of the first ones in posting lists as are
needed: what is left out has so small a norm that it can't reach the block's lowest threshold alone. Postings
are accumulated a few dimensions at a time; after each step a row stays for a query only while its score so far and the
product of the norms of what remains can reach the query's threshold. What stays gets its exact score from
the left out dimensions. A query starts with a high threshold, which is lowered until the window that it asks for is full
or its floor is reached. Scores are whole numbers, and bounds are widened by more than rounding can move them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shroud.llm.common import cut, table, tidy

#: Rows of a shard and queries of a block, about: a task holds the scores of one with the other.
SHARD_ROWS, BLOCK = 16_384, 256
#: Dimensions that are accumulated between two prunings.
STEP = 8
#: First threshold as a share of the product of the query's norm and the shard's largest, and what it is multiplied by when it is lowered.
FIRST, LOWER, LAST = 0.6, 0.7, 0.02
#: Norm products are widened by this factor against rounding.
SLACK = 1 + 1e-9
NO_FLOOR, NO_CEILING = -(1 << 62), 1 << 62
QUERY = "anchor_id long, label int, v array<long>, floor long, ceiling long"


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix; shorter lists end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(column), width), np.int64)
    found[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return found


class Shard:
    """Rows that queries are searched in: ids, labels and vectors of whole numbers."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=0), kind="stable")  # heavy dimensions first
        self.ids, self.labels, self.order, self.vectors = ids, labels, order, vectors[:, order]
        self.rest = suffix_norms(self.vectors)

    def index(self, least: float) -> tuple[np.ndarray, np.ndarray]:
        """How many dimensions of each row posting lists hold, for queries of norm 1 with thresholds of ``least`` or more, and the rows by falling number of them: the list of a dimension is a run from the first row."""
        kept = (self.rest[:, :-1] * SLACK >= least).sum(axis=1)  # norms of suffixes fall, so these are the first ones
        kept = np.minimum(-(-kept // STEP) * STEP, self.vectors.shape[1])
        return kept, np.argsort(-kept, kind="stable")


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norm of what follows before each dimension, and 0 at the end."""
    squares = np.cumsum((vectors.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(vectors), 1))], axis=1))


def probe(shard: Shard, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of all pairs whose score is at least the query's ``least``; ``queries`` in the shard's order of dimensions."""
    left, norms = suffix_norms(queries), np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    kept, rows = shard.index(float((least / np.maximum(norms, 1e-9)).min()))
    kept, width = kept[rows], queries.shape[1]
    exact = np.float64 if norms.max(initial=0) * shard.rest[:, 0].max(initial=0) < 2**52 else np.int64  # sums of whole numbers are exact in both
    postings = np.where(np.arange(width) < kept[:, None], shard.vectors[rows], 0).astype(exact)
    bound = least.astype(np.float64) - np.abs(least.astype(np.float64)) * 1e-12  # a float may lie above the whole number
    wanted, here = np.arange(len(queries)), np.arange(len(rows))
    scores = np.zeros((len(wanted), len(here)), exact)
    for d in range(0, width, STEP):
        listed = int(np.searchsorted(-kept[here], -d))  # rows with postings from here on
        if listed:
            scores[:, :listed] += queries[wanted, d : d + STEP].astype(exact) @ postings[here[:listed], d : d + STEP].T
        open_ = scores + left[wanted, min(d + STEP, width)][:, None] * (SLACK * shard.rest[rows[here], min(d + STEP, width)])[None, :]
        if listed < len(here):  # these rows' lists ended before
            end = kept[here[listed:]]
            open_[:, listed:] = scores[:, listed:] + left[np.ix_(wanted, end)] * (SLACK * shard.rest[rows[here[listed:]], end])[None, :]
        stays = open_ >= bound[wanted][:, None]
        a, b = stays.any(axis=1), stays.any(axis=0)
        if not a.all() or not b.all():
            wanted, here, scores = wanted[a], here[b], scores[np.ix_(a, b)]
            stays = stays[np.ix_(a, b)]
        if not len(wanted):
            break
    if not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y = np.nonzero(stays)
    q, r, score = wanted[x], rows[here[y]], scores[x, y].astype(np.int64)
    for at in range(0, len(q), 1 << 16):
        part = slice(at, at + (1 << 16))
        rest = np.where(np.arange(width) >= kept[here[y[part]], None], shard.vectors[r[part]], 0)
        score[part] += np.einsum("ij,ij->i", queries[q[part]], rest)
    fits = score >= least[q]
    return q[fits], r[fits], score[fits]


def search(shard: Shard, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, floors: np.ndarray, ceilings: np.ndarray, want: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the first ``want`` rows of each query by falling score, then smaller id, between its floor and its ceiling: rows of the same label other than the query itself, or of another label."""
    vectors = vectors[:, shard.order]
    found: list[list[np.ndarray]] = [[], [], []]
    top = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)) * shard.rest[:, 0].max(initial=0) * SLACK + 1
    threshold = np.maximum(np.minimum(FIRST * top, np.where(ceilings < NO_CEILING, 0.95 * ceilings, np.inf)), floors)
    active, factor = np.arange(len(vectors)), LOWER
    while len(active):
        least = np.maximum(np.floor(threshold[active]).astype(np.int64), floors[active])
        q, r, score = probe(shard, vectors[active], least)
        q = active[q]
        fits = (score <= ceilings[q]) & ((shard.labels[r] == labels[q]) & (shard.ids[r] != ids[q]) if same else shard.labels[r] != labels[q])
        q, r, score = q[fits], r[fits], score[fits]
        order = np.lexsort((shard.ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        full = np.bincount(q, minlength=len(vectors))[active] >= want
        done = full | (least <= floors[active])
        taken = (place < want) & np.isin(q, active[done])
        for rows, more in zip(found, (q, r, score), strict=True):
            rows.append(more[taken])
        active = active[~done]
        threshold[active] = np.where(threshold[active] * factor > LAST * top[active], np.maximum(threshold[active] * factor, floors[active]), floors[active])
    return tuple(np.concatenate([np.zeros(0, np.int64), *rows]) for rows in found)


def whole_numbers(vector: Column, factor: int = 256) -> Column:
    """Each component x as floor(factor * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def clean(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``v`` of the rows that take part: null ids, labels, vectors and components, and infinite or undefined components, don't; of rows that repeat an id the least by label, then vector, does."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector_col).isNotNull()).where(fine)
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    kept = good.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.struct(moved.cast("int").alias("label"), whole_numbers(F.col(vector_col)).alias("v"))).alias("r"))
    return kept.select("vec_id", "r.label", "r.v")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.Table]]:
    """(shard, whether rows, not queries) of sorted batches: a shard's rows whole, its queries in blocks."""
    held: list[pa.RecordBatch] = []
    key, many = None, 0

    def flush() -> Iterator[tuple[int, bool, pa.Table]]:
        if held:
            yield key[0], key[1], pa.Table.from_batches(held).combine_chunks()

    for batch in batches:
        shard, kind = batch.column("shard").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
        ends = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
        for start, stop in zip([0, *ends], [*ends, len(shard)], strict=True):
            while start < stop:
                now = (int(shard[start]), not kind[start])
                if now != key or (kind[start] and many >= BLOCK):
                    yield from flush()
                    held, key, many = [], now, 0
                take = stop - start if now[1] else min(stop - start, BLOCK - many)
                held.append(batch.slice(start, take))
                start, many = start + take, many + take
    yield from flush()


def nearest(rows: DataFrame, queries: DataFrame, want: int, same: bool, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``anchor_id``, ``ceiling``, ``vec_id``, ``score``, ``rank`` of the first ``want`` rows (vec_id, label, v) for each of the ``queries`` (QUERY); see ``search``.

    Every shard of about ``shard_rows`` rows is sent all queries, sorted by their floors, so queries of like
    thresholds share an index. What a shard finds for a query is ``want`` rows at most, and those are ranked
    in each task before they are shuffled by query.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    kept = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("query"), F.col("vec_id").alias("anchor_id"), "label", "v", F.lit(0).cast("long").alias("floor"), F.lit(0).cast("long").alias("ceiling"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("query"), "anchor_id", "label", "v", "floor", "ceiling")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, -1
        for number, is_rows, part in _blocks(batches):
            ids, labels, lists = part.column("anchor_id").to_numpy(), part.column("label").to_numpy(), part.column("v").combine_chunks()
            width = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
            if is_rows:
                shard, at = Shard(ids, labels, matrix(lists, width)), number
            elif at == number:  # else no row is in this shard
                both = max(width, shard.vectors.shape[1])
                if both > shard.vectors.shape[1]:
                    shard = Shard(shard.ids, shard.labels, np.pad(shard.vectors[:, np.argsort(shard.order)], ((0, 0), (0, both - shard.vectors.shape[1]))))
                floors, ceilings = part.column("floor").to_numpy(), part.column("ceiling").to_numpy()
                q, r, score = search(shard, ids, labels, matrix(lists, both), floors, ceilings, want, same)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(ceilings[q]), pa.array(shard.ids[r]), pa.array(score)], names=["anchor_id", "ceiling", "vec_id", "score"])

    dealt = kept.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "query", "floor", "anchor_id")
    found = dealt.mapInArrow(tidy(run), "anchor_id long, ceiling long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "ceiling").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, margin: int = 80, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each of the ``anchors`` and each of its first ``positives`` rows of the same label the first ``negatives`` rows of other labels that score between ``margin`` per cent of the positive's score and that score.

    ``rows`` and ``anchors`` as from ``clean``. A row's score is its inner product with the anchor, a whole number
    that must fit a long; higher scores come first, of equal ones smaller ids. A positive with a negative
    score has no such rows; one with score 0 has those of score 0. Vectors of different lengths count as ending in
    zeros, an empty one as zero. Without rows or anchors the result is empty.
    """
    asked = anchors.select(F.col("vec_id").alias("anchor_id"), "label", "v")
    open_ = asked.select("*", F.lit(NO_FLOOR).alias("floor"), F.lit(NO_CEILING).alias("ceiling"))
    best = cut(nearest(rows, open_, positives, True, shard_rows).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    windows = best.where("positive_score >= 0").select("anchor_id", F.col("positive_score").alias("ceiling")).distinct()
    floor = F.expr(f"({margin} * ceiling + 99) div 100")
    near = nearest(rows, asked.join(windows, "anchor_id").withColumn("floor", floor).select(*[c.split()[0] for c in QUERY.split(", ")]), negatives, False, shard_rows)
    pairs = best.join(near.select("anchor_id", F.col("ceiling").alias("positive_score"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank"), ["anchor_id", "positive_score"])
    return pairs.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def query() -> Callable:
    """The registered query: anchors are the rows whose id is divisible by 100, searched in all rows."""

    def run(spark, sf_dir):
        rows = cut(clean(table(spark, sf_dir, "embeddings")))
        return mine(rows, rows.where(F.col("vec_id") % 100 == 0))

    return run


SQL = """
WITH good AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM good a JOIN good r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
