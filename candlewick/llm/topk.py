"""Exact top-k search by block-at-a-time pruning.

Documents in id order are cut into ranges of ``RANGE``, each a group of its own with blocks of ``BLOCK`` documents. A
block has a forward index (its documents' weights by term; here every vector component is a term) and the greatest and
least weight of each term. For a query, a block's bound is the sum over its terms of the larger of query weight times
greatest and times least weight. Blocks are scored in falling order of bounds until a bound falls below the query's k-th
score so far. Each range gives k rows for a query at most, and the last step ranks those. Queries are a stated set, so
each range reads them as a stream; documents move once.

Within a range, documents are put into blocks by similarity (halved along the main direction of their spread, again and
again), so that documents of a cluster share a block and its greatest and least weights are close to each of them.
Vectors spread evenly in all directions have no such clusters, and their blocks are all scored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, table, workers_ready

RANGE, BLOCK = 8192, 256


def _alike(flat: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` of ``flat`` in blocks of at most ``BLOCK``, halved along the direction in which they spread most."""
    if len(rows) <= BLOCK:
        return [rows]
    x = flat[rows].astype(np.float32)
    x -= x.mean(axis=0)
    way = x[np.argmax((x * x).sum(axis=1))]
    for _ in range(3):
        way = x.T @ (x @ way)
        way /= max(np.sqrt(way @ way), 1e-6)
    order = rows[np.argsort(x @ way, kind="stable")]
    half = -(-len(rows) // BLOCK // 2) * BLOCK
    return _alike(flat, order[:half]) + _alike(flat, order[half:])


class _Range:
    """Forward indexes and term bounds of a document range."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        width = max(map(len, vectors))
        flat = np.zeros((len(vectors), width), np.int64)
        for row, v in zip(flat, vectors):
            row[: len(v)] = v
        blocks = _alike(flat, np.arange(len(ids)))
        self.ids, self.forward, self.scored = [ids[b] for b in blocks], [flat[b] for b in blocks], 0
        self.high = np.array([f.max(axis=0) for f in self.forward])
        self.low = np.array([f.min(axis=0) for f in self.forward])

    def best(self, query: int, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        w = min(len(v), self.high.shape[1])
        v = v[:w]
        bound = np.maximum(self.high[:, :w] * v, self.low[:, :w] * v).sum(axis=1)
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in np.argsort(-bound, kind="stable"):
            if len(scores) == k and bound[b] < scores[-1]:
                break
            self.scored += 1
            i, s = self.ids[b], self.forward[b][:, :w] @ v
            if len(scores) == k:  # ties go to smaller ids, so equal scores stay
                keep = s >= scores[-1]
                i, s = i[keep], s[keep]
            keep = i != query
            ids, scores = np.append(ids, i[keep]), np.append(scores, s[keep])
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
        return ids, scores


def _search(k: int):
    def run(batches):
        now, held, here = None, [], None
        for batch in batches:
            out = [[], [], []]
            rows = zip(*(batch.column(c).to_pylist() for c in ("g", "is_query", "vec_id")), batch.column("v"))
            for g, is_query, i, v in rows:
                v = v.values.to_numpy(zero_copy_only=False)
                if g != now:
                    now, held, here = g, [], None
                if not is_query:
                    held.append((i, v))
                    continue
                if here is None:
                    here = _Range(np.array([x for x, _ in held]), [x for _, x in held])
                ids, scores = here.best(i, v, k)
                out[0].append(np.full(len(ids), i))
                out[1].append(ids)
                out[2].append(scores)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out],
                                                 ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """vectors and queries: vec_id (long), v (array<long>, not null) -> query_id, rank, vec_id, score: the k highest inner
    products of each query over the vectors with another id (fewer if there are fewer), ties to smaller ids.

    Vectors of other lengths score over the components both have, so an empty vector scores 0. Rows with a null id take
    no part. Each of several equal rows is a candidate; queries that repeat are asked once, and queries that share an id
    are ranked together. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    workers_ready(spark)
    usable = F.col("vec_id").isNotNull()
    docs = vectors.where(usable).select("vec_id", "v")
    docs = stage(docs.repartitionByRange("vec_id").sortWithinPartitions("vec_id").withColumn(
        "m", F.monotonically_increasing_id()), "vectors")
    part, row = F.shiftright("m", 33), F.col("m").bitwiseAND((1 << 33) - 1)
    sizes = sorted(docs.groupBy(part.alias("p")).count().collect())  # a row for each partition
    n, before = 0, []
    for p, c in sizes:
        before.append((p, n))
        n += c
    before = spark.createDataFrame(before, "p long, before long")
    ranges = -(-n // RANGE)
    docs = docs.withColumn("p", part).join(F.broadcast(before), "p").select(
        F.floor((F.col("before") + row) / RANGE).cast("int").alias("g"), F.lit(False).alias("is_query"), "vec_id", "v")
    asked = queries.where(usable).select("vec_id", "v").distinct()
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(max(ranges, 1) - 1))).alias("g"), F.lit(True).alias("is_query"),
                         "vec_id", "v")
    if not n:
        asked = asked.limit(0)
    both = docs.union(asked).repartition("g").sortWithinPartitions("g", "is_query", "vec_id")
    found = both.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(256 * x) of each component; without vectors that are null or hold null or non-finite values."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN sorts above infinity
    return embeddings.where(F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * 256)).alias("v"))


def op2(spark, sf_dir) -> DataFrame:
    v = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(v, v.where("vec_id % 50 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
      FROM (SELECT DISTINCT * FROM v) q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
      FROM s)
SELECT * FROM r WHERE rank <= 5
"""
