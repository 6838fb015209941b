"""Hard-negative mining with rotated one-bit codes.

Index: the rows of a label are dealt into blocks. A block keeps the integer vectors, and for each of ``LEVELS`` levels one
bit for each dimension: the signs of what the levels before have left over, rotated anew. With the code goes its alignment,
the inner product of the rotated vector and the unit code; the rest, which is orthogonal to the code, is the next level's
vector. The norm of the last rest is kept too.

Search: an anchor is rotated once for each level and cut into ``PLANES`` bit planes. Its inner product with a code is a
weighted popcount; alignments times these add up to an estimate of the score. What is missing is the inner product of the
last rest and the rotated anchor, at most the product of the rest's norm and the norm of the anchor's part orthogonal to the
last code (Cauchy-Schwarz), plus what rounding the anchor to planes may cost, which is known. So every row has an interval
that holds its score for sure. Rows whose interval cannot reach the result are dropped; the others get their exact integer
score. Anchors are a stated set of queries that goes over all blocks.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage, table, workers_ready

LEVELS, PLANES = 6, 8
SEED = 12
#: Rows of a block: as many as give each label some blocks, within these bounds (a block is held in memory).
LEAST, MOST = 1024, 65536
POSITIVES, NEGATIVES = 5, 10
#: Scores of negatives lie between these hundredths of the positive's score.
LOW, HIGH = 30, 90


def rotation(width: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(width, width)))[0]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    words = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    b = np.packbits(bits, axis=1)
    words[:, : b.shape[1]] = b
    return words.view(np.uint64)


@dataclass
class Codes:
    """For every vector (rows) and level: packed signs and alignment; the norm of the rest after the last level."""

    bits: np.ndarray  # levels x rows x words
    alignment: np.ndarray  # levels x rows
    rest: np.ndarray
    norm: np.ndarray


def encode(vectors: np.ndarray, turn: np.ndarray, levels: int = LEVELS) -> Codes:
    left = vectors.astype(float)
    norm = np.linalg.norm(left, axis=1)
    unit = 1 / np.sqrt(vectors.shape[1])
    bits, alignment = [], []
    for _ in range(levels):
        left = left @ turn.T
        sign = left >= 0
        c = np.abs(left).sum(axis=1) * unit
        left -= np.where(sign, unit, -unit) * c[:, None]
        bits.append(_packed(sign))
        alignment.append(c)
    return Codes(np.array(bits), np.array(alignment), np.linalg.norm(left, axis=1), norm)


def intervals(codes: Codes, anchor: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above each row's inner product with the anchor."""
    q = anchor.astype(float)
    width, size = len(q), float(np.linalg.norm(q))
    unit = 1 / np.sqrt(width)
    estimate, slack = np.zeros(len(codes.rest)), 1e-9 * codes.norm * size + 1e-6
    on_last = np.zeros(len(codes.rest))
    for bits, c in zip(codes.bits, codes.alignment):
        q = turn @ q
        low = float(q.min())
        step = max(float(q.max()) - low, 1e-300) / ((1 << PLANES) - 1)
        level = np.rint((q - low) / step).astype(np.int64)
        lost = float(np.abs(q - (low + step * level)).sum()) * unit  # of the product with any code
        planes = _packed(np.array([(level >> p) & 1 for p in range(PLANES)], bool))
        # a code's product with the levels: twice those at set bits less all of them
        at_set = np.zeros(len(c), np.int64)
        for p, plane in enumerate(planes):
            at_set += np.bitwise_count(bits & plane).sum(axis=1, dtype=np.int64) << p
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        product = (step * (2 * at_set - int(level.sum())) + low * (2 * ones - width)) * unit
        estimate += c * product
        slack += c * lost
        on_last = np.maximum(np.abs(product) - lost, 0)
    wide = codes.rest * np.sqrt(np.maximum(size * size - on_last**2, 0)) + slack
    return estimate - wide, estimate + wide


def may_be_best(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the k highest: those whose upper bound reaches the k-th highest lower bound."""
    if len(low) <= k:
        return np.ones(len(low), bool)
    return high >= np.partition(low, len(low) - k)[len(low) - k]


def may_be_negative(low: np.ndarray, high: np.ndarray, positive: int, k: int) -> np.ndarray:
    """Rows that can be among the k highest of those with a score from LOW to HIGH hundredths of the positive's."""
    least, most = LOW * positive, HIGH * positive
    may = (100 * high >= least) & (100 * low <= most)
    sure = low[(100 * low >= least) & (100 * high <= most)]
    if len(sure) >= k:
        may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
    return may


def _exact(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (vectors * anchor).sum(axis=1)


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rows, ids, -scores))[:k]


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


_BLOCK = "label long, cell long, ids binary, rows binary, vectors binary, bits binary, alignment binary, rest binary, norm binary"


def _index(width: int):
    """Rows sorted by label and cell -> one row for each block."""
    def run(batches):
        turn = rotation(width)

        def block(key, parts):
            t = pa.Table.from_batches(parts).combine_chunks()
            v = _matrix(t.column("v"), width)
            c = encode(v, turn)
            cells = [[key[0]], [key[1]]] + [[np.ascontiguousarray(x).tobytes()] for x in (
                t.column("vec_id").to_numpy(), t.column("row").to_numpy(), v, c.bits, c.alignment, c.rest, c.norm)]
            kinds = [pa.int64()] * 2 + [pa.binary()] * 7
            names = [x.split()[0] for x in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cells, kinds)], names)

        key, held = None, []
        for batch in batches:
            label, cell = batch.column("label").to_numpy(), batch.column("cell").to_numpy()
            cut = np.flatnonzero((label[1:] != label[:-1]) | (cell[1:] != cell[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(label)]):
                if a == b:
                    continue
                now = (int(label[a]), int(cell[a]))
                if held and now != key:
                    yield block(key, held)
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield block(key, held)

    return run


class Block:
    def __init__(self, row: dict, width: int):
        def read(name, kind=np.int64):
            return np.frombuffer(row[name], kind)

        self.label, self.ids, self.rows = row["label"], read("ids"), read("rows")
        n = len(self.ids)
        self.vectors = read("vectors").reshape(n, width)
        words = -(-width // 64)
        self.codes = Codes(read("bits", np.uint64).reshape(-1, n, words), read("alignment", float).reshape(-1, n),
                           read("rest", float), read("norm", float))

    def positives(self, anchor_row: int, v: np.ndarray, turn: np.ndarray, k: int):
        """(rows, ids, scores) of the k best other rows of this block, and how many were scored."""
        low, high = intervals(self.codes, v, turn)
        other = np.flatnonzero(self.rows != anchor_row)
        some = other[may_be_best(low[other], high[other], k)]
        s = _exact(self.vectors[some], v)
        top = _best(s, self.ids[some], self.rows[some], k)
        return self.rows[some][top], self.ids[some][top], s[top], len(some)

    def negatives(self, v: np.ndarray, scores: list[int], turn: np.ndarray, k: int):
        """For each positive's score: (rows, ids, scores) of the k best rows in its range; and how many were scored."""
        low, high = intervals(self.codes, v, turn)
        may = np.zeros(len(low), bool)
        for p in set(scores):
            may |= may_be_negative(low, high, p, k)
        some = np.flatnonzero(may)
        s = _exact(self.vectors[some], v)
        out = []
        for p in scores:
            fits = np.flatnonzero((LOW * p <= 100 * s) & (100 * s <= HIGH * p))
            top = fits[_best(s[fits], self.ids[some][fits], self.rows[some][fits], k)]
            out.append((self.rows[some][top], self.ids[some][top], s[top]))
        return out, len(some)


def _search(width: int, k: int, negatives: bool):
    """Sorted by key: the key's blocks, then the anchors that go over them -> (anchor, place of the positive, row, id, score).
    Positives come from blocks of the anchor's label, negatives from the others."""
    def run(batches):
        turn, blocks, key = rotation(width), [], None
        for batch in batches:
            out = [[] for _ in range(5)]

            def add(anchor, place, rows, ids, scores):
                for col, x in zip(out, (np.full(len(rows), anchor), np.full(len(rows), place), rows, ids, scores)):
                    col.append(x)

            for row in batch.to_pylist():
                if row["key"] != key:
                    key, blocks = row["key"], []
                if not row["is_anchor"]:
                    blocks.append(Block(row, width))
                    continue
                v = np.zeros(width, np.int64)
                v[: len(row["v"])] = row["v"]
                for block in blocks:
                    if negatives and block.label != row["label"]:
                        for place, found in enumerate(block.negatives(v, row["scores"], turn, k)[0]):
                            add(row["anchor"], place, *found)
                    elif not negatives and block.label == row["label"]:
                        add(row["anchor"], 0, *block.positives(row["anchor"], v, turn, k)[:3])
            if out[0]:
                cols = [np.concatenate(x).astype(np.int64) for x in out]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["anchor", "place", "row", "id", "score"])

    return run


def _over_blocks(blocks: DataFrame, anchors: DataFrame, width: int, k: int, negatives: bool) -> DataFrame:
    both = blocks.withColumn("is_anchor", F.lit(False)).unionByName(anchors.withColumn("is_anchor", F.lit(True)), True)
    both = both.repartition("key").sortWithinPartitions("key", "is_anchor")
    found = both.mapInArrow(_search(width, k, negatives), "anchor long, place long, row long, id long, score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _to_each(count: int) -> F.Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(count, 1) - 1).cast("long")))


def mine(vectors: DataFrame, anchors, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """vectors: vec_id (long), label (long), v (array<long>, not null); anchors: a condition on them -> anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    An anchor's positives are the ``positives`` highest scoring other rows of its label. For each of them the ``negatives``
    highest rows of other labels with 30 * positive_score <= 100 * negative_score <= 90 * positive_score are returned, so
    none where the positive's score is negative. Ties go to the smaller vec_id. Rows with a null id or label take no part.
    Every row counts for itself, also where rows are equal or share an id. Shorter vectors score as if filled up with
    zeros. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    workers_ready(spark)
    rows = vectors.where("vec_id is not null and label is not null").select(
        "vec_id", F.col("label").cast("long").alias("label"), "v", F.monotonically_increasing_id().alias("row"))
    rows = stage(rows, "vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).head()
    if not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    width = max(width, 1)
    size = min(max(n // 256, LEAST), MOST)
    cells = stage(rows.groupBy("label").agg(F.ceil(F.count("*") / size).cast("long").alias("cells")), "labels")
    small = broadcast_if_small(cells)
    dealt = rows.join(small, "label").withColumn("cell", F.pmod(F.xxhash64("row"), "cells"))
    blocks = dealt.select("label", "cell", "vec_id", "row", "v").repartition("label", "cell").sortWithinPartitions("label", "cell")
    blocks = stage(blocks.mapInArrow(_index(width), _BLOCK), "index")
    asked = stage(rows.where(anchors).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v"), "anchors")

    own = asked.join(small, "label").select("anchor", "label", "v", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
    named = F.xxhash64("label", "cell")
    near = _over_blocks(blocks.withColumn("key", named), own.withColumn("key", named).drop("cell"), width, positives, False)
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))  # a few each
    near = stage(near, "positives").select("anchor", "p", F.col("p.score").alias("scores"))

    # as many keys as blocks, so one or a few blocks a key; every anchor goes to every key
    count = blocks.count()
    asked = asked.join(near, "anchor")
    far = _over_blocks(blocks.withColumn("key", F.pmod(named, F.lit(count))),
                       asked.select("anchor", "label", "v", "scores", _to_each(count).alias("key")), width, negatives, True)
    out = far.join(asked.select("anchor", "anchor_id", "p"), "anchor")
    p = F.element_at("p", (F.col("place") + 1).cast("int"))
    return out.select("anchor_id", p["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                      p["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def relabelled(embeddings: DataFrame, every: int = 7, classes: int = 10) -> DataFrame:
    """vec_id, label, v (floor(256 * x)); where vec_id is divisible by ``every``, the label is the next one of ``classes``."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % every == 0, (label + 1) % classes).otherwise(label)
    labels = embeddings.where("label is not null").withColumn("__label", moved)
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return labels.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("__label").alias("label"), F.transform(x, lambda c: F.floor(c * 256)).alias("v"))


def op12(spark, sf_dir) -> DataFrame:
    return mine(relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
             list_sum(list_transform(list_zip(a.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM e a JOIN e d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
      WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
