"""MinHash near-duplicate detection with sequential Bayesian verification.

1. Each text becomes its set of distinct five-word shingles (64-bit hashes), a MinHash signature and band keys. Equal
   sets are one node from here on, so a group of exact copies costs one row.
2. Sets that share a band key form a bucket. In the first round each set is compared with one pivot of its bucket
   only, so a large group of near copies gives as many pairs as it has members.
3. Signatures are compared batch by batch. After each batch a pair is pruned if the posterior probability that its
   similarity reaches the threshold (uniform prior, binomial matches) is below ``miss``.
4. Survivors are verified on their full sets, taken from the texts.
5. Links give components. Buckets that still hold several components get more rounds over pairs of *different*
   components. First, while that brings links, each set proposes its likeliest partner in one of its buckets (another
   one in each round), so a round has no more pairs than sets. Then every pair that the Bayesian test leaves is verified
   where its bucket is, in the first band it shares, and only links leave that place. Large buckets are cut into chunks,
   and each pair of chunks is a group of its own.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_group, components, runs, stage, workers_ready

WORDS, HASHES, ROWS, BATCH = 5, 128, 4, 16
BANDS = HASHES // ROWS
THRESHOLD = 0.75
#: Chosen probability of pruning a pair that reaches the threshold, at each batch.
MISS = 1e-6
#: Rounds of proposals at most, before all pairs that are left.
PROPOSALS = 2
#: Members of a bucket that one group compares with each other.
CHUNK = 512

_M64 = (1 << 64) - 1


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_A = _odd(HASHES, 11)[:, None]
_C = _odd(WORDS, 12)
_B = _odd(ROWS + 1, 13)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hash of each word met; forgets all when it holds a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, known: _WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; ``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n < WORDS:
        total = np.uint64((n * 0x9E3779B97F4A7C15) & _M64)
        return _mix((h * _C[:n]).sum(keepdims=True) + total)
    acc = h[: n - WORDS + 1] * _C[0]
    for k in range(1, WORDS):
        acc += h[k : n - WORDS + 1 + k] * _C[k]
    return np.unique(_mix(acc))


def signature(s: np.ndarray) -> np.ndarray:
    low = None
    for at in range(0, len(s), 1024):
        m = (s[None, at : at + 1024] * _A).min(axis=1)
        low = m if low is None else np.minimum(low, m)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    r = sig.reshape(BANDS, ROWS).astype(np.uint64)
    return _mix((r * _B[:ROWS]).sum(axis=1) + np.arange(1, BANDS + 1, dtype=np.uint64) * _B[ROWS]).view(np.int64)


def _sketch(batches):
    known = _WordHashes()
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("bin")
        n, sid, sig, bands = [], [], [], []
        for t in texts:
            s = shingle_set(t.as_py(), known)
            n.append(len(s))
            if len(s):
                m = signature(s)
                sid.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                sig.append(m.tobytes())
                bands.append(band_keys(m))
            else:
                sid.append(None)
                sig.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(sig, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n", "sid", "sig", "bands"])


def least_matches(miss: float = MISS, threshold: float = THRESHOLD) -> list[int]:
    """For n = BATCH, 2 * BATCH, ...: the fewest matches among n hashes for which P(similarity >= threshold) >= miss
    under a uniform prior. With whole numbers that tail is a binomial sum."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = 0
        while sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1)) < miss:
            m += 1
        out.append(m)
    return out


def survivors(x: np.ndarray, y: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers at which signatures x and y (rows) stay likely to be similar, and their matches over all hashes."""
    live, hits = np.arange(len(x)), np.zeros(len(x), np.int32)
    for k, m in enumerate(least):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        hits[live] += (x[live, cols] == y[live, cols]).sum(axis=1, dtype=np.int32)
        live = live[hits[live] >= m]
        if not len(live):
            break
    return live, hits[live]


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _prune(least):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                live, _ = survivors(_matrix(batch.column("sx")), _matrix(batch.column("sy")), least)
                yield batch.select(["x", "y"]).take(pa.array(live))

    return run


class _Cell:
    """Members of a bucket, or of two of its chunks, as columns."""

    def __init__(self, t: pa.Table, least: list[int]):
        self.sid, self.comp, self.n, self.chunk = (t.column(c).to_numpy() for c in ("sid", "comp", "n", "chunk"))
        self.comp = self.comp.copy()  # links found here are entered
        self.sig, self.least = _matrix(t.column("sig")), least
        self.band, self.two = t.column("band")[0].as_py(), t.column("i")[0] != t.column("j")[0]

    def near(self, r: int, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of other components (and the other chunk) among ``ok`` that may be similar to member r, and matches."""
        z = self.n
        ok = ok & (self.comp != self.comp[r]) & (4 * z >= 3 * z[r]) & (3 * z <= 4 * z[r])
        if self.two:
            ok &= self.chunk != self.chunk[r]
        q = np.flatnonzero(ok)
        live, hits = survivors(np.broadcast_to(self.sig[r], (len(q), HASHES)), self.sig[q], self.least)
        return q[live], hits

    def first_met(self, r: int) -> np.ndarray:
        """Those before member r that may be similar to it and share no earlier band with it."""
        q, _ = self.near(r, np.arange(len(self.sid)) < r)
        if len(q) and self.band:
            upto = ROWS * self.band
            same = (self.sig[q, :upto] == self.sig[r, :upto]).reshape(len(q), self.band, ROWS).all(axis=2)
            q = q[~same.any(axis=1)]
        return q


def _cells(batches, least, rows):
    for t in by_group(batches, ["key", "i", "j"], rows):
        at = runs(*(t.column(c).to_numpy() for c in ("key", "i", "j")))
        comp = t.column("comp").to_numpy()
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if (comp[a:b] != comp[a]).any():
                part = t.slice(a, b - a)
                yield part, _Cell(part, least)


def _link_rows(x, y):
    x, y = np.array(x, np.int64), np.array(y, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["x", "y"])


def _proposals(least):
    """x, y: each set whose home this cell is, and its likeliest partner."""

    def run(batches):
        for part, cell in _cells(batches, least, 2000):
            x, y = [], []
            for r in np.flatnonzero(part.column("home").to_numpy()):
                q, hits = cell.near(r, np.ones(len(cell.sid), bool))
                if len(q):
                    x.append(cell.sid[r])
                    y.append(cell.sid[q[hits.argmax()]])
            if x:
                yield _link_rows(x, y)

    return run


def _suspects(least):
    """Rows of the cells' members that may be similar to another one of the cell."""

    def run(batches):
        for part, cell in _cells(batches, least, 2000):
            some = np.zeros(len(cell.sid), bool)
            for r in range(len(some)):
                q = cell.first_met(r)
                some[q] = True
                some[r] |= len(q) > 0
            if some.any():
                yield from part.filter(pa.array(some)).combine_chunks().to_batches()

    return run


def _links_in_cells(least):
    """x, y: links between components, verified on the full sets."""

    def run(batches):
        known = _WordHashes()
        for part, cell in _cells(batches, least, 1):
            sets = [shingle_set(t.as_py(), known) for t in part.column("bin")]
            x, y = [], []
            for r in range(len(sets)):
                for q in cell.first_met(r):
                    if cell.comp[q] != cell.comp[r] and _similar(sets[r], sets[q]):
                        x.append(cell.sid[r])
                        y.append(cell.sid[q])
                        cell.comp[cell.comp == cell.comp[q]] = cell.comp[r]
            if x:
                yield _link_rows(x, y)

    return run


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _confirm(batches):
    known, last, set_x = _WordHashes(), None, None
    for batch in batches:
        keep = []
        for r, (x, tx, ty) in enumerate(zip(*(batch.column(c) for c in ("x", "tx", "ty")))):
            if x.as_py() != last:
                last, set_x = x.as_py(), shingle_set(tx.as_py(), known)
            if _similar(set_x, shingle_set(ty.as_py(), known)):
                keep.append(r)
        yield batch.select(["x", "y"]).take(pa.array(keep, pa.int64()))


def _own_set(batches):
    """Keeps a text if it has the set it is looked up for (rows with one doc_id may have different texts)."""
    known = _WordHashes()
    for batch in batches:
        keep = [r for r, (s, t) in enumerate(zip(batch.column("sid"), batch.column("bin")))
                if xxhash.xxh3_64_intdigest(shingle_set(t.as_py(), known).tobytes()) - (1 << 63) == s.as_py()]
        yield batch.take(pa.array(keep, pa.int64()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", miss: float = MISS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable over links of similarity
    0.75 or more), kept (doc_id = component_id).

    Null or empty texts have no shingles, link with nothing and are their own component. Rows with a null doc_id
    take no part in links: component_id null, kept false. Rows that repeat a doc_id are one document for the links.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    workers_ready(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("bin"))
    sketch = stage(source.mapInArrow(
        _sketch, "doc_id long, n long, sid long, sig binary, bands array<long>"), "sketch")
    usable = sketch.where("doc_id is not null and sid is not null")
    reps = stage(usable.groupBy("sid").agg(F.min("doc_id").alias("rid"), F.first("n").alias("n"),
                                           F.first("sig").alias("sig"), F.first("bands").alias("bands")), "reps")
    banded = reps.select("sid", F.posexplode("bands").alias("band", "key"))
    keys = banded.groupBy("key").agg(F.min("sid").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    buckets = stage(banded.join(stage(keys, "keys"), "key"), "buckets")
    texts = source.join(buckets.select("sid").distinct().join(reps, "sid").select("sid", F.col("rid").alias("doc_id")),
                        "doc_id").select("sid", "bin").mapInArrow(_own_set, "sid long, bin binary")
    texts = stage(texts.dropDuplicates(["sid"]), "texts")
    least = least_matches(miss)

    def confirmed(pairs: DataFrame) -> DataFrame:
        y = texts.select(F.col("sid").alias("y"), F.col("bin").alias("ty"))
        x = texts.select(F.col("sid").alias("x"), F.col("bin").alias("tx"))
        return pairs.join(y, "y").join(x, "x").mapInArrow(_confirm, "x long, y long")

    sigs = reps.select("sid", "sig")
    pairs = buckets.where("sid <> pivot").select(F.col("pivot").alias("x"), F.col("sid").alias("y")).distinct()
    pruned = pairs.join(sigs.toDF("y", "sy"), "y").join(sigs.toDF("x", "sx"), "x").mapInArrow(
        _prune(least), "x long, y long")
    tested = stage(pruned, "pairs")
    links = stage(confirmed(tested), "links")
    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "sid")

    added, rounds = links, 0
    while True:
        propose = rounds < PROPOSALS and not added.isEmpty()
        label = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))
        left = buckets.select("key", "band", "sid", "size").join(
            label.select(F.col("node").alias("sid"), "component"), "sid", "left")
        left = left.withColumn("comp", F.coalesce("component", "sid")).drop("component")
        mixed = left.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        left = left.join(stage(mixed.select("key"), "mixed"), "key")
        if propose:
            home = left.groupBy("sid").agg(F.max(F.struct(F.xxhash64("key", F.lit(rounds)), "key")).alias("h"))
            left = left.join(home.select("sid", F.col("h.key").alias("home")), "sid")
            left = left.withColumn("home", F.col("home") == F.col("key"))
        else:
            left = left.withColumn("home", F.lit(True))
        k = F.ceil(F.col("size") / CHUNK).cast("int")
        left = left.withColumn("k", k).withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("k")).cast("int"))
        cell = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda o: F.struct(
            F.least("chunk", o).alias("i"), F.greatest("chunk", o).alias("j"))))
        left = left.select("*", cell.alias("c")).select("key", "band", "sid", "comp", "home", "chunk", "c.*")
        left = left.join(reps.select("sid", "n", "sig"), "sid")
        if not propose:
            break
        more = dealt(left).mapInArrow(_proposals(least), "x long, y long").distinct()
        more = stage(more.join(tested, ["x", "y"], "left_anti"), "pairs")
        added = stage(confirmed(more), "links")
        tested, links, rounds = tested.union(more), links.union(added), rounds + 1
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema.fields)
    suspects = stage(dealt(left).mapInArrow(_suspects(least), kind), "suspects")
    last = dealt(suspects.join(texts, "sid")).mapInArrow(_links_in_cells(least), "x long, y long")
    links = links.union(stage(last.distinct(), "links"))
    node = usable.select("doc_id", "sid").join(reps.select("sid", "rid"), "sid")
    rid = reps.select("sid", "rid")
    far = links.join(rid.toDF("x", "u"), "x").join(rid.toDF("y", "v"), "y").select("u", "v")
    near = node.where("doc_id <> rid").select(F.col("doc_id").alias("u"), F.col("rid").alias("v"))
    label = components(far.union(near)).select(F.col("node").alias("doc_id"), "component")
    out = sketch.select("doc_id", F.col("n").alias("n_shingles")).join(label, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op7(spark, sf_dir) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents"))
