"""Removal of repeated word windows behind a count-min prefilter.

A window is ``WORDS`` consecutive words. Its identity is 128 bits of hash of its words, of which the sketch uses 64.

1. Documents are dealt into blocks of about ``BLOCK`` bytes, in the order they are read, and staged with their block.
2. Each task builds a sketch of its block: in each of ``DEPTH`` rows of counters every window adds one to a counter. The
   counters that are not zero travel, as gaps between their places, cut into slices of the sketch; a slice adds up what all
   blocks sent. A counter of two or more may be a repeated window, so a window whose counters all reach two is estimated
   repeated. Counts are never too small, so none is lost. The sketch has ``SPARE`` counters a row for each window that the
   texts can hold, and is never whole in one place: a slice answers each block with those of its own counters that repeat.
3. With the answers, each block finds its windows estimated repeated and sends those, once each, with the smallest doc_id
   that holds them in the block. They are grouped exactly, in parts by hash; each block is told, by one bit for each window
   it sent, whether another block has a smaller doc_id.
4. A window goes where a smaller doc_id holds it; the words it covers are removed.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_group, runs, stage, table, workers_ready

WORDS = 13
DEPTH = 2
#: Counters of a row for each window; a word and its space are taken to have 6 bytes.
SPARE, WORD_BYTES = 4, 6
#: Bytes of text of a block: a share of all, within these bounds.
BLOCK = (4 << 20, 64 << 20)
BLOCKS = 4096
#: Bits of a slice's counters, within these bounds, so that there are about 512 slices.
SLICE = (18, 26)
PIECE = 1 << 20

_rng = np.random.default_rng(11)
_BYTES = _rng.integers(1, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_PLACE = _rng.integers(1, 1 << 63, (2, WORDS), np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
del _rng


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(kind: int) -> tuple[np.ndarray, np.ndarray]:
    low, high, step = [1], [1], pow(_BASE[kind], 1 << 12, 1 << 64)
    for _ in range((1 << 12) - 1):
        low.append(low[-1] * _BASE[kind] % (1 << 64))
        high.append(high[-1] * step % (1 << 64))
    return np.array(low, np.uint64), np.array(high, np.uint64)


_POWERS = [_powers(0), _powers(1)]


def word_bounds(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last byte of each word of texts that stand one behind the other (``starts``: their first bytes)."""
    inside = np.zeros(len(text) + 2, bool)
    np.logical_not(_SPACE[text], out=inside[1:-1])
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    at = starts[starts < len(text)]
    first[at] |= inside[at + 1]
    at = at[at > 0] - 1
    last[at] |= inside[at + 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(text: np.ndarray, a: np.ndarray, b: np.ndarray, kind: int = 0) -> np.ndarray:
    """A 64-bit hash of each word text[a:b], a polynomial over its bytes; a few words at a time."""
    out = np.zeros(len(a), np.uint64)
    low, high = _POWERS[kind]
    value = _BYTES[kind]
    long = np.append(np.flatnonzero(b - a > PIECE), len(a))
    k = 0
    while k < len(a):
        e = min(int(np.searchsorted(a, a[k] + PIECE)), int(long[np.searchsorted(long, k)]))
        e = max(k + 1, e)
        s, size = a[k:e], b[k:e] - a[k:e]
        if size[0] > PIECE:  # a very long word, in pieces
            total = 0
            for x in range(int(s[0]), int(b[k]), PIECE):
                piece = text[x : min(x + PIECE, int(b[k]))]
                i = np.arange(x - int(s[0]), x - int(s[0]) + len(piece))
                far = pow(_BASE[kind], 1 << 24, 1 << 64)
                p = low[i & 4095] * high[(i >> 12) & 4095] * np.array([pow(far, int(j), 1 << 64) for j in np.unique(i >> 24)], np.uint64)[
                    (i >> 24) - (i[0] >> 24)]
                total = (total + int((value[piece] * p).sum(dtype=np.uint64))) % (1 << 64)
            out[k] = total
        else:
            lead = np.cumsum(size) - size
            i = np.arange(int(size.sum())) - np.repeat(lead, size)
            p = low[i] if size.max() <= 4096 else low[i & 4095] * high[i >> 12]
            out[k:e] = np.add.reduceat(value[text[i + np.repeat(s, size)]] * p, lead)
        k = e
    return _mixed(out + (b - a).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def window_hashes(words: np.ndarray, doc: np.ndarray, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of each window that lies in one document; ``doc`` is each word's document."""
    n = len(words) - WORDS + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[WORDS - 1 :])
    h = np.zeros(n, np.uint64)
    for k in range(WORDS):
        h += words[k : n + k] * _PLACE[kind][k]
    return _mixed(h[at]), at


class Texts:
    """Words and windows of some documents, given as a binary column."""

    def __init__(self, column: pa.Array):
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
        data = column.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.text = whole[offsets[0] : offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        self.a, self.b = word_bounds(self.text, starts)
        self.doc = np.searchsorted(starts, self.a, side="right") - 1  # of equal starts the last: the others are empty
        self.h, self.at = window_hashes(word_hashes(self.text, self.a, self.b), self.doc)

    def second(self) -> np.ndarray:
        return window_hashes(word_hashes(self.text, self.a, self.b, 1), self.doc, 1)[0]


class Sketch:
    """Where windows are counted: the rows' length in bits, and the slices'."""

    def __init__(self, n_bytes: int):
        self.bits = max(SLICE[0], int(n_bytes // WORD_BYTES * SPARE).bit_length())
        self.slice_bits = min(max(self.bits - 9, SLICE[0]), SLICE[1])
        self.slices = 1 << (self.bits - self.slice_bits)

    def places(self, h: np.ndarray, row: int) -> np.ndarray:
        """The counter of each window in a row of counters."""
        return (_mixed(h + np.uint64(row * 0x632BE59BD9B4E019 + 1)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def part(self, h: np.ndarray) -> np.ndarray:
        """The part in which a window is grouped exactly."""
        return (h >> np.uint64(64 - (self.bits - self.slice_bits))).astype(np.int64) if self.slices > 1 else np.zeros(len(h), np.int64)


def packed_gaps(places: np.ndarray) -> bytes:
    """Sorted places as gaps: their low bytes, then their high bytes; a gap of 65,535 or more follows as 8 bytes."""
    gap = np.diff(places, prepend=0)
    wide = gap >= 0xFFFF
    small = np.where(wide, 0xFFFF, gap).astype(np.uint16)
    return b"".join([len(gap).to_bytes(4, "little"), (small & 255).astype(np.uint8).tobytes(), (small >> 8).astype(np.uint8).tobytes(),
                     gap[wide].astype(np.int64).tobytes()])


def unpacked_gaps(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    b = np.frombuffer(data, np.uint8, offset=4)
    gap = b[:n].astype(np.int64) | (b[n : 2 * n].astype(np.int64) << 8)
    wide = gap == 0xFFFF
    if wide.any():
        gap[wide] = np.frombuffer(data[4 + 2 * n :], np.int64)
    return np.cumsum(gap)


_SLICED = "key long, block long, data binary"


def _sliced(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.binary())], ["key", "block", "data"])


def _dealt(limit: int):
    """Numbers documents by blocks of about ``limit`` bytes."""
    def run(batches):
        first, n, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            lengths = [0 if t is None else t for t in batch.column("n").to_pylist()]
            block = []
            for k in lengths:
                if size + k > limit and size:
                    n, size = n + 1, 0
                size += k
                block.append(first + n)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), batch.column("doc_id"), batch.column("bin")],
                                             ["block", "doc_id", "bin"])

    return run


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a few megabytes of text, or one document, each."""
    col = batch.column(column)
    ends = np.cumsum(np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4)[1:]
                     - np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4)[:-1], dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + 4 * PIECE, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _counted(sketch: Sketch):
    """Documents sorted by block -> the block's counters, a row for each slice."""
    def rows(block: int, held: list[np.ndarray]):
        h = np.concatenate(held)
        out = []
        for row in range(DEPTH):
            p = np.sort(sketch.places(h, row))
            p = p[np.append([True, True], p[2:] != p[:-2])[: len(p)]]  # two of a kind say all
            s = p >> sketch.slice_bits
            cut = runs(s)
            for x, y in zip(cut[:-1], cut[1:]):
                out.append((row * sketch.slices + int(s[x]), block, packed_gaps(p[x:y] - (int(s[x]) << sketch.slice_bits))))
        return out

    def run(batches):
        block, held, n = None, [], 0
        for batch in batches:
            names = batch.column("block").to_numpy()
            cut = runs(names)
            for x, y in zip(cut[:-1], cut[1:]):
                if held and (names[x] != block or n > 1 << 22):
                    yield _sliced(rows(block, held))
                    held, n = [], 0
                block = int(names[x])
                for piece in _pieces(batch.slice(x, y - x), "bin"):
                    h = Texts(piece.column("bin")).h
                    if len(h):
                        held.append(h)
                        n += len(h)
        if held:
            yield _sliced(rows(block, held))

    return run


def _answered(sketch: Sketch):
    """Counters of all blocks sorted by slice -> for each block, its own counters that reach two."""
    def run(batches):
        for t in by_group(batches, ["key"], 256):
            key = t.column("key").to_numpy()
            block = t.column("block").to_pylist()
            cut = runs(key)
            for x, y in zip(cut[:-1], cut[1:]):
                own = [unpacked_gaps(d) for d in t.column("data").slice(x, y - x).to_pylist()]
                ends = np.cumsum([len(p) for p in own])
                places = np.concatenate(own)
                often = np.bincount(places, minlength=1 << sketch.slice_bits) >= 2
                once = np.append(True, places[1:] != places[:-1])  # the second of two says no more
                once[ends[:-1]] = True
                at = np.flatnonzero(often[places] & once)
                bounds = np.searchsorted(at, np.append(0, ends))
                out = [(int(key[x]), block[x + k], packed_gaps(places[at[p:q]]))
                       for k, (p, q) in enumerate(zip(bounds[:-1], bounds[1:])) if p < q]
                if out:
                    yield _sliced(out)

    return run


class Repeated:
    """A block's counters that repeat: bits by the low part of the place, then exact."""

    def __init__(self, sketch: Sketch, answers: list[tuple[int, bytes]]):
        self.sketch, self.rows = sketch, []
        for row in range(DEPTH):
            own = [unpacked_gaps(d) + ((k % sketch.slices) << sketch.slice_bits) for k, d in answers if k // sketch.slices == row]
            p = np.unique(np.concatenate(own)) if own else np.empty(0, np.int64)
            bits = max(10, (8 * len(p)).bit_length())
            mask = np.zeros(1 << bits, bool)
            mask[p & ((1 << bits) - 1)] = True
            self.rows.append((p, mask, (1 << bits) - 1))

    def among(self, h: np.ndarray) -> np.ndarray:
        """Places of the windows estimated repeated."""
        at = np.arange(len(h))
        for row, (p, mask, low) in enumerate(self.rows):
            if not len(p):
                return at[:0]
            own = self.sketch.places(h[at], row)
            may = np.flatnonzero(mask[own & low])
            at, own = at[may], own[may]
            found = np.searchsorted(p, own)
            at = at[(found < len(p)) & (p[np.minimum(found, len(p) - 1)] == own)]
        return at


class Block:
    """The windows of a block's documents that are estimated repeated: hashes, document, first word."""

    def __init__(self, repeated: Repeated):
        self.repeated, self.parts, self.texts, self.docs = repeated, [], [], 0

    def add(self, piece: pa.RecordBatch, keep: bool = False) -> None:
        t = Texts(piece.column("bin"))
        ids = piece.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        at = self.repeated.among(t.h)
        at = at[known[t.doc[t.at[at]]]]  # no doc_id is smaller than a null one, nor greater
        if len(at):
            doc = t.doc[t.at[at]]
            self.parts.append((t.h[at], t.second()[at], ids.fill_null(0).to_numpy()[doc], doc + self.docs, t.at[at]))
        if keep:
            self.texts.append((self.docs, piece, t.a, t.b, t.doc))
        self.docs += piece.num_rows

    def windows(self) -> tuple[np.ndarray, ...]:
        """(h, h2, doc_id, document, first word) sorted by hash and doc_id, and which are the first of a hash."""
        if not self.parts:
            e = np.empty(0, np.int64)
            return e.astype(np.uint64), e.astype(np.uint64), e, e, e, e.astype(bool)
        h, h2, ids, doc, at = (np.concatenate(c) for c in zip(*self.parts))
        o = np.lexsort((ids, h2, h))
        h, h2, ids, doc, at = h[o], h2[o], ids[o], doc[o], at[o]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
        return h, h2, ids, doc, at, first


def _sent(sketch: Sketch, block: int, b: Block) -> list[tuple[int, int, bytes]]:
    """A block's distinct windows with the smallest doc_id that holds them, by parts."""
    h, h2, ids, _, _, first = b.windows()
    h, h2, ids = h[first], h2[first], ids[first]
    part = sketch.part(h)
    cut = runs(part)
    return [(int(part[x]), block, h[x:y].tobytes() + h2[x:y].tobytes() + ids[x:y].tobytes()) for x, y in zip(cut[:-1], cut[1:])]


#: What comes first in a block.
ANSWER, FOREIGN, DOCUMENT = 0, 1, 2


def _blocks(batches, sketch: Sketch, flush, keep: bool):
    """Runs over rows sorted by block and kind: answers, then what ``flush`` needs, then documents."""
    now, answers, foreign, block = None, [], [], None

    def done():
        return flush(now, block or Block(Repeated(sketch, answers)), foreign)

    for batch in batches:
        name, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        cut = runs(name, kind)
        for x, y in zip(cut[:-1], cut[1:]):
            if name[x] != now:
                if now is not None:
                    yield from done()
                now, answers, foreign, block = int(name[x]), [], [], None
            part = batch.slice(x, y - x)
            if kind[x] != DOCUMENT:
                (answers if kind[x] == ANSWER else foreign).extend(zip(part.column("key").to_pylist(), part.column("data").to_pylist()))
                continue
            if block is None:
                block = Block(Repeated(sketch, answers))
                answers = []
            for piece in _pieces(part, "bin"):
                block.add(piece, keep)
    if now is not None:
        yield from done()


def _found(sketch: Sketch):
    """Answers and documents -> the windows estimated repeated, by parts."""
    def run(batches):
        for rows in _blocks(batches, sketch, lambda name, b, _: [_sent(sketch, name, b)], False):
            if rows:
                yield _sliced(rows)

    return run


def _grouped(batches):
    """Windows of all blocks sorted by part -> for each block and part, a bit for each window it sent: another block has a
    smaller doc_id."""
    for t in by_group(batches, ["key"], 64):
        key = t.column("key").to_numpy()
        cut = runs(key)
        for x, y in zip(cut[:-1], cut[1:]):
            data = [np.frombuffer(d, np.uint64).reshape(3, -1) for d in t.column("data").slice(x, y - x).to_pylist()]
            h, h2, ids = np.concatenate(data, axis=1)
            ids = ids.view(np.int64)
            o = np.lexsort((ids, h2, h))
            s, s2 = h[o], h2[o]
            first = np.ones(len(o), bool)
            first[1:] = (s[1:] != s[:-1]) | (s2[1:] != s2[:-1])
            least = ids[o][np.maximum.accumulate(np.where(first, np.arange(len(o)), 0))]
            smaller = np.zeros(len(o), bool)
            smaller[o] = least < ids[o]
            ends = np.cumsum([d.shape[1] for d in data])
            out = []
            for block, a, b in zip(t.column("block").slice(x, y - x).to_pylist(), np.append(0, ends[:-1]), ends):
                if smaller[a:b].any():
                    out.append((int(key[x]), block, np.packbits(smaller[a:b]).tobytes()))
            if out:
                yield _sliced(out)


_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _cut(sketch: Sketch):
    """Answers, bits and documents -> documents without the words of windows that a smaller doc_id holds."""
    def flush(name, b: Block, foreign):
        h, _, ids, doc, at, first = b.windows()
        gone = np.zeros(len(h), bool)
        if len(h):
            start = np.flatnonzero(first)
            part = sketch.part(h[start])
            smaller = np.zeros(len(start), bool)
            for key, bits in foreign:
                x, y = np.searchsorted(part, [key, key + 1])
                smaller[x:y] = np.unpackbits(np.frombuffer(bits, np.uint8), count=y - x).astype(bool)
            group = np.cumsum(first) - 1
            gone = smaller[group] | (ids > ids[start][group])
        doc, at = doc[gone], at[gone]
        o = np.argsort(doc, kind="stable")
        doc, at = doc[o], at[o]
        for base, piece, a, e, of in b.texts:
            x, y = np.searchsorted(doc, [base, base + piece.num_rows])
            covered = np.zeros(len(a) + 1, np.int32)
            np.add.at(covered, at[x:y], 1)
            np.add.at(covered, at[x:y] + WORDS, -1)
            yield _documents(piece, a, e, of, np.cumsum(covered[:-1]) > 0)

    def run(batches):
        yield from _blocks(batches, sketch, flush, True)

    return run


def _documents(piece: pa.RecordBatch, a: np.ndarray, e: np.ndarray, of: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    kept, spans, counts = [], [], []
    cut = np.searchsorted(of, np.arange(piece.num_rows + 1))
    for k, t in enumerate(piece.column("bin")):
        x, y = cut[k], cut[k + 1]
        words, out = (t.as_py() or b"").split(), gone[x:y]
        edge = np.flatnonzero(np.diff(out, prepend=False, append=False))
        found = [{"a": p, "b": q} for p, q in zip(edge[::2].tolist(), edge[1::2].tolist())]
        if found:
            words = [w for w, g in zip(words, out.tolist()) if not g]
        kept.append(b" ".join(words))
        spans.append(found)
        counts.append(int(y - x))
    return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()),
                                       pa.array(spans, _SPANS)], ["doc_id", "n_words", "kept", "spans"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, kept (the words left, joined by one space, as UTF-8), spans (removed ranges a, b of words): every word
    covered by a window whose words also stand in a document with a smaller doc_id is removed.

    Null texts have no words; texts under 13 words and windows that repeat in one document only stay. Rows may be equal or
    share a doc_id: none of them is smaller than the other, so they remove nothing from each other. Rows with a null doc_id
    keep all words and remove none. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    workers_ready(spark)
    bin_ = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), bin_.alias("bin"), F.octet_length(bin_).alias("n"))
    total = source.agg(F.sum("n")).head()[0] or 0
    sketch = Sketch(total)
    limit = min(max(total // BLOCKS, BLOCK[0]), BLOCK[1])
    source = stage(source.mapInArrow(_dealt(limit), "block long, doc_id long, bin binary"), "blocks")

    counters = source.mapInArrow(_counted(sketch), _SLICED).repartition("key").sortWithinPartitions("key")
    answers = stage(counters.mapInArrow(_answered(sketch), _SLICED), "answers").withColumn("kind", F.lit(ANSWER))
    documents = source.withColumn("kind", F.lit(DOCUMENT))

    def by_block(*parts: DataFrame) -> DataFrame:
        both = documents
        for p in parts:
            both = both.unionByName(p, True)
        return both.repartition("block").sortWithinPartitions("block", "kind")

    found = by_block(answers).mapInArrow(_found(sketch), _SLICED)
    grouped = found.repartition("key").sortWithinPartitions("key").mapInArrow(_grouped, _SLICED)
    foreign = stage(grouped, "foreign").withColumn("kind", F.lit(FOREIGN))
    return by_block(answers, foreign).mapInArrow(
        _cut(sketch), "doc_id long, n_words long, kept binary, spans array<struct<a:int,b:int>>")


def op11(spark, sf_dir) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, i, words[i : i + 12] AS s FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM d)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
         FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE least < doc_id),
one AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""
