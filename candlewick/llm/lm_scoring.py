"""LM scoring by online logistic context mixing over a binary code of the tokens.

Tokens are words and one end per text. The ``CODEBOOK`` most frequent ones of the training texts and an escape have a
Huffman code; each bit of it is one binary decision at a node of the code tree. Decisions are predicted by

* the node alone (counts of all training tokens),
* the node under the previous token, and under the previous two, hashed into tables of ``SLOTS`` counters,
* the node within this text so far, starting from the first prediction.

The stretched predictions are added with weights that a gate selects (the decision's depth in the code, and whether the
text has met the node), squashed, and refined by an adaptive map from (gate, prediction) to a corrected probability.
Weights and map are learnt twice. All training texts together give the start, a Newton step of the weights and a map, from
sums of one pass in which no predictor counts the text it predicts; the map is the one under the weights before the step.
From that start they learn online over each text, block by block of ``FIRST`` tokens at first and up to ``BLOCK`` later; in a block all decisions see the state before
the block. Every text starts from the same state, so scores do not depend on partitions. Texts of a task are worked out
side by side, the first blocks of all, then the second, each with a state of its own.

A token outside the codebook costs its escape and its spelling: bits of its bytes and an end mark, predicted under one,
two and three previous bytes from counters learnt on the distinct training words outside the codebook, and mixed with
fixed weights. Spellings are scored once for each distinct word, as a table, and joined.

Counts are made over all training texts and grow with them; counter tables and codebook have fixed sizes.
"""
from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import stage, table, workers_ready

CODEBOOK, SLOTS = 1 << 16, 1 << 18
#: Tokens of a text's first block, and of a block at most.
FIRST, BLOCK = 16, 512
#: Tokens whose decisions are worked out at once, of one or many texts.
PIECE = 64 * BLOCK
#: Bytes of text, distinct words, and words to be spelled that a task holds at once.
SLICE, WORDS, SPELLED = 2 << 20, 800_000, 100_000
#: Counters of a table that travel in one row.
CHUNK = 1 << 13
END = b""
RATE, MAP_RATE, CELLS = 0.02, 0.02, 24
#: Curvature added to a gate's own when its first weights are learnt.
CAUTION = 4.0
#: Fixed weights of the spelling predictors (one, two, three previous bytes).
SPELLING = (0.2, 0.4, 0.5)
_LIMIT = 8.0


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _slices(batches, column: str):
    """Parts of the batches with about ``SLICE`` bytes in a column."""
    for batch in batches:
        rows = max(1, SLICE * batch.num_rows // (batch.column(column).nbytes + 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _release() -> None:
    """Give Arrow's unused memory back, as workers serve many tasks."""
    pa.default_memory_pool().release_unused()


def _held_out(part: pa.RecordBatch) -> np.ndarray:
    return np.array([held_out(i) for i in part.column("doc_id").to_pylist()], bool)


def _parts(values: pa.Array, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all binary values, one after the other, as numbers of ``width`` bytes; how many each value has). No nulls."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    flat = np.frombuffer(values.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return flat.view(f"u{width}"), np.diff(ends) // width


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(lower-cased words of all texts, one text after the other, number of words of each text)"""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = split.flatten().view(pa.binary())
    size = split.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # blanks at either end leave an empty word
    if not some.all():
        upto, ends = np.append(0, np.cumsum(some)), np.cumsum(size)
        words, size = words.filter(pa.array(some)), upto[ends] - upto[ends - size]
    return words, size


# --- counts ---------------------------------------------------------------------------------------------------------


def _count(batches):
    held, n = [], 0

    def added():
        whole = pa.concat_tables(held).group_by("token").aggregate([("c", "sum"), ("o", "sum")])
        return whole.select(["token", "c_sum", "o_sum"]).rename_columns(["token", "c", "o"])

    for part in _slices(batches, "bin"):
        other = _held_out(part)
        words, size = words_of(part.column("bin"))
        code = words.dictionary_encode()
        at, v = code.indices.to_numpy(), len(code.dictionary)
        o = np.bincount(at[np.repeat(other, size)], minlength=v)
        c = np.bincount(at, minlength=v) - o
        token = pa.concat_arrays([code.dictionary, pa.array([END], pa.binary())])
        held.append(pa.table({"token": token, "c": np.append(c, (~other).sum()), "o": np.append(o, other.sum())}))
        n += v + 1
        if n > WORDS:
            whole = added()
            held, n = [whole], whole.num_rows
            if n > WORDS // 2:
                yield from whole.to_batches()
                held, n = [], 0
    if held:
        yield from added().to_batches()
    held.clear()
    _release()


# --- code and counters ----------------------------------------------------------------------------------------------


class Code:
    """Huffman code of the codebook: for the token numbered k, its decisions (node, depth and bit as one number) are
    ``path`` from offset[k] to offset[k + 1]."""

    def __init__(self, weights: list[int]):
        heap = [(w, k) for k, w in enumerate(weights)]
        heapq.heapify(heap)
        n = len(weights)
        parent, side = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
        node = n
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y], side[y] = node, node, 1
            heapq.heappush(heap, (a + b, node))
            node += 1
        root = node - 1
        nodes, bits, offset = [], [], [0]
        for k in range(n):
            path = []
            while k != root:
                path.append((parent[k] - n, side[k]))
                k = parent[k]
            nodes += [p for p, _ in path[::-1]]
            bits += [s for _, s in path[::-1]]
            offset.append(len(nodes))
        nodes, bits = np.array(nodes, np.int64), np.array(bits, np.int64)
        self.offset = np.array(offset, np.int64)
        self.size = np.diff(self.offset)
        depth = np.arange(len(nodes)) - np.repeat(self.offset[:-1], self.size)
        depth = np.minimum(depth, 15)
        self.path = (nodes << 5 | depth << 1 | bits).astype(np.int32)
        ones, both = np.zeros(n), np.zeros(n)
        w = np.repeat(np.array(weights, float), self.size)
        np.add.at(both, nodes, w)
        np.add.at(ones, nodes, w * bits)
        self.n1, self.n0 = ones, both - ones
        self.st = stretch(self.n1, self.n0)
        prior = 4 / (1 + np.exp(-self.st))
        self.prior = (4 - prior + 1j * prior).astype(np.complex64)  # zeros and ones, four in all

    def decided(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray):
        """(node, bit, depth, slots under the two contexts, end of each token's decisions) of all decisions."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1])
        at += np.repeat(self.offset[ids] - ends + size, size)
        path = self.path.take(at)
        node = (path >> 5).astype(np.int64)
        slots = (slot(np.repeat(c, size), node) for c in (one, two))
        return node, path & 1, path >> 1 & 15, *slots, ends


def stretch(n1, n0) -> np.ndarray:
    """Logit of the smoothed share of ones; 0 where nothing was counted."""
    return np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -_LIMIT, _LIMIT).astype(np.float32)


_P1, _P2, _P3 = 0x9E3779B97F4A7C15 - (1 << 64), 0xC2B2AE3D27D4EB4F - (1 << 64), 0x165667B19E3779F9


def contexts(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, hashes of the previous one and of the previous two of its text (before the first: an end)."""
    one, two = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    one[1:], two[2:] = ids[:-1] + 1, ids[:-2] + 1
    one[place == 0] = 0
    two[place < 2] = 0
    return one * _P1, one * _P2 + two * _P3 + 1


def slot(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    x = context + node
    x *= _P2
    x >>= 29
    x &= SLOTS - 1
    return x


def _places(size: np.ndarray) -> np.ndarray:
    """Place of each token in its text."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _groups(held: list[np.ndarray]):
    """Groups of consecutive texts with up to ``PIECE`` tokens in all, or of one text."""
    group, n = [], 0
    for ids in held:
        if group and n + len(ids) > PIECE:
            yield group
            group, n = [], 0
        group.append(ids)
        n += len(ids)
    if group:
        yield group


class Book:
    """The codebook in the tasks: numbers the tokens of texts, those outside it with ``escape``."""

    def __init__(self, words: pa.Array):
        self.words, self.escape = words, len(words)
        end = words.index(pa.scalar(END, pa.binary())).as_py()
        self.end = end if end >= 0 else self.escape

    def ids(self, texts: pa.Array):
        """(ids of all tokens, number of tokens of each text, words outside the codebook, index of their texts)"""
        words, size = words_of(texts)
        found = pc.index_in(words, value_set=self.words)
        outside = found.is_null()
        out = np.full(len(words) + len(size), self.end, np.int64)
        ends = np.cumsum(size + 1)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner] = found.fill_null(self.escape).to_numpy()
        of = np.repeat(np.arange(len(size)), size)[outside.to_numpy(zero_copy_only=False)]
        return out, size + 1, words.filter(outside), of


def _encode(book, logs):
    """One row for each text: its ids, what they add to the base score, and its words outside the codebook."""

    def run(batches):
        b, log_of = book.value, logs.value
        has = np.append(log_of[1] > 0, False).astype(np.int64)
        logp = np.append(log_of[0], 0.0)
        task, row = TaskContext.get().partitionId() << 33, 0
        for part in _slices(batches, "bin"):
            text, n = part.column("bin"), part.num_rows
            ids, size, words, of = b.ids(text)
            first, ends = np.cumsum(size) - size, np.append(0, np.cumsum(size))
            if b.end == b.escape:
                words = pa.concat_arrays([words, pa.array([END] * n, pa.binary())])
                of = np.append(of, np.arange(n))
            rare = words.dictionary_encode()
            v = max(len(rare.dictionary), 1)
            met, tf = np.unique(of * v + rare.indices.to_numpy(), return_counts=True)
            pairs = pa.StructArray.from_arrays([rare.dictionary.take(pa.array(met % v)), pa.array(tf.astype(np.int64))],
                                               ["token", "tf"])
            blobs = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * ends).astype(np.int32)),
                                                           pa.py_buffer(ids.astype(np.uint32))])
            arrays = [pa.array(task + row + np.arange(n)), part.column("doc_id"), pa.array(_held_out(part)), pa.array(size),
                      pa.array(np.add.reduceat(has[ids], first)), pa.array(np.add.reduceat(logp[ids], first)),
                      pc.binary_length(text).fill_null(0).cast(pa.int64()), blobs,
                      pa.ListArray.from_arrays(pa.array(np.searchsorted(met, v * np.arange(n + 1)).astype(np.int32)), pairs)]
            row += n
            yield pa.RecordBatch.from_arrays(arrays, _ENCODED)
        _release()

    return run


_ENCODED = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "n_bytes", "ids", "rare"]
_PLAIN = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, n_bytes long, "


def _texts(batches):
    """(part of a batch, ids of its texts)"""
    for part in _slices(batches, "ids"):
        ids, size = _parts(part.column("ids"), 4)
        yield part, np.split(ids.astype(np.int64), np.cumsum(size)[:-1])
    _release()


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes and end marks of the words, each behind the three before it, as one number; first place of each word). Before a
    word's first byte there are end marks."""
    flat, size = _parts(words)
    b = np.full(len(flat) + len(size), 32, np.uint32)
    ends = np.cumsum(size + 1)
    inner = np.ones(len(b), bool)
    inner[ends - 1] = False
    b[inner] = flat
    behind, out = _places(size + 1), b.copy()
    for back in (1, 2, 3):
        before = np.full(len(b), 32, np.uint32)
        before[back:] = np.where(behind[back:] >= back, b[:-back], 32)
        out |= before << 8 * back
    return out, ends - size - 1


def spellings(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots of the three contexts, bits) of the eight decisions of each gram's last byte."""
    b = gram.astype(np.int64)[:, None]
    k = np.arange(8)
    last = b & 255
    part = (1 << k) | (last >> (8 - k))  # the byte's bits so far, behind a one
    context, slots = np.zeros_like(b), []
    for back in (1, 2, 3):
        context = context * 259 + (b >> 8 * back & 255) + 1
        slots.append(slot(context * _P1 + 7 * back, part * 1025).ravel())
    return np.stack(slots), ((last >> (7 - k)) & 1).ravel()


def _many(batches):
    """The batches' rows, ``SPELLED`` at once or more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= SPELLED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    _release()


def _chunks(counters: np.ndarray):
    """Rows (place, counts) of the chunks that hold counts."""
    flat = counters.reshape(-1, CHUNK)
    at = np.flatnonzero(flat.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int32)), pa.array([flat[k].astype(np.uint32).tobytes() for k in at], pa.binary())],
        ["place", "counts"])


def _add_chunks(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column("place").to_pylist(), batch.column("counts").to_pylist()):
            v = np.frombuffer(c, np.uint32)
            total[k] = total[k] + v if k in total else v.astype(np.int64)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["place", "counts"])


def _summed(chunks: DataFrame, tables: int) -> np.ndarray:
    """Counts of the counter tables, zeros and ones; of fixed size, so the driver may hold them."""
    rows = chunks.repartition("place").mapInArrow(_add_chunks, "place int, counts binary").collect()
    flat = np.zeros((tables * SLOTS * 2 // CHUNK, CHUNK))
    for r in rows:
        flat[r.place] = np.frombuffer(r.counts, np.int64)
    return flat.reshape(tables, 2, SLOTS)


def _stretched(n: np.ndarray) -> np.ndarray:
    return stretch(n[:, 1], n[:, 0])


def _train_contexts(code):
    def run(batches):
        counters = np.zeros((2, 2, SLOTS), np.uint32)
        for _, held in _texts(batches):
            _tally(counters, held, code.value)
        yield _chunks(counters)

    return run


def _tally(counters, held, code):
    for group in _groups(held):
        ids = np.concatenate(group)
        one, two = contexts(ids, _places(np.array([len(i) for i in group])))
        for s in range(0, len(ids), PIECE):
            _, bit, _, a, b, _ = code.decided(ids[s : s + PIECE], one[s : s + PIECE], two[s : s + PIECE])
            for table_, place in zip(counters, (a, b)):
                place += SLOTS * bit
                np.add.at(table_.reshape(-1), place, table_.dtype.type(1))  # of its own type: much faster


def _train_spelling(batches):
    counters = np.zeros((3, 2, SLOTS), np.int64)
    for batch in _many(batches):
        gram, times = pa.array(grams(batch.column("token"))[0]).value_counts().flatten()
        slots, bits = spellings(gram.to_numpy())
        for k in range(3):
            np.add.at(counters[k].reshape(-1), slots[k] + SLOTS * bits, np.repeat(times.to_numpy(), 8))
    yield _chunks(counters)


def _cost(p: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return -np.log2(np.abs(1 - bits - p))


def _spell(st):
    def run(batches):
        tables = st.value
        for batch in _many(batches):
            gram, first = grams(batch.column("token"))
            code = pa.array(gram).dictionary_encode()  # few distinct ones: each is worked out once
            slots, bits = spellings(code.dictionary.to_numpy())
            x = sum(w * tables[k][slots[k]] for k, w in enumerate(SPELLING))
            p = np.clip(1 / (1 + np.exp(-x)), 1e-4, 1 - 1e-4)
            cost = _cost(p, bits).reshape(-1, 8).sum(axis=1, dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("token"), batch.column("c"), pa.array(np.add.reduceat(cost[code.indices.to_numpy()], first))],
                ["token", "c", "bits"])

    return run


# --- online mixing --------------------------------------------------------------------------------------------------


GATES = 32
_INITIAL = np.array([0.35, 0.3, 0.15, 0.35], np.float32)
_CELL_AT = np.linspace(-_LIMIT, _LIMIT, CELLS, dtype=np.float32)


def plain() -> tuple[np.ndarray, np.ndarray]:
    """Weights by gate and map by gate and cell before anything is learnt."""
    return np.tile(_INITIAL, (GATES, 1)), np.tile(1 / (1 + np.exp(-_CELL_AT)), GATES)


def _cell(dot: np.ndarray, gate: np.ndarray) -> np.ndarray:
    return ((dot + _LIMIT) * ((CELLS - 1) / (2 * _LIMIT)) + 0.5).astype(np.int64) + CELLS * gate


def _of(gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rows of ``weights`` (four float32) at these gates; a row is taken as one item."""
    return weights.view(np.complex128).ravel().take(gate).view(np.float32).reshape(-1, 4)


def _mixed(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    dot = weights[:, 0] * x[0]
    for k in (1, 2, 3):
        dot += weights[:, k] * x[k]
    return np.clip(dot, -_LIMIT, _LIMIT)


def _blocks(n: int) -> np.ndarray:
    """Ends of the blocks of a text of n tokens: each as long as all before it, up to ``BLOCK`` tokens."""
    ends = [FIRST]
    while ends[-1] < n:
        ends.append(ends[-1] + min(ends[-1], BLOCK))
    return np.minimum(ends, n)


class Piece:
    """Decisions of texts side by side: all first blocks, then all second ones, and so on; or text by text."""

    def __init__(self, code: Code, ids, one, two, text, block):
        self.node, self.bit, depth, self.one, self.two, ends = code.decided(ids, one, two)
        self.gate = depth.astype(np.int64)
        cuts = np.flatnonzero((text[1:] != text[:-1]) | (block[1:] != block[:-1]))
        first = np.append(0, cuts + 1)
        self.size, self.text = np.diff(np.append(first, len(ids))), text[first]
        self.block = block[first]
        self.ends = ends[np.append(cuts, len(ids) - 1)]
        self.starts = np.append(0, self.ends[:-1])

    def spans(self) -> dict[int, list[tuple[int, int, int]]]:
        """By text: (number, first decision, end) of its blocks."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        for t, k, a, b in zip(*(v.tolist() for v in (self.text, self.block, self.starts, self.ends))):
            out.setdefault(t, []).append((k, a, b))
        return out


class Mixer:
    """Scores texts with weights by gate, an adaptive map by gate and prediction, and counts of the nodes met; each text has
    its own. ``start`` is where weights and map start."""

    def __init__(self, code: Code, tables: np.ndarray, start: tuple[np.ndarray, np.ndarray] | None = None):
        self.code, self.tables, self.start = code, tables, start or plain()
        # met by node: zeros and ones side by side, which are read as the parts of one complex number
        self.seen = np.zeros(2 * len(code.st), np.float32)

    def _pieces(self, held: list[np.ndarray], by_block: bool):
        """Pieces of a group's decisions. Many texts are one piece, a long text may be several."""
        size = np.array([len(ids) for ids in held])
        ids, place, text = np.concatenate(held), _places(size), np.repeat(np.arange(len(held)), size)
        one, two = contexts(ids, place)
        ends = _blocks(size.max())
        block = np.searchsorted(ends, place, "right")
        if len(held) == 1:
            step = PIECE // BLOCK
            cuts = np.append(ends[step - 1 :: step], len(ids))
            for a, b in zip(np.append(0, cuts).tolist(), cuts.tolist()):
                if a < b:
                    yield Piece(self.code, ids[a:b], one[a:b], two[a:b], text[a:b], block[a:b])
            return
        if by_block:
            order = np.argsort(block, kind="stable")
            ids, one, two, text, block = (v[order] for v in (ids, one, two, text, block))
        yield Piece(self.code, ids, one, two, text, block)

    def _lookup(self, piece: Piece):
        """(stretched predictions of the node alone and in the slots of both contexts, prior of zeros and ones)"""
        x = np.empty((4, len(piece.node)), np.float32)
        x[0] = self.code.st.take(piece.node)
        x[1] = self.tables[0].take(piece.one)
        x[2] = self.tables[1].take(piece.two)
        return x, self.code.prior.take(piece.node)

    @staticmethod
    def _within(piece: Piece, x: np.ndarray, met: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """The gates; sets the prediction from the text so far."""
        piece.gate += 16 * (met.view(np.int64) != 0)
        prior += met
        n = prior.view(np.float32)
        np.log(n[1::2] / n[::2], out=x[3])
        return piece.gate

    def _met(self, piece: Piece, own: np.ndarray | None = None, keep: bool = False) -> np.ndarray:
        """Counts of the decisions' nodes in the blocks of their text before their own; ``own`` gets those of all blocks.
        With ``keep`` the counts stay for the text's next piece."""
        met, pairs, last_too = np.zeros(len(piece.node), np.complex64), self.seen.view(np.complex64), keep or own is not None
        counter = 2 * piece.node + piece.bit
        for spans in piece.spans().values():
            for k, a, b in spans:
                if k:
                    met[a:b] = pairs.take(piece.node[a:b])
                if last_too or b != spans[-1][2]:
                    np.add.at(self.seen, counter[a:b], _ONE)
            if own is not None:
                for _, a, b in spans:
                    own[a:b] = pairs.take(piece.node[a:b])
            if not keep:
                for _, a, b in spans if last_too else spans[:-1]:
                    pairs[piece.node[a:b]] = 0
        return met

    def _predicted(self, held: list[np.ndarray], by_block: bool = True):
        """(stretched predictions, gates, piece) of a group's pieces. In a block all decisions see the state before it."""
        pieces = list(self._pieces(held, by_block))
        for piece in pieces:
            x, prior = self._lookup(piece)
            yield x, self._within(piece, x, self._met(piece, keep=len(pieces) > 1), prior), piece
        if len(pieces) > 1:
            self.seen[:] = 0

    def decisions(self, ids: np.ndarray):
        """For each block of a text: (stretched predictions, gates, bits)."""
        for x, gate, piece in self._predicted([ids]):
            for a, b in zip(piece.starts.tolist(), piece.ends.tolist()):
                yield x[:, a:b], gate[a:b], piece.bit[a:b]

    def cost(self, ids: np.ndarray) -> float:
        return float(self.costs([ids])[0])

    def costs(self, held: list[np.ndarray]) -> np.ndarray:
        """Bits of each text."""
        out, at = np.empty(len(held)), 0
        order = np.argsort([-len(ids) for ids in held], kind="stable")  # so that the texts with a next block come first
        for group in _groups([held[k] for k in order]):
            out[order[at : at + len(group)]] = self._costs(group)
            at += len(group)
        return out

    def _costs(self, held: list[np.ndarray]) -> np.ndarray:
        n = len(held)
        weights, chart = np.tile(self.start[0], (n, 1)), np.tile(self.start[1], n)
        more = np.array([len(_blocks(len(ids))) for ids in held])  # blocks
        total, last = np.zeros(n), None
        for x_all, gates, piece in self._predicted(held):
            gates += np.repeat(GATES * piece.text, piece.ends - piece.starts)
            for k in range(int(piece.block[0]), int(piece.block[-1]) + 1):
                lo, hi = np.searchsorted(piece.block, [k, k + 1])
                if last is not None:
                    self._learn(weights, chart, *last)
                a, b = int(piece.starts[lo]), int(piece.ends[hi - 1])
                x, gate, bit = x_all[:, a:b], gates[a:b], piece.bit[a:b].astype(np.float32)
                dot = _mixed(x, _of(gate, weights))
                p = 1 / (1 + np.exp(-dot))
                cell = _cell(dot, gate)
                charted = chart.take(cell)
                refined = np.clip((3 * p + charted) / 4, 1e-4, 1 - 1e-4)
                total[: hi - lo] += np.add.reduceat(_cost(refined, bit), piece.starts[lo:hi] - a)
                on = int((more > k + 1).sum())  # texts with a next block
                b = int(piece.ends[lo + on - 1]) - a if on else 0
                last = on, x[:, :b], gate[:b], cell[:b], (bit - p)[:b], (bit - charted)[:b]
        return total

    @staticmethod
    def _learn(weights, chart, texts, x, gate, cell, err, off):
        n = GATES * texts
        pull = RATE / np.sqrt(np.bincount(gate, minlength=n) + 1.0)
        for k in range(4):
            weights[:n, k] += pull * np.bincount(gate, err * x[k], n)
        # each cell moves towards its share of ones: by hits / (hits + 1 / MAP_RATE) of the way
        chart[: n * CELLS] += np.bincount(cell, off, n * CELLS) / (np.bincount(cell, minlength=n * CELLS) + 1 / MAP_RATE)


class Learner(Mixer):
    """Sums over training texts from which the start of all texts is worked out. Predictors do not count the text that
    is being predicted, or they would look better than they are on a new text."""

    def __init__(self, code: Code, counts: np.ndarray, start: tuple[np.ndarray, np.ndarray]):
        super().__init__(code, counts, start)
        # zeros and ones of a counter lie side by side and are read as one number
        self.counts = np.stack([n.T for n in counts])
        self.left = np.minimum(self.counts, 2**32 - 1).astype(np.uint32).reshape(2, -1)
        self.all_nodes = (code.n0 + 1j * code.n1).astype(np.complex64)
        self.own_nodes = self.seen  # a text's own, once all its blocks are met

    @property
    def own(self) -> np.ndarray:
        """Counts that are taken out at the moment."""
        return self.counts.reshape(2, -1) - self.left

    def _others(self, pieces: list[Piece]) -> list[list[np.ndarray]]:
        """For each piece, the zeros and ones that other texts have in its slots under both contexts."""
        out = [[np.empty(len(p.node), np.int64) for _ in self.left] for p in pieces]
        parts = [(p, rest, spans[0][1], spans[-1][2]) for p, rest in zip(pieces, out) for spans in p.spans().values()]
        for text in [parts] if len(pieces) > 1 else [[part] for part in parts]:
            for k, n in enumerate(self.left):
                pairs = n.view(np.int64)
                mine = [(rest[k][a:b], at := (p.one, p.two)[k][a:b], 2 * at + p.bit[a:b]) for p, rest, a, b in text]
                for _, _, counter in mine:
                    np.subtract.at(n, counter, _COUNT)
                for rest, at, _ in mine:
                    pairs.take(at, out=rest, mode="clip")
                for _, _, counter in mine:
                    np.add.at(n, counter, _COUNT)
        return out

    def texts(self, held: list[np.ndarray]):
        """(stretched predictions, gates, bits) of all decisions of the texts, in pieces."""
        for group in _groups(held):
            pieces = list(self._pieces(group, False))
            others = self._others(pieces)
            mets, nodes = [], [np.empty(len(p.node), np.complex64) for p in pieces]
            if len(pieces) == 1:
                mets.append(self._met(pieces[0], nodes[0]))
            else:
                mets += [self._met(p, keep=True) for p in pieces]
                for p, n in zip(pieces, nodes):
                    n[:] = self.seen.view(np.complex64).take(p.node)
                self.seen[:] = 0
            for piece, rest, met, own in zip(pieces, others, mets, nodes):
                x = np.empty((4, len(piece.node)), np.float32)
                node = self.all_nodes.take(piece.node)
                node -= own
                for k, n in enumerate((node.view(np.float32), *(r.view(np.uint32).astype(np.float32) for r in rest))):
                    if k == 0:
                        np.maximum(n, 0, out=n)  # never under 0, even where a count is too large to be exact
                    n += np.float32(0.4)
                    np.log(n[1::2] / n[::2], out=x[k])
                np.clip(x[:3], -_LIMIT, _LIMIT, out=x[:3])
                share = 4 / (1 + np.exp(-x[0]))
                prior = np.empty(len(share), np.complex64)
                prior.real, prior.imag = 4 - share, share
                yield x, self._within(piece, x, met, prior), piece.bit


_ONE, _COUNT = np.float32(1), np.uint32(1)
_PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]


def _slopes(x, gate, bit, dot) -> np.ndarray:
    out = np.zeros((4 + len(_PAIRS), GATES))
    p = 1 / (1 + np.exp(-dot))
    err, bend = bit - p, p * (1 - p)
    for k in range(4):
        out[k] = np.bincount(gate, err * x[k], GATES)
    bent = bend * x
    for k, (i, j) in enumerate(_PAIRS):
        out[4 + k] = np.bincount(gate, bent[i] * x[j], GATES)
    return out


def _hits(x, gate, bit, dot) -> np.ndarray:
    n = np.bincount(2 * _cell(dot, gate) + bit, minlength=2 * GATES * CELLS).reshape(-1, 2)
    return np.stack([n.sum(axis=1), n[:, 1]])


def _added(learner: Learner, held: list[np.ndarray], *of) -> np.ndarray:
    """The sums that ``of`` make over all decisions, flat and one after the other."""
    total = 0
    for x, gate, bit in learner.texts(held):
        dot = _mixed(x, _of(gate, learner.start[0]))
        total = total + np.concatenate([f(x, gate, bit, dot).ravel() for f in of])
    return total


def weight_sums(learner: Learner, held: list[np.ndarray]) -> np.ndarray:
    """By gate: slope (4) and curvature (10) of the cost in the weights."""
    return _added(learner, held, _slopes).reshape(-1, GATES)


def map_sums(learner: Learner, held: list[np.ndarray]) -> np.ndarray:
    """By cell of the map: decisions and ones."""
    return _added(learner, held, _hits).reshape(2, -1)


def both_sums(learner: Learner, held: list[np.ndarray]) -> np.ndarray:
    """``weight_sums`` and ``map_sums`` of one pass."""
    return _added(learner, held, _slopes, _hits)


def new_weights(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """One Newton step of each gate, held back where it has few decisions."""
    out = weights.copy()
    for g in range(GATES):
        curve = np.eye(4) * CAUTION
        for k, (i, j) in enumerate(_PAIRS):
            curve[i, j] += sums[4 + k, g]
            if i != j:
                curve[j, i] += sums[4 + k, g]
        out[g] += np.linalg.solve(curve, sums[:4, g])
    return out


_BOTH = (4 + len(_PAIRS) + 2 * CELLS) * GATES


def new_map(chart: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return (sums[1] + chart / MAP_RATE) / (sums[0] + 1 / MAP_RATE)


def _sums(code, counts, start, of):
    """One row for each task: the sums that ``of`` makes over its training texts."""

    def run(batches):
        learner, total = Learner(code.value, counts.value, start), None
        for _, held in _texts(batches):
            got = of(learner, held)
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(total.ravel().tolist()), pa.array(range(total.size), pa.int32())],
                                             ["v", "place"])

    return run


def _total(source: DataFrame, run, shape: tuple[int, ...]) -> np.ndarray:
    """The tasks' sums, added on Spark; of fixed size, so the driver may hold them."""
    rows = source.mapInArrow(run, "v double, place int").groupBy("place").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(shape).ravel()
    for r in rows:
        out[r.place] = r.v
    return out.reshape(shape)


def learnt_start(source: DataFrame, code, counts) -> tuple[np.ndarray, np.ndarray]:
    """Weights and map at the start of each text, learnt from all training texts. The sums are over texts that each
    start afresh, so the result does not depend on partitions, but for rounding."""
    weights, chart = plain()
    got = _total(source, _sums(code, counts, (weights, chart), both_sums), (_BOTH,))
    slopes, hits = np.split(got, [(4 + len(_PAIRS)) * GATES])
    weights = new_weights(weights, slopes.reshape(-1, GATES))
    return weights.astype(np.float32), new_map(chart, hits.reshape(2, -1))


def _score(code, tables, start):
    def run(batches):
        mixer = Mixer(code.value, tables.value, start)
        for part, held in _texts(batches):
            yield pa.RecordBatch.from_arrays(part.columns[:-1] + [pa.array(mixer.costs(held))], _ENCODED[:-2] + ["bits"])

    return run


def _most_frequent(counts: DataFrame) -> list:
    """At most ``CODEBOOK`` tokens of the training texts, in order: all those above a count, found from a histogram with
    eight cells for each doubling."""
    counts = counts.where("c > 0")
    cell = F.floor(8 * F.log2("c")).cast("int")
    least, n = None, 0
    for r in sorted(counts.groupBy(cell.alias("cell")).count().collect(), key=lambda r: -r["cell"]):
        n += r["count"]
        if n > CODEBOOK:
            break
        least = r["cell"]
    rows = counts.where(cell >= least).collect() if least is not None else []
    return sorted(rows, key=lambda r: (-r.c, bytes(r.token)))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigram log10
    probability), score (log10 probability under the model), total_bits, bits_per_byte (null for no bytes).

    Texts whose crc32(doc_id as text) mod 10 is not 0 train the model; all are scored. A null text is empty, and an empty
    text is one end; a null doc_id is the empty text for crc32, so it is held out. Rows may repeat: each is counted and
    scored. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    workers_ready(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("bin"))
    counts = stage(source.mapInArrow(_count, "token binary, c long, o long").groupBy("token").agg(
        F.sum("c").alias("c"), F.sum("o").alias("o")), "counts")
    total = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"), F.sum("o").alias("o")).first()
    n, v = total.n or 0, total.v or 0
    floor = n + 0.1 * (v + 1)
    top = _most_frequent(counts)
    book = pa.array([bytes(r.token) for r in top], pa.binary())
    c = np.array([r.c for r in top], float)
    rest = max(n - int(c.sum()), 1)
    sc = spark.sparkContext
    code = sc.broadcast(Code([r.c + 1 for r in top] + [rest]))
    logs = sc.broadcast(np.stack([np.log10((c + 0.1) / floor), c]) if top else np.zeros((2, 0)))
    encoded = stage(source.mapInArrow(_encode(sc.broadcast(Book(book)), logs),
                                      _PLAIN + "ids binary, rare array<struct<token: binary, tf: long>>"), "encoded")
    training = encoded.where("not held_out").select("ids")
    met = _summed(training.mapInArrow(_train_contexts(code), "place int, counts binary"), 2)
    tables = sc.broadcast(_stretched(met))
    start = learnt_start(training, code, sc.broadcast(met.astype(np.float32)))
    common = F.broadcast(spark.createDataFrame([(bytearray(r.token),) for r in top], "token binary"))
    others = counts.join(common, "token", "left_anti")
    spelled = sc.broadcast(_stretched(_summed(others.where("c > 0").select("token").mapInArrow(
        _train_spelling, "place int, counts binary"), 3)))
    words = others.select("token", "c").mapInArrow(_spell(spelled), "token binary, c long, bits double")
    rows = stage(encoded.drop("rare").mapInArrow(_score(code, tables, start), _PLAIN + "bits double"), "scored")
    tf = F.col("tf")
    # joined by a hash of the token, which sorts faster, and the token itself
    words = words.select(F.xxhash64("token").alias("h"), F.col("token").alias("word"), "c", "bits")
    spelt = encoded.select("uid", F.inline("rare")).withColumn("h", F.xxhash64("token")).join(words, "h").where(
        "token <= word and token >= word")
    rare = spelt.groupBy("uid").agg(
        F.sum(tf * F.log10((F.col("c") + 0.1) / F.lit(floor))).alias("rare_base"), F.sum(tf * F.col("bits")).alias("rare_bits"),
        F.sum(F.when(F.col("c") > 0, tf).otherwise(0)).alias("rare_known"))
    out = rows.join(rare, "uid", "left")

    def plus(a, b):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    bits = plus("bits", "rare_bits")
    return out.select("doc_id", "held_out", "n_tokens", plus("n_known", "rare_known").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), plus("base", "rare_base").alias("base_score"),
                      (-bits * math.log10(2)).alias("score"), bits.alias("total_bits"),
                      F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"))


def op6(spark, sf_dir) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
