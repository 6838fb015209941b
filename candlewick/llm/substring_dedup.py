"""Exact removal of repeated 200-byte strings with a two-stage suffix sort.

1. Anchors. Of the 32-byte strings that start in the first 169 places of a 200-byte window, the one with the least
   hash (leftmost on ties) is the window's anchor. Equal windows have equal anchors in equal places, so a window can
   only repeat within the group of its anchor's hash. Each run of windows with one anchor is one row: the hash of the
   anchor, a hash of the run's bytes, and where it is. Neighbouring runs share no window.
2. Anchors that occur once go. Where all runs of an anchor are equal, they are equal suffixes throughout: every
   window of theirs repeats. Equal runs are one row from here on.
3. The others, one text for each distinct run, are suffix-sorted in batches that hold whole anchor groups: suffixes
   smaller than their successors are sorted directly, the rest induced by one scan over the first-byte buckets, and
   adjacent suffixes whose common prefix reaches 200 bytes are repeats.
4. An anchor with more than ``CROWD`` distinct runs is not sorted in one task: its runs are cut into cells of
   ``CELL`` windows, grouped by the bytes all windows of the cell share; cells that stay crowded are cut into single
   windows, which need no order, only the hash of their 200 bytes.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_group, runs, stage, table, workers_ready

LENGTH, GRAM = 200, 32
#: Start places of a window's 32-byte strings.
PLACES = LENGTH - GRAM + 1
PIECE = 1 << 23
CROWD = 512
CELL = 16
#: Suffixes sorted in one batch, if its last group is not larger.
SUFFIXES = 200_000

_BYTE = np.random.default_rng(9).integers(0, 1 << 63, 256, np.uint64)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                0xA0761D6478BD642F)]


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    h, w = _BYTE[b], 1
    for c in _STEP:  # 2, 4, 8, 16, 32 bytes
        h = h[:-w] * c + h[w:]
        w *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _least(v: np.ndarray) -> np.ndarray:
    """Least value of each ``PLACES`` neighbours."""
    w = 1
    while 2 * w <= PLACES:
        v = np.minimum(v[:-w], v[w:])
        w *= 2
    rest = PLACES - w
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def anchor_runs(text: bytes) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, hash of the run's bytes, first window, last window, anchor's place in the first window) of all runs
    of windows with one anchor."""
    whole, low = np.frombuffer(text, np.uint8), np.uint64((1 << 24) - 1)
    fps, ctx, lo, hi, rel = [], [], [], [], []
    for at in range(0, max(0, len(whole) - LENGTH + 1), PIECE):
        b = whole[at : at + PIECE + LENGTH - 1]
        h = _gram_hashes(b)
        least = _least((h & ~low) | np.arange(len(h), dtype=np.uint64))
        anchor = (least & low).astype(np.int64)
        cut = runs(anchor)
        s0, s1, a = cut[:-1], cut[1:] - 1, anchor[cut[:-1]]
        fps.append(h[a].view(np.int64))
        lo.append(s0 + at)
        hi.append(s1 + at)
        rel.append(a - s0)
        digest = xxhash.xxh3_64_intdigest
        ctx += [digest(text[at + x : at + y + LENGTH], z) - (1 << 63)
                for x, y, z in zip(s0.tolist(), s1.tolist(), (a - s0).tolist())]
    if not fps:
        e = np.empty(0, np.int64)
        return e, [], e, e, e
    return np.concatenate(fps), ctx, np.concatenate(lo), np.concatenate(hi), np.concatenate(rel)


def _anchors(batches):
    for batch in batches:
        parts, rows = [[] for _ in range(6)], 0
        for rk, t in zip(batch.column("rk").to_pylist(), batch.column("bin")):
            text = t.as_py()
            if not text or len(text) < LENGTH:
                continue
            fp, ctx, lo, hi, rel = anchor_runs(text)
            for p, v in zip(parts, (fp, np.array(ctx, np.int64), np.full(len(fp), rk), lo, hi, rel)):
                p.append(v)
            rows += len(fp)
            if rows > 200_000:
                yield _rows(parts)
                parts, rows = [[] for _ in range(6)], 0
        if rows:
            yield _rows(parts)


def _rows(parts):
    cols = [np.concatenate(p) for p in parts]
    cols[3:] = [c.astype(np.int32) for c in cols[3:]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["fp", "ctx", "rk", "lo", "hi", "rel"])


def suffix_order(texts: list[bytes], starts: list[int]) -> tuple[list[int], bytes, list[int]]:
    """Two-stage suffix sort of the first ``starts[k]`` suffixes of each text: (their places in the joined text, in
    order; the joined text; the start of each text). Suffixes end with their text."""
    joined = b"".join(texts)
    size = np.array([len(t) for t in texts])
    ends = np.cumsum(size)
    base = ends - size
    t = np.frombuffer(joined, np.uint8)
    step = np.zeros(len(t), np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int16) - t[:-1])
    step[ends - 1] = -1  # the empty suffix is the smallest
    # equal neighbours take the type of the next place that differs
    place = np.where(step != 0, np.arange(len(t)), len(t))
    place = np.minimum.accumulate(place[::-1])[::-1]
    smaller = step[place] > 0
    # wanted: the asked-for suffixes, and those that they are induced from, up to the next directly sorted one
    direct = np.flatnonzero(smaller)
    last = base + np.array(starts) - 1
    nxt = np.searchsorted(direct, last)
    stop = np.where(nxt < len(direct), direct[np.minimum(nxt, len(direct) - 1)] if len(direct) else 0, len(t))
    chain_ends = stop >= ends  # no directly sorted suffix up to the text's end
    stop = np.where(chain_ends, ends - 1, stop)
    wanted = np.zeros(len(t) + 1, np.int32)
    np.add.at(wanted, base, 1)
    np.add.at(wanted, stop + 1, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    end_of = np.repeat(ends, size).tolist()
    chosen = np.flatnonzero(wanted & smaller).tolist()
    chosen.sort(key=lambda g: joined[g : end_of[g]])
    buckets_direct: list[list[int]] = [[] for _ in range(256)]
    for g in chosen:
        buckets_direct[joined[g]].append(g)
    induced: list[list[int]] = [[] for _ in range(256)]
    for e in (ends[chain_ends] - 1).tolist():
        induced[joined[e]].append(e)
    follows = wanted & ~smaller  # may be induced from the suffix to the right
    follows[ends - 1] = False
    from_right = np.concatenate([[False], follows[:-1]]).tolist()  # from_right[g]: g - 1 is induced from g
    order: list[int] = []
    for c in range(256):
        for scan in (induced[c], buckets_direct[c]):
            for g in scan:  # grows while it is scanned
                if from_right[g]:
                    induced[joined[g - 1]].append(g - 1)
            order += scan
    return order, joined, base.tolist()


def repeated(texts: list[bytes], starts: list[int]) -> list[np.ndarray]:
    """For each text, which of its first ``starts[k]`` 200-byte windows occur elsewhere among these texts."""
    order, joined, base = suffix_order(texts, starts)
    size = np.array([len(t) for t in texts])
    first = np.repeat(np.array(base), size)
    count = np.repeat(np.array(starts), size)
    order = np.array(order, np.int64)
    order = order[order - first[order] < count[order]].tolist()
    mark = np.zeros(len(joined), bool)
    for g, h in zip(order, order[1:]):
        if joined[g : g + LENGTH] == joined[h : h + LENGTH]:
            mark[g] = mark[h] = True
    return [mark[b : b + s] for b, s in zip(base, starts)]


_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _sort_groups(batches):
    """fp, ctx, n, run -> fp, ctx, and the bytes a to b of the run that its repeated windows cover: one range, as all
    windows of a run hold its anchor."""
    for t in by_group(batches, ["fp"], SUFFIXES // 80):
        fp, ctx, n = (t.column(c).to_numpy() for c in ("fp", "ctx", "n"))
        texts = t.column("run").to_pylist()
        keep, lo, hi = [], [], []
        for k, mark in enumerate(repeated(texts, [len(x) - LENGTH + 1 for x in texts])):
            at = (0, len(mark) - 1) if n[k] > 1 else np.flatnonzero(mark)
            if len(at):
                keep.append(k)
                lo.append(at[0])
                hi.append(at[-1] + LENGTH)
        yield pa.RecordBatch.from_arrays([pa.array(fp[keep]), pa.array(ctx[keep]), pa.array(lo, pa.int32()),
                                          pa.array(hi, pa.int32())], ["fp", "ctx", "a", "b"])


def _cells(batches):
    """Cuts runs into cells of windows on a grid that is fixed to the anchor. ``gid``: hash of the bytes that all
    windows of the cell share; equal windows are in equal cells of one gid."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        cols = [[] for _ in range(7)]
        for fp, ctx, n, rel, run in zip(*(batch.column(c).to_pylist() for c in ("fp", "ctx", "n", "rel", "run"))):
            last = len(run) - LENGTH
            for cell in range(-rel // CELL, (last - rel) // CELL + 1):
                i0, i1 = cell * CELL + rel, cell * CELL + CELL - 1 + rel
                shared = run[i1 : i0 + LENGTH] if i1 <= last else run[i1 : min(i0 + LENGTH, len(run))]
                i0, i1 = max(i0, 0), min(i1, last)
                piece = run[i0 : i1 + LENGTH]
                for col, v in zip(cols, (fp, ctx, i0, digest(shared, seed=(fp ^ cell) & ((1 << 64) - 1)) - (1 << 63),
                                         digest(piece, seed=i0 - rel + 1000) - (1 << 63), n, piece)):
                    col.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                   pa.int64(), pa.binary()])],
            ["fp", "ctx", "off", "gid", "cid", "n", "run"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(batches):
    for batch in batches:
        kept, spans = [], []
        for t, s in zip(batch.column("bin"), batch.column("spans")):
            text = t.as_py() or b""
            found = merged([(x["a"], x["b"]) for x in s.as_py() or []])
            rest, at = [], 0
            for a, b in found:
                rest.append(text[at:a])
                at = b
            kept.append(b"".join(rest) + text[at:])
            spans.append([{"a": a, "b": b} for a, b in found])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("bin"), pa.array(kept, pa.binary()),
                                          pa.array(spans, _SPANS)], ["doc_id", "bin", "kept", "spans"])


def _rows_repeat(source: DataFrame) -> bool:
    return not source.groupBy("rk").count().where("count > 1").isEmpty()


def repeated_spans(source: DataFrame) -> DataFrame:
    """source: rk (long), bin -> rk, spans (array of a, b; may overlap) for the rows with repeated strings."""
    anchors = stage(source.mapInArrow(_anchors, "fp long, ctx long, rk long, lo int, hi int, rel int"), "anchors")
    often = anchors.groupBy("fp").agg(F.count("*").alias("n"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"))
    often = stage(often.where("n > 1").select("fp", (F.col("c0") != F.col("c1")).alias("several")), "often")
    found = stage(anchors.join(often, "fp"), "repeats")
    several = found.where("several")
    distinct = several.groupBy("fp", "ctx").agg(F.count("*").alias("n"), F.first(F.struct("rk", "lo", "hi", "rel")).alias("r"))
    distinct = distinct.select("fp", "ctx", "n", "r.*")
    once = source.dropDuplicates(["rk"]) if _rows_repeat(source) else source  # one text for each distinct run
    texts = distinct.join(once, "rk").select(
        "fp", "ctx", "n", "rel", F.expr("substring(bin, lo + 1, hi - lo + 200)").alias("run"))
    texts = stage(texts, "runs")
    partly = several.join(_solved(texts), ["fp", "ctx"]).select(
        "rk", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b"))
    fully = found.where("not several").select("rk", F.col("lo").alias("a"), (F.col("hi") + LENGTH).alias("b"))
    return partly.union(fully).groupBy("rk").agg(F.collect_set(F.struct("a", "b")).alias("spans"))  # once for equal rows


def _sorted(groups: DataFrame) -> DataFrame:
    return groups.repartition("fp").sortWithinPartitions("fp").mapInArrow(
        _sort_groups, "fp long, ctx long, a int, b int")


def _crowded(groups: DataFrame) -> DataFrame:
    return stage(groups.groupBy("fp").count().where(F.col("count") > CROWD).select("fp"), "crowd")


def _solved(texts: DataFrame) -> DataFrame:
    """texts: fp, ctx, n, rel, run -> fp, ctx, a, b: a row for each run with repeated windows, the bytes that they cover.
    Crowded groups by cells, crowded cells by single windows."""
    columns = ["fp", "ctx", "n", "run"]
    crowd = _crowded(texts)
    if crowd.isEmpty():
        return _sorted(texts.select(columns))
    crowd = broadcast_if_small(crowd)
    spans = _sorted(texts.select(columns).join(crowd, "fp", "left_anti"))
    cells = stage(texts.join(crowd, "fp", "left_semi").mapInArrow(
        _cells, "fp long, ctx long, off int, gid long, cid long, n long, run binary"), "cells")
    distinct = cells.groupBy("gid", "cid").agg(F.sum("n").alias("n"), F.first("run").alias("run"))
    distinct = stage(distinct.select(F.col("gid").alias("fp"), F.col("cid").alias("ctx"), "n", "run"), "cells")
    crowd = broadcast_if_small(_crowded(distinct))
    by_cell = _sorted(distinct.join(crowd, "fp", "left_anti"))
    windows = distinct.join(crowd, "fp", "left_semi").select(
        "fp", "ctx", "n", "run", F.explode(F.sequence(F.lit(0), F.octet_length("run") - LENGTH)).alias("i"))
    windows = windows.select("fp", "ctx", "n", "i", F.expr("xxhash64(substring(run, i + 1, 200))").alias("h"))
    often = windows.groupBy("fp", "h").agg(F.sum("n").alias("t")).where("t > 1").select("fp", "h")
    by_window = windows.join(often, ["fp", "h"]).groupBy("fp", "ctx").agg(
        F.min("i").alias("a"), (F.max("i") + LENGTH).alias("b"))
    found = by_cell.union(by_window).toDF("gid", "cid", "a", "b")
    found = cells.select("fp", "ctx", "off", "gid", "cid").join(found, ["gid", "cid"])
    return spans.union(found.groupBy("fp", "ctx").agg(
        F.min(F.col("a") + F.col("off")).alias("a"), F.max(F.col("b") + F.col("off")).alias("b")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, bin (the text as UTF-8 bytes), kept (the bytes left), spans (removed ranges a, b of bytes): every byte
    covered by a 200-byte string that also starts anywhere else in the table is removed.

    Null and empty texts, and those under 200 bytes without repeats, stay as they are (null: bin null, kept empty).
    Rows may repeat and doc_id may be null or repeat: every row is a text of its own. Other columns are ignored; an
    empty table gives an empty result.
    """
    workers_ready(docs.sparkSession)
    doc, text = F.col(id_col).cast("long"), F.col(text_col)
    source = docs.select(doc.alias("doc_id"), text.cast("binary").alias("bin"),
                         F.xxhash64(doc, F.length(text), text).alias("rk"))
    spans = repeated_spans(source.select("rk", "bin"))
    return source.join(spans, "rk", "left").select("doc_id", "bin", "spans").mapInArrow(
        _cut, "doc_id long, bin binary, kept binary, spans array<struct<a:int,b:int>>")


def op9(spark, sf_dir) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    n_bytes = F.coalesce(F.octet_length("bin"), F.lit(0)).cast("long")
    return out.select("doc_id", n_bytes.alias("n_bytes"),
                      (n_bytes - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
