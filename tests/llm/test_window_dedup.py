import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from edge import edge_rows
from paths import SF

from candlewick.llm import window_dedup as wd
from pyspark.sql import functions as F


def _brute(rows, n=13):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, spans, kept)"""
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - n + 1) if i is not None else ():
            key = tuple(w[k : k + n])
            least[key] = min(i, least.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - n + 1) if i is not None else ():
            if least[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        edge = [k for k in range(len(w) + 1) if (k < len(w) and gone[k]) != (k > 0 and gone[k - 1])]
        out.append((-1 if i is None else i, len(w), list(zip(edge[::2], edge[1::2])), b" ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def _got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, [(s.a, s.b) for s in r.spans], bytes(r.kept))
                  for r in wd.remove_repeats(df).collect())


def test_remove_repeats(spark, edge, empty):
    want = _brute(edge_rows())
    assert sum(len(s) for _, _, s, _ in want) > 10 and _got(edge) == want
    assert wd.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_blocks_slices_and_odd_rows(spark, monkeypatch, small):
    if small:  # many blocks, several slices, crowded counters: nearly all windows are estimated repeated
        monkeypatch.setattr(wd, "BLOCK", (300, 300))
        monkeypatch.setattr(wd, "SLICE", (6, 8))
        monkeypatch.setattr(wd, "SPARE", 1)
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for i in range(60):
        a, n = rng.randrange(25), rng.randint(8, 40)
        own = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice([i, i, i - 1, None if i % 9 == 0 else i]), rng.choice([" ", "\t", "\n ", "\x0b"]).join(own + passage[a : a + n])))
    rows += [(None, " ".join(passage)), (70, "é " * 40), (71, "é " * 40), (72, "\x85 \xa0" * 40), rows[3], rows[5], rows[5], (-4, " ".join(passage))]
    rows += [(80, None), (81, ""), (82, " \t"), (83, "x\x00y " * 30), (84, "x\x00y " * 30), (85, " ".join(passage) + "x"), (86, "Z" * 70_000)]
    schema = "doc_id long, text string, block int, kind string, bin string"
    df = spark.createDataFrame([r + (1, "k", "b") for r in rows], schema).repartition(3)
    assert _got(df) == _brute(rows)


def test_a_group_of_copies(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(30))) for i in range(2000)]
    got = _got(spark.createDataFrame(rows, "doc_id long, text string").repartition(16))
    assert got[0][2] == [] and all(s == [(0, 30)] and k == b"" for _, _, s, k in got[1:])


def test_word_hashes():
    rng = random.Random(1)
    texts = [b"one two  three", b"", b"four", b" \tfive\x0b", b"x" * 10_000 + b" y", b"x" * 10_001, b"one"]
    texts += [bytes(rng.choice(b"ab ") for _ in range(50)) for _ in range(50)]
    col = pa.array([b"skipped", *texts], pa.binary()).slice(1)
    t = wd.Texts(col)
    words = [(d, w) for d, x in enumerate(texts) for w in x.split()]
    assert [(int(d), bytes(t.text[a:b])) for d, a, b in zip(t.doc, t.a, t.b)] == words
    for kind in (0, 1):
        h = wd.word_hashes(t.text, t.a, t.b, kind)
        same = {}
        for (_, w), x in zip(words, h.tolist()):
            assert same.setdefault(w, x) == x
        assert len(set(same.values())) == len(same)


def test_word_hash_does_not_depend_on_pieces(monkeypatch):
    text = np.frombuffer(b"abc " + b"q" * 9000 + b" d " + b"r" * 40, np.uint8)
    a, b = wd.word_bounds(text, np.array([0]))
    whole = wd.word_hashes(text, a, b)
    monkeypatch.setattr(wd, "PIECE", 1000)
    assert (wd.word_hashes(text, a, b) == whole).all()


def test_gaps_and_sketch_lose_nothing():
    rng = np.random.default_rng(3)
    for p in ([], [0], [0, 0, 5], [70_000, 70_001, 1 << 40], np.sort(rng.integers(0, 1 << 18, 1000))):
        p = np.array(p, np.int64)
        assert (wd.unpacked_gaps(wd.packed_gaps(p)) == p).all()
    sketch = wd.Sketch(10_000_000)
    h = rng.integers(0, 1 << 63, 5000, np.uint64)
    blocks = [h[:3000], h[2000:]]  # 1,000 in both
    counts = np.zeros((wd.DEPTH, 1 << sketch.bits), int)
    for b in blocks:
        for row in range(wd.DEPTH):
            np.add.at(counts[row], sketch.places(b, row), 1)
    est = np.min([counts[row][sketch.places(h, row)] for row in range(wd.DEPTH)], axis=0)
    assert (est[2000:3000] >= 2).all() and (est >= 1).all() and (est >= 2).sum() < 1100


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({wd.SQL})").fetchall()
    got = wd.op11(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(r[2] for r in want) > 0
