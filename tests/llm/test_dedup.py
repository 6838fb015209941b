import random

import brute
from edge import edge_rows

from candlewick.llm import line_dedup, near_dedup, substring_dedup
from candlewick.llm.common import components
from pyspark.sql import functions as F


def test_components(spark):
    links = [(k + 1, k) for k in range(40, 60)] + [(200 + k, 200) for k in range(1, 30)] + [(5, 9), (9, 9), (300, 301)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for p in links for x in p if p[0] != p[1]}
    assert got == brute.components(nodes, [p for p in links if p[0] != p[1]])


def test_near_duplicates(spark, edge, empty):
    want = brute.near_duplicates(edge_rows())
    got = near_dedup.near_duplicates(edge).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "x y z"), (2, "x y z")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(odd).collect())
    assert got == [(0, 2, None, False), (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False)]


def test_near_duplicates_small_chunks_and_no_proposals(edge, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 3)
    monkeypatch.setattr(near_dedup, "PROPOSALS", 0)
    got = near_dedup.near_duplicates(edge).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(edge_rows())


def test_bayesian_bounds():
    least = near_dedup.least_matches(1e-6)
    assert least == sorted(least) and least[-1] < 0.75 * near_dedup.HASHES
    assert near_dedup.least_matches(1e-2)[-1] > least[-1]


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(150):
        texts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 5))]
        starts = [rng.randint(1, len(t)) for t in texts]
        order, joined, base = substring_dedup.suffix_order(texts, starts)
        ends = [b + len(t) for b, t in zip(base, texts)]
        suffixes = [joined[g : next(e for e in ends if e > g)] for g in order]
        assert suffixes == sorted(suffixes) and len(set(order)) == len(order)
        assert {b + i for b, s in zip(base, starts) for i in range(s)} <= set(order)


def _removed(df):
    out = df.select("doc_id", F.coalesce(F.octet_length("bin"), F.lit(0)).alias("n"), F.octet_length("kept").alias("k"),
                    F.size("spans").alias("s"), F.sha2("kept", 256).alias("h")).collect()
    return {r.doc_id: (r.n, r.n - r.k, r.s, r.h) for r in out}


def test_repeated_strings(spark, edge, empty, monkeypatch):
    rows = edge_rows()
    want = dict(zip([i for i, _ in rows], brute.repeated_strings([t for _, t in rows])))
    assert _removed(substring_dedup.remove_repeats(edge)) == want
    assert substring_dedup.remove_repeats(empty).count() == 0
    monkeypatch.setattr(substring_dedup, "CROWD", 2)  # cells and single windows give the same
    assert _removed(substring_dedup.remove_repeats(edge)) == want
    twice = edge.where("doc_id = 27").union(edge.where("doc_id = 27"))
    assert [len(r.kept) for r in substring_dedup.remove_repeats(twice).collect()] == [0, 0]


def test_a_thousand_equal_rows(spark, monkeypatch):
    rng = random.Random(12)
    text = " ".join(str(rng.random()) for _ in range(40))
    rows = [(5, text)] * 1000 + [(6, text[:300] + "x" + text[300:]), (7, "own " * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    want = brute.repeated_strings([t for _, t in rows])
    got = substring_dedup.remove_repeats(df)
    assert sorted(set(_removed(got).items())) == sorted(set(zip([i for i, _ in rows], want))) and got.count() == len(rows)
    source = df.select(F.col("text").cast("binary").alias("bin"), F.xxhash64("doc_id", "text").alias("rk"))
    spans = substring_dedup.repeated_spans(source).select(F.size("spans").alias("n")).collect()
    assert len(spans) == 2 and max(r.n for r in spans) < 40  # not more for more copies


def test_crowded_anchors_give_one_range_a_run(spark, monkeypatch):
    rng = random.Random(21)
    words = lambda n: " ".join(str(rng.random()) for _ in range(n))
    passage = words(25)
    rows = [(i, words(3) + passage[i % 3 :] + words(3)) for i in range(14)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substring_dedup, "CROWD", 2)  # down to single windows
    source = df.select(F.col("text").cast("binary").alias("bin"), F.col("doc_id").alias("rk"))
    got = {r.rk: r.spans for r in substring_dedup.repeated_spans(source).collect()}
    assert set(got) == set(range(14))
    assert all(len(got[i]) <= len(substring_dedup.anchor_runs(t.encode())[0]) for i, t in rows)  # not one for each window
    assert _removed(substring_dedup.remove_repeats(df)) == dict(enumerate(brute.repeated_strings([t for _, t in rows])))


def test_line_dedup(spark, edge, empty):
    got = line_dedup.dedup_lines(edge)
    assert got.columns == [c for c in edge.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got.collect()} == brute.line_dedup(edge_rows())
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_long_runs(spark):
    rng = random.Random(2)
    lines = [f"w{k} w w" for k in range(60)]
    rows = []
    for i in range(25):
        at = rng.randrange(40)
        rows.append((i, "\n".join(lines[at : at + rng.randint(5, 40)] + [f"own {i}"] + ["", "x"] * rng.randrange(4))))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got.collect()} == brute.line_dedup(rows)


def test_line_dedup_rows_that_repeat(spark):
    rng = random.Random(4)
    run = [f"r{k} w w w" for k in range(40)]  # many short lines: any run of 50 words has 13 of them
    rows = [(i, "\n".join([f"own {i}"] + run[rng.randrange(8):] + [f"end {i}"])) for i in range(6)] + [(9, None)]
    many = rows + [rows[0]] * 3 + [rows[3]] + [rows[6]]
    got = line_dedup.dedup_lines(spark.createDataFrame(many, "doc_id long, text string")).collect()
    want = brute.line_dedup(rows)
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in many)
    assert all((r.n_lines, r.n_removed, r.text) == want[r.doc_id] for r in got)
    assert sum(n for _, n, _ in want.values()) > 150
