import json
import random

import corpus_pipeline
import numpy as np
import pytest

from candlewick.llm import chat_format, topk
from candlewick.llm.queries import ORACLE, QUERIES


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE", 40)
    monkeypatch.setattr(topk, "BLOCK", 8)
    rng = random.Random(3)
    rows = [(i, [rng.randint(-3, 3) for _ in range(4)]) for i in range(150)] + [(3, [1, 1, 1, 1]), (7, None), (None, [1, 2, 3, 4]), (9, [])]
    rows += rows[:5] + [(500, [2, 2])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    use = [(i, tuple(v)) for i, v in rows if i is not None and v is not None]  # equal rows are candidates each
    got = {}
    for r in topk.top_k(df.where("v is not null"), df.where("v is not null and vec_id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (0, 50, 100, 500):
        v = next(v for i, v in use if i == q)
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in use if i != q)[:5]
        assert [(i, s) for _, i, s in sorted(got[q])] == [(i, -s) for s, i in best]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_blocks_of_a_cluster_are_skipped():
    rng = np.random.default_rng(8)
    middle = rng.normal(0, 100, (40, 32))
    v = (middle[rng.integers(0, 40, 4000)] + rng.normal(0, 10, (4000, 32))).astype(np.int64)
    held = topk._Range(np.arange(4000), list(v))
    assert sorted(np.concatenate(held.ids).tolist()) == list(range(4000)) and max(map(len, held.ids)) <= topk.BLOCK
    for q in range(0, 4000, 400):
        ids, scores = held.best(q, v[q], 5)
        own = v @ v[q]
        own[q] = -10**9
        assert ids.tolist() == np.lexsort((np.arange(4000), -own))[:5].tolist() and (own[ids] == scores).all()
    assert held.scored < 0.7 * 10 * len(held.ids)


def test_one_of_each_group_tells_documents_apart_by_id_and_text(spark):
    rng = random.Random(6)

    def prose():
        return " ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(40))

    a, b, c, d = (prose() for _ in range(4))
    rows = [(1, a, "x"), (2, a + " more", "y"), (1, b, "x"), (3, c, "x"), (3, c, "x"), (None, d, "x"), (None, d, "z"), (None, prose(), "x"),
            (None, a, "x"), (4, None, "x"), (5, "", "x"), (3, prose(), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = corpus_pipeline.one_of_each_group(spark, df, "")
    assert got.columns == df.columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    want = [(1, a), (1, b), (3, c), (None, d), rows[7][:2], (4, None), (5, ""), rows[11][:2]]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert corpus_pipeline.one_of_each_group(spark, df.limit(0), "").count() == 0


def test_quantised(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan")]), (3, [float("inf")]), (4, None), (5, [None, 1.0]), (6, [])]
    got = {r.vec_id: r.v for r in topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == {1: [128, -1], 6: []}


def test_link_calls(spark):
    calls = [(1, "a", 0, "f", '{"y": 1.0, "x": "é"}', None), (1, "b", 1, "f", '{"x": 5}', "a"), (1, "c", 2, "f", "not json", "b"),
             (1, "d", 3, "g", "{}", "zzz"), (1, "e", 4, "f", '{"x":"k"}', "h"), (1, "h", 5, "f", '{"x":"k"}', "e"),
             (1, "a", 9, "f", "{}", None), (2, "a", 0, "f", None, None), (None, "a", 0, "f", "{}", None), (3, None, 0, "f", "{}", None)]
    calls += [(4, f"n{k}", k, "f", '{"x":""}', f"n{k - 1}") for k in range(200)]
    results = [(1, "a", 1, "done"), (1, "a", 1, "done"), (1, "q", 2, None), (1, "b", 3, "r")]
    schemas = {"f": {"type": "object", "required": ["x"], "properties": {"x": {"type": "string"}, "y": {"type": "number"}}}}
    got = {(r.conv_id, r.call_id): r for r in chat_format.link_calls(
        spark.createDataFrame(calls, "conv_id long, call_id string, turn long, name string, arguments string, after string"),
        spark.createDataFrame(results, "conv_id long, call_id string, turn long, result string"), schemas).collect()}
    assert got[1, "a"].message == ('{"call":{"arguments":{"x":"é","y":1},"name":"f"},"conversation":1,"id":"a","result":"done"}')
    assert (got[1, "a"].status, got[1, "a"].call_copies, got[1, "a"].result_copies) == ("ok", 2, 2)
    assert (got[1, "b"].status, got[1, "b"].depth, got[1, "b"].faults) == ("invalid_arguments", 1, "$.x: not string")
    assert (got[1, "c"].status, got[1, "c"].depth, got[1, "c"].faults) == ("no_result", 2, "$: not JSON")
    assert (got[1, "d"].depth, got[1, "d"].faults) == (0, "$: no schema")
    assert got[1, "e"].status == got[1, "h"].status == "cycle" and got[1, "q"].status == "orphan_result"
    assert got[2, "a"].faults == "$: not object"
    assert all(got[4, f"n{k}"].depth == k for k in range(200))
    assert len(got) == 8 + 200


def test_canonical():
    x = {"b": [1.0, 2.5, True, None], "a": {"é": " ", "\U0001f600": 1, "דּ": 2}}
    text = chat_format.canonical(x)
    assert json.loads(text) == x and text.startswith('{"a":{"é":') and text.index("\U0001f600") < text.index("דּ")
    with pytest.raises(ValueError):
        chat_format.canonical(float("nan"))


def test_canonical_numbers_and_lone_surrogates(spark):
    numbers = {1e-5: "0.00001", 1e-6: "0.000001", 1e-7: "1e-7", 1.5e-9: "1.5e-9", -0.0: "0", 5.0: "5", 1e20: "100000000000000000000",
               1e21: "1e+21", -1.25e300: "-1.25e+300", 0.1: "0.1", 123456.789: "123456.789", 333333333.33333329: "333333333.3333333"}
    assert all(chat_format.canonical(x) == text and json.loads(text) == x for x, text in numbers.items())
    with pytest.raises(ValueError):
        chat_format.canonical({"a": ["\ud800"]})
    calls = [(1, "a", 0, "f", '{"x":"\\ud800"}', None), (1, "b", 1, "f", '{"x":"\\ud83d\\ude00","y":1e-7}', None),
             (1, "c", 2, "f", '{"x":"' + "k" * 300_000 + '"}', None), (1, "d", 3, "f", "[" * 5000, None)]
    schemas = {"f": {"type": "object", "properties": {"x": {"type": "string"}}}}
    kind = "conv_id long, call_id string, turn long, name string, arguments string, after string"
    got = {r.call_id: r for r in chat_format.link_calls(
        spark.createDataFrame(calls, kind), spark.createDataFrame([], "conv_id long, call_id string, turn long, result string"), schemas).collect()}
    assert got["a"].faults == "$: not JSON" and json.loads(got["a"].message)["call"]["arguments"] == calls[0][4]
    assert got["b"].faults == "" and '"arguments":{"x":"\U0001f600","y":1e-7}' in got["b"].message
    assert got["c"].faults == "" and len(got["c"].message) > 300_000 and got["d"].faults == "$: not JSON"
    none = chat_format.link_calls(spark.createDataFrame([], kind), spark.createDataFrame([], "conv_id long, call_id string, turn long, result string"),
                                  schemas)
    assert none.count() == 0


def test_registered():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)] and set(ORACLE) <= set(QUERIES)


def test_pipeline_stages(spark, edge):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    sf = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{sf}/documents.parquet").select(docs.columns)
    for name, step in corpus_pipeline.STAGES:
        before = docs if name == "language_id" else real
        out = step(spark, before, sf)
        assert out.columns[:5] == docs.columns
        n = out.count()
        assert 0 < n and (name == "mixing" or n <= before.count())
        real = real if name == "mixing" else corpus_pipeline.stage(step(spark, real, sf), name)
