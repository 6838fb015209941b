import hashlib
import math
import re
import types
import zlib

import brute
import numpy as np
import pyarrow as pa
from edge import edge_rows

from candlewick.llm import decontaminate, language_id, lm_scoring, mixing, secret_scan
from pyspark.sql import functions as F


def test_contamination(spark, edge, empty, monkeypatch):
    rows = dict(edge_rows())
    items = [(1, rows[6]), (2, " ".join(rows[27].split()[100:115])), (3, "one TWO"), (4, None), (5, "..."), (None, rows[6]),
             (6, "é"), (2, " ".join(rows[27].split()[100:115]))]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def words(t):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)

    wins = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            k = min(10, len(w))
            for s in range(len(w) - k + 1):
                wins.setdefault(tuple(w[s : s + k]), set()).add(i)
    want = {}
    for i, t in rows.items():
        w, hit, ids = words(t), set(), set()
        for k in {len(x) for x in wins}:
            for s in range(len(w) - k + 1):
                if tuple(w[s : s + k]) in wins:
                    hit.update(range(s, s + k))
                    ids |= wins[tuple(w[s : s + k])]
        want[i] = (len(w), len(hit), sorted(map(str, ids)))
    assert any(x[1] for x in want.values())

    def got(docs):
        return {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, bench).collect()}

    assert got(edge) == want
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 7)  # several blocks of terms
    assert got(edge) == want
    assert decontaminate.contamination(empty, bench).count() == 0
    none = decontaminate.contamination(edge, bench.limit(0)).collect()
    assert all(r.n_hit == 0 for r in none) and len(none) == len(rows)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "aa bb extra cc dd ee ff gg hh ii jj"), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "aa bb cc dd ee ff gg hh ii jj")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.near_items) for r in decontaminate.contamination(docs, bench).collect()}
    assert got[1] == (0, ["7"]) and got[2] == (0, [])


def test_mixing(spark, edge, empty):
    texts = dict(edge_rows())

    def name(r):
        return "|".join([str(r.doc_id), hashlib.md5(texts[r.doc_id].encode()).hexdigest() if texts[r.doc_id] is not None else "-",
                         hashlib.md5(r.source.encode()).hexdigest(), "1"])

    rows = mixing.mix(edge, {"s0": 3.0, "s1": 1.0}, total=4000).collect()
    assert {r.source for r in rows} <= {"s0", "s1"}
    per = {}
    for r in rows:
        per.setdefault((r.source, r.doc_id), []).append(r)
    for (s, i), own in per.items():
        assert sorted(r.replica for r in own) == list(range(1, own[0].copies + 1)) and len(own) == own[0].copies
        parts = max(1, math.ceil(own[0].rate / 16))
        n = 0
        for j in range(1, parts + 1):  # inverse of the Poisson distribution
            u = int(hashlib.md5(f"{mixing.SEED}|{name(own[0])}|{j}".encode()).hexdigest()[:12], 16) / 2.0**48
            p = f = math.exp(-own[0].rate / parts)
            k = 0
            while f <= u:
                k += 1
                p *= own[0].rate / parts / k
                f += p
            n += k
        assert n == own[0].copies
    share = sum(r.source == "s0" for r in rows) / len(rows)
    assert 0.65 < share < 0.85 and 3400 < len(rows) < 4600
    equal = mixing.mix(edge).collect()
    assert None in {r.source for r in equal}  # a null source is a source
    assert mixing.mix(empty).count() == 0
    salted = sorted((r.doc_id, r.replica) for r in equal)
    import candlewick.llm.mixing as m
    old, m.broadcast_if_small = m.broadcast_if_small, lambda df: df
    try:
        assert sorted((r.doc_id, r.replica) for r in mixing.mix(edge).collect()) == salted
    finally:
        m.broadcast_if_small = old


def test_mixing_rows_without_own_ids_draw_each_for_itself(spark):
    rows = [(None, f"text {k}", "a") for k in range(150)] + [(5, "same", "a")] * 400 + [(k, "", "b") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def drawn(parts):
        return sorted((r.doc_id or -1, r.text, r.rate, r.replica, r.shuffle_key) for r in mixing.mix(df.repartition(parts), total=600).collect())

    got = drawn(3)
    assert got == drawn(7)  # whatever the partitions
    assert len({r[4] for r in got}) == len(got)  # no two copies share a shuffle key
    n = {s: sum(r[0] in ids for r in got) for s, ids in (("null", {-1}), ("same", {5}))}
    rate = 300 / 550
    assert abs(n["null"] - 150 * rate) < 40 and abs(n["same"] - 400 * rate) < 65
    again = sum(1 for r in got if r[0] == 5 and r[3] == 1)
    assert abs(again - 400 * (1 - math.exp(-rate))) < 45  # rows drawn at least once


def test_language_id(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train, test = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    model = language_id.fit(train)
    blind = language_id.document_evidence(test).withColumn("declared", F.lit(None).cast("string"))
    got = language_id.identify(blind, model).select("doc.lang", "language", "kept").collect()
    assert sum(r.lang == r.language for r in got) >= 0.97 * len(got)
    assert sum(r.kept for r in got) >= 0.99 * len(got)
    odd = [(1, None, None, None), (2, "", "en", "a"), (3, "x", "en", "a"), (4, "the and of " * 9, "en", None)]
    rows = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string")
    got = {r.doc.doc_id: r.kept for r in language_id.identify(language_id.document_evidence(rows), model).collect()}
    assert not got[1] and not got[2] and got[4]
    assert language_id.identify(language_id.document_evidence(empty), model).count() == 0


def test_language_evidence_of_pages(spark):
    html = '<!DOCTYPE html><HTML class="x" lang="fr-CA"><script>var a="</p>"</script><p>le <b>chat</b></p>'
    pages = spark.createDataFrame([(1, "https://u@h.example.org:80/de/1?x", html), (2, None, None), (3, "http://a.fr", "plain")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r for r in language_id.page_evidence(pages).collect()}
    assert (got[1].host, got[1].suffix, got[1].declared) == ("h.example.org", "de", "fr")
    assert bytes(got[1].bin).split() == [b"le", b"chat"]
    assert (got[2].host, got[2].bin, got[3].suffix) == (None, None, "fr")


def test_host_prior_decides_weak_text(spark):
    model = (["xx", "yy", "und"], np.log(np.full((3, language_id.BUCKETS), 1.0 / language_id.BUCKETS)))
    model[1][0, 5:9] += 3
    rows = [("t", "h1", None, "xx")] * 20 + [("t", "h2", None, "yy")] * 20
    df = spark.createDataFrame(rows, "t string, host string, suffix string, declared string").withColumn("bin", F.lit(b""))
    got = language_id.identify(df, model).collect()
    assert len(got) == 40 and not any(r.kept for r in got)  # no text: nothing to identify


def test_lm_scoring(spark, edge, empty):
    rows = edge_rows()
    want = brute.unigram(rows)
    got = lm_scoring.score(edge).collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, train, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert r.score < 0 and abs(r.score + r.total_bits * math.log10(2)) < 1e-6
        assert (r.bits_per_byte is None) == (not dict(rows)[r.doc_id])
    assert lm_scoring.score(empty).count() == 0


def test_code_is_prefix_free_and_mixing_learns():
    code = lm_scoring.Code([50, 20, 10, 5, 1, 1])
    assert abs(sum(2.0 ** -int(k) for k in code.size) - 1) < 1e-12
    tables = np.zeros((2, lm_scoring.SLOTS), np.float32)
    mixer = lm_scoring.Mixer(code, tables)
    rare = np.array([4] * 4000)  # repeating a rare token gets cheap as the text goes on
    assert mixer.cost(rare) < 0.3 * 4000 * code.size[4]
    assert mixer.cost(np.array([4])) == lm_scoring.Mixer(code, tables).cost(np.array([4]))  # a text starts fresh


def test_code_and_scores_do_not_learn_from_held_out_texts(spark):
    rows = [(k, f"aa bb w{k % 7} cc") for k in range(60)]
    held = [k for k in range(60, 400) if lm_scoring.held_out(k)]
    more = [(k, "only held here " * 30) for k in held[1:]]
    one = (held[0], "aa only bb held cc")

    def scores(rows):
        got = lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        return {r.doc_id: (r.n_known, r.base_score, r.total_bits) for r in got}

    few, all_ = scores(rows + [one]), scores(rows + [one] + more)
    for i, (known, base, bits) in few.items():
        assert all_[i][0] == known and abs(all_[i][1] - base) < 1e-9 and abs(all_[i][2] - bits) < 1e-6


def test_short_texts_learn_and_start_from_training_texts():
    rng = np.random.default_rng(3)
    texts = [np.cumsum(rng.integers(1, 3, 60)) % 5 for _ in range(80)]
    code = lm_scoring.Code((np.bincount(np.concatenate(texts), minlength=6) + 1).tolist())
    counts = np.zeros((2, 2, lm_scoring.SLOTS))
    lm_scoring._tally(counts, texts, code)
    tables = lm_scoring._stretched(counts)
    held = [np.cumsum(rng.integers(1, 3, 60)) % 5 for _ in range(40)]
    mixer = lm_scoring.Mixer(code, tables)

    def fixed(ids):  # weights and map as they start
        total = 0.0
        for x, gate, bit in mixer.decisions(ids):
            dot = lm_scoring._mixed(x, mixer.start[0][gate])
            p = np.clip((3 / (1 + np.exp(-dot)) + mixer.start[1][lm_scoring._cell(dot, gate)]) / 4, 1e-4, 1 - 1e-4)
            total += lm_scoring._cost(p, bit).sum()
        return total

    assert all(len(ids) < 512 and abs(mixer.cost(ids) - fixed(ids)) > 0.01 for ids in held)
    again = np.array([4] * 200)
    assert mixer.cost(again) < 0.97 * fixed(again)
    weights, chart = lm_scoring.plain()
    learner = lm_scoring.Learner(code, counts, (weights, chart))
    sums = lm_scoring.weight_sums(learner, texts)
    assert np.allclose(sums, sum(lm_scoring.weight_sums(learner, texts[k::3]) for k in range(3)))  # any partitions
    weights = lm_scoring.new_weights(weights, sums)
    learner = lm_scoring.Learner(code, counts, (weights, chart))
    start = weights, lm_scoring.new_map(chart, lm_scoring.map_sums(learner, texts))
    learnt = lm_scoring.Mixer(code, tables, start)
    assert sum(map(learnt.cost, held)) < 0.97 * sum(map(mixer.cost, held))
    assert not learner.own.any() and not learner.own_nodes.any() and not learner.seen.any()


def test_learner_leaves_its_text_out():
    code = lm_scoring.Code([50, 20, 10, 5, 1, 1])
    texts = [np.array([0, 3, 1, 0]), np.array([4, 4, 2])]
    counts = np.zeros((2, 2, lm_scoring.SLOTS))
    lm_scoring._tally(counts, texts, code)
    rest = np.zeros((2, 2, lm_scoring.SLOTS))
    lm_scoring._tally(rest, texts[1:], code)
    got = [x for x, _, _ in lm_scoring.Learner(code, counts, lm_scoring.plain()).texts(texts[:1])]
    want = [x for x, _, _ in lm_scoring.Mixer(code, lm_scoring._stretched(rest)).decisions(texts[0])]
    assert np.allclose(np.hstack(got)[1:3], np.hstack(want)[1:3])


def test_words_of_texts():
    texts = [b"", None, b"  A b\x0b\x0cC\td\x1ce ", b"one", b"   ", "\u00c4 \u0130x\u00a0y \u2003".encode(), b"\xff\xfe Z", b"a\r\na"]
    words, size = lm_scoring.words_of(pa.array([b"cut off"] + texts, pa.binary())[1:])
    want = [(t or b"").lower().split() for t in texts]
    assert size.tolist() == [len(w) for w in want] and words.to_pylist() == sum(want, [])
    book = lm_scoring.Book(pa.array([b"a", b"", b"one"], pa.binary()))
    ids, size, rare, of = book.ids(pa.array(texts, pa.binary()))
    known = {b"a": 0, b"": 1, b"one": 2}
    assert ids.tolist() == [known.get(w, 3) for ws in want for w in ws + [b""]] and size.tolist() == [len(w) + 1 for w in want]
    assert list(zip(of.tolist(), rare.to_pylist())) == [(k, w) for k, ws in enumerate(want) for w in ws if w not in known]


def test_many_spelled_words(spark, edge, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CODEBOOK", 8)
    want, rows = brute.unigram(edge_rows()), lm_scoring.score(edge).collect()
    assert all((r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4] for r in rows)
    assert np.allclose([r.base_score for r in rows], [want[r.doc_id][4] for r in rows])


def _some_texts():
    rng = np.random.default_rng(5)
    texts = [rng.geometric(0.4, n).clip(1, 6) - 1 for n in (1, 16, 17, 3, 700, 1, 90, 5000, 40, 2100, 64)]
    code = lm_scoring.Code((np.bincount(np.concatenate(texts), minlength=6) + 1).tolist())
    counts = np.zeros((2, 2, lm_scoring.SLOTS))
    lm_scoring._tally(counts, texts, code)
    return texts, code, counts


def test_texts_side_by_side_cost_what_each_costs_alone(monkeypatch):
    texts, code, counts = _some_texts()
    tables = lm_scoring._stretched(counts)

    def one(ids):  # block by block, with its own state
        weights, chart = lm_scoring.plain()
        weights, chart, total, last = weights.copy(), chart.copy(), 0.0, None
        for x, gate, bit in lm_scoring.Mixer(code, tables).decisions(ids):
            if last is not None:
                lm_scoring.Mixer._learn(weights, chart, 1, *last)
            dot = lm_scoring._mixed(x, weights[gate])
            p, cell = 1 / (1 + np.exp(-dot)), lm_scoring._cell(dot, gate)
            total += lm_scoring._cost(np.clip((3 * p + chart[cell]) / 4, 1e-4, 1 - 1e-4), bit).sum()
            last = x, gate, cell, bit - p, bit - chart[cell]
        return total

    want = [one(ids) for ids in texts]
    for piece in (lm_scoring.PIECE, 1024):  # with 1024 the long texts are several pieces
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        mixer = lm_scoring.Mixer(code, tables)
        assert np.allclose(mixer.costs(texts), want, rtol=1e-6) and not mixer.seen.any()


def test_learning_does_not_depend_on_pieces(monkeypatch):
    texts, code, counts = _some_texts()
    want = sum(lm_scoring.both_sums(lm_scoring.Learner(code, counts, lm_scoring.plain()), [ids]) for ids in texts)
    for piece in (lm_scoring.PIECE, 1024):
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        learner = lm_scoring.Learner(code, counts, lm_scoring.plain())
        assert np.allclose(lm_scoring.both_sums(learner, texts), want, rtol=1e-6, atol=1e-3)
        assert not learner.own.any() and not learner.seen.any()


def test_spelling_counts_each_distinct_word_and_works_out_each_gram_once(monkeypatch):
    words = [b"", b"a", b"aaaa", b"baaa", "\u00e9t\u00e9".encode(), b"aaaab"]
    counters = np.zeros((3, 2, lm_scoring.SLOTS))
    decisions = []
    for w in words:
        before = [32, 32, 32]
        for byte in [*w, 32]:
            for k in range(8):
                part, bit, context, at = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1, 0, []
                for back in range(3):
                    context = context * 259 + before[back] + 1
                    at.append(int(lm_scoring.slot(np.array([context * lm_scoring._P1 + 7 * (back + 1)
                                                            & (1 << 64) - 1], np.uint64).astype(np.int64), part * 1025)[0]))
                    counters[back, bit, at[-1]] += 1
                decisions.append((w, at, bit))
            before = [byte, *before[:2]]
    batch = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(range(6))], ["token", "c"])
    got = np.zeros((3 * 2 * lm_scoring.SLOTS // lm_scoring.CHUNK, lm_scoring.CHUNK))
    for r in list(lm_scoring._train_spelling([batch]))[0].to_pylist():
        got[r["place"]] = np.frombuffer(r["counts"], np.uint32)
    assert np.array_equal(got.reshape(counters.shape), counters)
    tables, want = lm_scoring._stretched(counters), dict.fromkeys(words, 0.0)
    for w, at, bit in decisions:
        x = sum(v * tables[k][at[k]] for k, v in enumerate(lm_scoring.SPELLING))
        want[w] -= math.log2(abs(1 - bit - min(max(1 / (1 + math.exp(-x)), 1e-4), 1 - 1e-4)))
    seen, whole = [], lm_scoring.spellings
    monkeypatch.setattr(lm_scoring, "spellings", lambda gram: seen.extend(gram.tolist()) or whole(gram))
    out = list(lm_scoring._spell(types.SimpleNamespace(value=tables))([batch, batch]))[0].to_pydict()
    assert out["token"] == words * 2 and np.allclose(out["bits"], [want[w] for w in words * 2], rtol=1e-5)
    assert len(seen) == len(set(seen))


def _token(body):
    return "ghp_" + body + secret_scan.base62(zlib.crc32(body.encode())).decode()


def test_secrets(spark, empty):
    good = _token("A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5")
    bad = good[:-1] + ("a" if good[-1] != "a" else "b")
    texts = [None, "", f"é PassWord = 'abcdefgh12' {good} {bad}", "token:short token=longenough=token=x", "AKIA" + "Z" * 12 + " AKIA1",
             "é" * 50 + "0123456789abcdef" * 2, "api-key=abcdefghij apikey:abcdefghij API_KEY = \"abcdefghij\"", "ſecret=abcdefghij",
             "x" * 200_000 + " secret: 0123456789abcdef0123456789abcdef"]
    rows = list(enumerate(texts)) + [(None, texts[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = secret_scan.find_secrets(df).collect()
    assert len(got) == len(rows)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in got:
        x = texts[r.doc_id if r.doc_id is not None else 2] or ""
        want = [(m.start(), "assign", m.end()) for m in assign.finditer(x) if len(m[2]) >= 8]
        want += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m[0]) >= 16]
        want += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", x) if len(m[0]) >= 32]
        base = sorted((s.a, s.kind, s.b) for s in r.spans if s.kind in secret_scan.BASE)
        assert base == sorted(want)
        assert [s.kind for s in r.spans].count("github") == (texts.index(x) == 2 if x else False)
    assert secret_scan.find_secrets(empty).count() == 0


def test_secret_scan_is_linear_in_runs_that_fail():
    import base64
    import time
    auto = secret_scan.automaton()
    head = base64.urlsafe_b64encode(b'{"alg":"none"}').rstrip(b"=")
    for text in (b"eyJ" * 350_000, b"eyJ" * 300_000 + b".eyJ", (b"eyJ" * 100 + b".") * 3000, b"AKIA" * 250_000, b"token" + b" " * 1_000_000):
        at = time.perf_counter()
        found = secret_scan.scan(text, auto)
        assert time.perf_counter() - at < 20
        assert not found or text.startswith(b"AKIA")
    good = head + b".eyJh.c2ln"
    text = b"eyJeyJ eyJ_" + b"eyJ" * 9 + b". " + good + b" eyJx." + good + b" " + b"eyJ" + b"W1sb" * 30_000 + b".eyJa.b"
    plain = [m.span() for m in re.finditer(secret_scan.PATTERNS["jwt"], text)]
    want = [s for s in plain if secret_scan._valid("jwt", secret_scan.PATTERNS["jwt"].match(text, s[0]))]
    assert [(a, b) for a, k, b in secret_scan.scan(text, auto) if secret_scan.KINDS[k] == "jwt"] == want and want
