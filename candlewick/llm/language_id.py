"""Language ID by Bayesian evidence fusion.

A row's languages get posterior weights from its text (naive Bayes over hashed byte trigrams, fitted on a bounded sample
of labelled texts), its declared markup language, the suffix of its address, and a prior of its host. Tables of the last
three are grouped counts over all rows, labelled by the text alone, and leave the row itself out. The host prior is
smoothed towards its address suffix's, that towards the global one.

One more class, ``und``, has uniform trigrams: text that no language explains better goes there.
"""
from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage, table, workers_ready

#: Expected rows of each language that the text model is fitted on.
SAMPLE = 1500
#: Tasks that tally the sample.
TASKS = 16
BUCKETS = 1 << 15
UNKNOWN = "und"
#: Trigrams are not independent: a text weighs as this many of them at most.
WEIGHT = 40.0
#: Strength of the smoothing of host and suffix priors, and of the tables of declared languages and suffixes.
ALPHA, BETA = 5.0, 1.0
LEAST = 0.5


def trigrams(text: bytes) -> np.ndarray:
    b = np.frombuffer(text.lower(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    return ((b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D))
            >> np.uint32(17))


def _tally(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, t in zip(batch.column("lang").to_pylist(), batch.column("bin")):
            c = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            c += np.bincount(trigrams(t.as_py() or b""), minlength=BUCKETS)
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array([c.tobytes() for c in counts.values()])],
                                         ["lang", "counts"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages (sorted, then und) and log probabilities of trigrams by language. Of each language about ``sample`` rows
    are taken, by a hash of their id; null languages and texts are left out."""
    workers_ready(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    size = rows.groupBy(F.col(lang_col).alias("lang")).count()
    share = (F.lit(float(sample << 20)) / F.col("count")).cast("long")
    small = broadcast_if_small(size.select("lang", share.alias("share")))
    chosen = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"),
                         F.col(text_col).cast("binary").alias("bin"))
    chosen = chosen.join(small, "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("share"))
    total: dict[str, np.ndarray] = {}
    # the sample alone is shuffled, so that what the driver gets is TASKS rows a language at most, at any size of the input
    dealt = chosen.select("lang", "bin").repartition(TASKS)
    for r in dealt.mapInArrow(_tally, "lang string, counts binary").collect():
        c = np.frombuffer(r.counts, np.int64)
        total[r.lang] = total.get(r.lang, 0) + c
    langs = sorted(total)
    logs = [np.log((total[x] + 0.5) / (total[x].sum() + 0.5 * BUCKETS)) for x in langs]
    logs.append(np.full(BUCKETS, -math.log(BUCKETS)))
    return [*langs, UNKNOWN], np.array(logs, np.float32)


def _weigh(model):
    def run(batches):
        logs = model.value
        for batch in batches:
            like, label = [], []
            for t in batch.column("bin"):
                x = trigrams(t.as_py() or b"")
                if len(x):
                    v = logs[:, x].mean(axis=1, dtype=np.float64) * min(len(x), WEIGHT)
                    like.append((v - v.max()).tolist())
                    label.append(int(v.argmax()))
                else:
                    like.append([0.0] * len(logs))
                    label.append(None)
            names = [c for c in batch.schema.names if c != "bin"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(like, pa.list_(pa.float64())), pa.array(label, pa.int32())],
                [*names, "like", "label"])

    return run


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """rows: bin (the text), host, suffix, declared and any other columns -> the others, and language, probability, kept.

    ``kept``: the text is not empty, its language is not und and has a posterior of ``LEAST`` or more. Missing evidence
    (nulls, texts under three bytes) has no say. Rows may repeat; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    workers_ready(spark)
    langs, logs = model
    k = len(langs)
    small = spark.sparkContext.broadcast(logs)
    extra = [c for c in rows.columns if c not in ("bin", "host", "suffix", "declared")]
    rows = rows.select(F.struct(*[F.col(c) for c in extra]).alias("row"), "bin", "host", "suffix", "declared")
    kind = rows.schema["row"].dataType.simpleString()
    weighed = rows.mapInArrow(
        _weigh(small), f"row {kind}, host string, suffix string, declared string, like array<double>, label int")
    seen = rows.select(F.struct(F.lit(0).alias("x")).alias("row"), "bin", "host", "suffix", "declared").mapInArrow(
        _weigh(small), "row struct<x:int>, host string, suffix string, declared string, like array<double>, label int")
    seen = stage(seen.select("host", "suffix", "declared", "label").groupBy("host", "suffix", "declared", "label").agg(
        F.count("*").alias("n")), "labels")
    flat = seen.withColumn("w", F.col("n").cast("double"))

    def counts(key: str) -> DataFrame:
        per = flat.where(F.col(key).isNotNull() & F.col("label").isNotNull()).groupBy(key).agg(
            *[F.sum(F.when(F.col("label") == i, F.col("w")).otherwise(0.0)).alias(f"n{i}") for i in range(k)])
        return stage(per.select(key, F.array(*[f"n{i}" for i in range(k)]).alias(f"{key}_n")), key)

    total = flat.where("label is not null").agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == i, F.col("w")).otherwise(0.0)), F.lit(0.0)).alias(f"n{i}")
          for i in range(k)]).first()
    total = [float(x) for x in total]
    out = weighed
    kinds = {}
    for key in ("host", "suffix", "declared"):
        per = counts(key)
        kinds[key] = per.count()
        out = out.join(broadcast_if_small(per), key, "left")
    zero = F.array(*[F.lit(0.0)] * k)
    own = F.array(*[F.coalesce((F.col("label") == i).cast("double"), F.lit(0.0)) for i in range(k)])
    out = out.withColumn("own", own)

    def rest(name: str) -> Column:
        return F.zip_with(F.coalesce(name, zero), "own", lambda a, o: F.greatest(a - o, F.lit(0.0)))

    def summed(v) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)

    base = F.array(*[F.lit((x + 1.0) / (sum(total) + k)) for x in total])
    every = F.array(*[F.lit(x) for x in total])

    def smoothed(own_counts, above) -> Column:
        n = summed(own_counts)
        return F.zip_with(own_counts, above, lambda a, p: (a + ALPHA * p) / (n + ALPHA))

    def evidence(key: str) -> Column:
        some = F.zip_with(rest(f"{key}_n"), every, lambda a, n: F.log((a + BETA / max(kinds[key], 1)) / (n + BETA)))
        return F.when(F.col(key).isNull(), zero).otherwise(some)

    out = out.withColumn("p_suffix", smoothed(rest("suffix_n"), base))
    out = out.withColumn("p_host", smoothed(rest("host_n"), F.col("p_suffix")))
    parts = [F.transform("p_host", lambda p: F.log(p)), evidence("declared"), evidence("suffix")]
    post = F.col("like")
    for p in parts:
        post = F.zip_with(post, p, lambda a, b: a + b)
    out = out.withColumn("post", post).withColumn("top", F.array_max("post"))
    out = out.withColumn("best", F.array_position("post", F.col("top")).cast("int"))
    probability = F.lit(1.0) / summed(F.transform("post", lambda x: F.exp(x - F.col("top"))))
    names = F.array(*[F.lit(x) for x in langs])
    out = out.withColumn("language", F.element_at(names, F.col("best"))).withColumn("probability", probability)
    kept = F.col("label").isNotNull() & (F.col("language") != UNKNOWN) & (F.col("probability") >= LEAST)
    return out.select("row.*", "host", "suffix", "declared", "language", "probability", kept.alias("kept"))


_TAGS = re.compile(rb"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>")


def _visible(batches):
    for batch in batches:
        text = [None if (h := x.as_py()) is None else _TAGS.sub(b" ", h) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "suffix", "declared")),
                                          pa.array(text, pa.binary())], ["page_id", "host", "suffix", "declared", "bin"])


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, host, suffix (of the address: a language code that starts the path, else the last label of the host),
    declared (lang of the html element, its first part), bin (the visible text)."""
    def found(column, pattern):
        x = F.regexp_extract(column, pattern, 1)
        return F.when(x != "", F.lower(x))

    host = found("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)")
    code = found("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/([A-Za-z]{2})(?:[/?#]|$)")
    last = found("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?[^/:?#]*?([A-Za-z]+)(?:[/:?#]|$)")
    declared = found("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), F.coalesce(code, last).alias("suffix"),
                        declared.alias("declared"), F.col("html").cast("binary").alias("html")).mapInArrow(
        _visible, "page_id long, host string, suffix string, declared string, bin binary")


def document_evidence(docs: DataFrame) -> DataFrame:
    """All columns under ``doc``, and evidence: the source as host, lang as declared language; there is no address."""
    return docs.select(F.struct("*").alias("doc"), F.col("text").cast("binary").alias("bin"), F.col("source").alias("host"),
                       F.lit(None).cast("string").alias("suffix"), F.lower("lang").alias("declared"))


def op5(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs)
    columns = ["doc_id", "page_id", "host", "suffix", "declared", "language", "probability", "kept"]
    of_docs = document_evidence(docs).select(F.col("doc.doc_id").alias("doc_id"), "bin", "host", "suffix", "declared")
    of_docs = identify(of_docs, model).withColumn("page_id", F.lit(None).cast("long")).select(columns)
    workers_ready(spark)
    of_pages = identify(page_evidence(table(spark, sf_dir, "pages")), model)
    return of_docs.union(of_pages.withColumn("doc_id", F.lit(None).cast("long")).select(columns))
