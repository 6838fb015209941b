"""Line dedup over a suffix array of line-ID sequences, built by distributed prefix doubling.

The suffix array of all documents' line sequences is refined level by level: at level t two suffixes have one rank if
their first 2^t lines are equal, and ranks are in suffix order. Suffixes that share no 2^t lines with another one leave
it, because no repeated run of that length can start there; a line that occurs once in the table never enters.

Positions whose suffixes have at least m lines in common form an interval of the array with longest common prefix m or
more. For each position the shortest runs of ``min_words`` or more words that start or end there are looked up: two
ranks of the level below m, of the run's first and last 2^t lines, name the interval. All copies in an interval but the
first (by doc_id, then line) are later copies. Any longer repeated run is the union of such shortest runs, so deleting
these deletes every later copy of each maximal run.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_group, stage, table, workers_ready

MIN_WORDS = 50


def _ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """``keys`` (distinct) with ``rank``: increasing in the order of ``by``, from a range partitioning."""
    return stage(keys.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "rank", F.monotonically_increasing_id()), "ranks")


def _shortest_runs(min_words: int):
    """Sorted rows (row_key, doc_id, line, words) -> (row_key, doc_id, line, size): the shortest runs of adjacent lines
    with ``min_words`` words from each line on, and up to each line."""

    def run(batches):
        for t in by_group(batches, ["row_key"], 5000):
            key, doc, line, w = (t.column(c).to_numpy() for c in ("row_key", "doc_id", "line", "words"))
            cut = np.ones(len(key), bool)
            cut[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1] + 1)
            part = np.cumsum(cut) - 1
            last = np.append(np.flatnonzero(cut)[1:], len(key))[part]  # end of each line's part
            first = np.flatnonzero(cut)[part]
            upto = np.append(0, np.cumsum(w))
            here = np.arange(len(key))
            end = np.searchsorted(upto, upto[here] + min_words)  # first end with enough words
            a = np.stack([here, end])[:, end <= last]
            start = np.searchsorted(upto, upto[here + 1] - min_words, side="right") - 1
            ok = (start >= first) & (upto[here + 1] >= min_words)
            b = np.stack([start, here + 1])[:, ok]
            both = np.unique(np.concatenate([a, b], axis=1), axis=1)
            at, size = both[0], both[1] - both[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), pa.array(doc[at]), pa.array(line[at]), pa.array(size.astype(np.int32))],
                ["row_key", "doc_id", "line", "size"])

    return run


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """lines: row_key, doc_id, line (from 0), id (of the line's text), words -> row_key, a, b: runs of lines (b not
    included) of ``min_words`` or more words that are copies of a run at a smaller (doc_id, row_key, line)."""
    often = lines.groupBy("id").count().where("count > 1").select("id")
    often = _ranked(often, ["id"])
    items = stage(lines.join(often, "id").select("row_key", "doc_id", "line", "words", "rank"), "items")
    wanted = stage(items.select("row_key", "doc_id", "line", "words").repartition("row_key").sortWithinPartitions(
        "row_key", "line").mapInArrow(_shortest_runs(min_words), "row_key long, doc_id long, line int, size int"), "wanted")
    longest = wanted.agg(F.max("size")).first()[0] or 0
    level = items.select("row_key", "line", "rank")
    out, length = None, 1
    while length <= longest:
        here = wanted.where((F.col("size") >= length) & (F.col("size") < 2 * length))
        tail = level.select("row_key", (F.col("line") + length).alias("end"), F.col("rank").alias("tail"))
        run = here.withColumn("end", F.col("line") + F.col("size")).join(level, ["row_key", "line"]).join(
            tail, ["row_key", "end"])
        run = stage(run, "runs")
        place = F.struct("doc_id", "row_key", "line")
        firsts = run.groupBy("rank", "tail", "size").agg(F.min(place).alias("first"), F.count("*").alias("n")).where(
            "n > 1").drop("n")
        # staged, so that the join takes plain scans and Spark can split the partition of a hot run
        later = run.join(stage(firsts, "firsts"), ["rank", "tail", "size"]).where(place != F.col("first"))
        later = stage(later.select("row_key", F.col("line").alias("a"), F.col("end").alias("b")), "later")
        out = later if out is None else out.union(later)
        if 2 * length > longest:
            break
        after = level.select("row_key", (F.col("line") - length).alias("line"), F.col("rank").alias("next"))
        pair = stage(level.join(after, ["row_key", "line"]), "level")
        shared = pair.groupBy("rank", "next").count().where("count > 1").select("rank", "next")
        shared = _ranked(shared.toDF("first", "next"), ["first", "next"])
        level = stage(pair.withColumnRenamed("rank", "first").join(shared, ["first", "next"]).select(
            "row_key", "line", "rank"), "level")
        length *= 2
    return out if out is not None else wanted.select("row_key", F.col("line").alias("a"), F.col("size").alias("b"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with later copies of repeated line runs cut from the text, and n_lines, n_removed.

    A run is adjacent lines (between line feeds) with ``min_words`` words (cut at spaces) or more in all. Its first copy
    by (doc_id, line) stays. Null texts stay null with no lines, an empty text is one empty line; a null doc_id sorts
    first. Rows that repeat doc_id and text are one document and get the same result each. Input columns named n_lines
    or n_removed are replaced; an empty table gives an empty result.
    """
    workers_ready(docs.sparkSession)
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    key = F.xxhash64(ids, F.length(text_col), F.col(text_col))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # rows that repeat doc_id and text are one document: each of its lines comes once
    once = docs.select(key.alias("row_key"), ids.alias("doc_id"), F.col(text_col).alias("t")).dropDuplicates(["row_key"])
    lines = once.select("row_key", "doc_id", F.split("t", "\n").alias("ls")).select(
        "row_key", "doc_id", F.posexplode_outer("ls").alias("line", "t")).where("t is not null")
    words = F.length("t") - F.length(F.replace(F.col("t"), F.lit(" "), F.lit(""))) + (F.col("t") != "").cast("int")
    lines = lines.select("row_key", "doc_id", "line", F.xxhash64("t", F.octet_length("t")).alias("id"),
                         words.alias("words"))
    lines = stage(lines, "lines")
    gone = later_copies(lines, min_words).distinct().groupBy("row_key").agg(
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("gone"))
    both = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), key.alias("row_key")).join(gone, "row_key", "left")
    # line numbers that go, in order and without repeats
    numbers = F.array_distinct(F.flatten(F.transform("gone", lambda g: F.sequence(g["a"], g["b"] - 1))))
    both = both.select("row", numbers.alias("gone"))
    text = F.col("row")[text_col]
    # the one-element array binds the split lines, so that they are cut once; array_except hashes the numbers
    kept = F.transform(F.array(F.split(text, "\n")), lambda ls: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: F.get(ls, i)))[0]
    new = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    n = F.coalesce(F.size(F.split(text, "\n")), F.lit(0))
    n = F.when(text.isNull(), 0).otherwise(n)
    removed = F.coalesce(F.size("gone"), F.lit(0))
    return both.select(*[(new if c == text_col else F.col("row")[c]).alias(c) for c in columns],
                       n.cast("long").alias("n_lines"),
                       F.when(F.col("gone").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"))


def op8(spark, sf_dir) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")
