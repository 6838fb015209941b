"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

1. Document frequency. The terms of the benchmark are counted over all training tokens.
2. A window is ten consecutive item words (a shorter item is one window). Its two rarest terms are its test terms; many
   windows of an item share them, so a pair of places (p1, p2) in the item stands for all of those.
3. Index. Every training token that is a test term is stored: term, document, position, and the nine words on either
   side. An entry with the empty term holds the document's number of words.
4. The list of the rarer term is read for each pair, and the list of the other term is intersected with it at the offset
   p2 - p1. Places at the exact offset become phrase matches if the words around them agree over a whole window; places
   up to ``slop`` words off are proximity matches.

Tables made from the benchmark are broadcast only up to a counted number of rows; beyond it the terms are dealt into
blocks of that size, and the documents are read once for each block.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, broadcast_if_small, stage, table

WINDOW = 10
SLOP = 3
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text in order; no words for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), _SEPARATORS), ""), F.array().cast("array<string>"))


def _tokens(docs: DataFrame) -> DataFrame:
    # The last entry holds the number of words; an outer generator keeps Spark from testing the split text twice.
    return docs.select("doc", F.array_append(words(F.col("text")), F.lit("")).alias("w")).select(
        "doc", "w", F.posexplode_outer("w").alias("pos", "term"))


def _in_blocks(tokens: DataFrame, terms: DataFrame) -> list[DataFrame]:
    """``tokens`` whose term is in ``terms`` (distinct), by broadcast blocks of bounded size."""
    n = terms.count()
    blocks = -(-n // BROADCAST_ROWS) or 1
    if blocks == 1:
        return [tokens.join(F.broadcast(terms), "term")]
    block = F.pmod(F.xxhash64("term"), F.lit(2 * blocks))  # about half full each; one over the bound is not broadcast
    return [tokens.join(broadcast_if_small(terms.where(block == b), BROADCAST_ROWS), "term") for b in range(2 * blocks)]


def test_pairs(items: DataFrame, counts: DataFrame) -> DataFrame:
    """item_id, p1, t1, p2, t2, least (words of a whole window), left and right (item words around p1, outwards).
    t2 is null where an item has a single word."""
    per = items.select("item_id", "w", F.size("w").alias("n"), F.posexplode("w").alias("p", "term"))
    per = per.join(broadcast_if_small(counts), "term", "left").select(
        "item_id", "w", "n", "p", F.struct(F.coalesce("c", F.lit(0)).alias("c"), "p", "term").alias("e"))
    over = Window.partitionBy("item_id", "w").orderBy("p").rowsBetween(0, WINDOW - 1)
    least = F.least("n", F.lit(WINDOW))
    wins = per.withColumn("es", F.array_sort(F.collect_list("e").over(over))).where(F.size("es") == least)
    a, b = F.get("es", F.lit(0)), F.get("es", F.lit(1))
    pairs = wins.select("item_id", "w", least.alias("least"), a["p"].alias("p1"), a["term"].alias("t1"),
                        b["p"].alias("p2"), b["term"].alias("t2")).distinct()
    return pairs.select("item_id", "p1", "t1", "p2", "t2", "least", *_around(F.col("w"), F.col("p1")))


def _around(w: Column, p: Column) -> list[Column]:
    k = WINDOW - 1
    first = F.greatest(p - k, F.lit(0))
    return [F.reverse(F.slice(w, first + 1, p - first)).alias("left"), F.slice(w, p + 2, F.lit(k)).alias("right")]


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (doc, term, pos, left, right) of ``terms`` and, under the empty term, of document lengths."""
    out = None
    ending = terms.sparkSession.createDataFrame([("",)], "term string")
    for part in _in_blocks(_tokens(docs), terms.union(ending)):
        part = part.select("doc", "term", "pos", *_around(F.col("w"), F.col("pos")))
        out = part if out is None else out.union(part)
    return stage(out, "postings")


def _agreeing(x: Column, y: Column) -> Column:
    """Equal words from the start of two lists."""
    same = F.zip_with(x, y, lambda a, b: a.eqNullSafe(b))
    miss = F.array_position(same, False)
    return F.when(miss == 0, F.size(same)).otherwise(miss - 1).cast("int")


def matches(index: DataFrame, pairs: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc, item_id, a, b (document words a to b, b not included), exact. Exact rows cover every occurrence of a whole
    window; the others are places where the two rarest terms of a window are up to ``slop`` words off."""
    lists = index.where("term <> ''")
    first = lists.select("doc", F.col("term").alias("t1"), F.col("pos").alias("q"), F.col("left").alias("dl"),
                         F.col("right").alias("dr")).join(broadcast_if_small(pairs), "t1")
    own = _agreeing(F.col("dl"), F.col("left")), _agreeing(F.col("dr"), F.col("right"))
    first = first.select("doc", "item_id", "q", "t2", (F.col("q") + F.col("p2") - F.col("p1")).alias("at"),
                         "least", own[0].alias("l"), own[1].alias("r"))
    single = first.where("t2 is null").withColumn("off", F.lit(0)).drop("t2", "at")
    width = 2 * slop + 1
    bins = F.sequence(F.floor((F.col("at") - slop) / width), F.floor((F.col("at") + slop) / width))
    second = lists.select("doc", F.col("term").alias("t2"), F.col("pos").alias("q2"),
                          F.floor(F.col("pos") / width).alias("bin"))
    both = first.where("t2 is not null").withColumn("bin", F.explode(bins)).join(second, ["doc", "t2", "bin"])
    both = both.withColumn("off", F.col("q2") - F.col("at")).where(F.abs("off") <= slop)
    both = both.select("doc", "item_id", "q", "least", "l", "r", "off")
    found = both.unionByName(single).withColumn("exact", (F.col("off") == 0) & (F.col("l") + F.col("r") + 1 >= F.col("least")))
    return found.select("doc", "item_id", "exact", F.when(F.col("exact"), F.col("q") - F.col("l")).otherwise(F.col("q")).alias("a"),
                        F.when(F.col("exact"), F.col("q") + F.col("r") + 1).otherwise(F.col("q") + 1).alias("b"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", slop: int = SLOP) -> DataFrame:
    """One row per input row: doc_id, row_key, n_words, n_hit (words inside occurrences of whole windows), items (sorted
    ids, as strings, of the items with occurring windows), near_items (of those with proximity matches only), ranges.

    Null and empty texts have no words and no hits; items without words or with a null id take no part; items that
    repeat count once. Rows that repeat doc_id and text get the same result each. Other columns are ignored; an empty
    benchmark gives no hits, an empty table an empty result.
    """
    ids, text = F.col(id_col).cast("long"), F.col(text_col)
    docs = docs.select(F.struct(ids.alias("doc_id"), F.xxhash64(ids, F.length(text), text).alias("row_key")).alias("doc"),
                       text.alias("text"))
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w")).distinct()
    items = stage(items, "items")
    vocabulary = items.select(F.explode("w").alias("term")).distinct()
    tokens = docs.select(F.explode_outer(words(F.col("text"))).alias("term"))
    counts = None
    for part in _in_blocks(tokens, vocabulary):
        counts = part if counts is None else counts.union(part)
    counts = stage(counts.groupBy("term").agg(F.count("*").alias("c")), "counts")
    pairs = stage(test_pairs(items, counts), "pairs")
    terms = pairs.select(F.col("t1").alias("term")).union(pairs.select("t2")).where("term is not null").distinct()
    index = build_index(docs, terms)
    ends = index.where("term = ''").select("doc", F.col("pos").cast("long").alias("n_words"))
    found = matches(index, pairs, slop)
    found = found.groupBy("doc.row_key").agg(
        F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string"))).alias("items"),
        F.collect_set(F.when(~F.col("exact"), F.col("item_id").cast("string"))).alias("near"),
        F.collect_set(F.when(F.col("exact"), F.struct("a", "b"))).alias("ranges"))
    out = ends.select("doc.*", "n_words").join(found, "row_key", "left")
    none = F.array().cast("array<string>")
    covered = F.aggregate(
        F.array_sort("ranges"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, r: F.struct(F.greatest(s["end"], r["b"]).alias("end"),
                              (s["n"] + F.greatest(r["b"] - F.greatest(s["end"], r["a"]), F.lit(0))).alias("n")))["n"]
    return out.select("doc_id", "row_key", "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.array_sort("items"), none).alias("items"),
                      F.coalesce(F.array_except("near", "items"), none).alias("near_items"), "ranges")


def op3(spark, sf_dir) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"),
                      F.array_join(F.array_sort("near_items"), ",").alias("near_items"))


_SQL_WORDS = (r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS.format('text')}, []) AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_SQL_WORDS.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS key
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS key
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
             FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, s, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.key = iw.key),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id),
iu AS (SELECT item_id, row_number() OVER () AS u, w FROM i WHERE len(w) > 0),
ip AS (SELECT item_id, u, len(w) AS n, unnest(w) AS term, unnest(range(len(w))) AS p FROM iu),
dp AS (SELECT doc_id, term, p FROM (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS p FROM d)
       WHERE term IN (SELECT term FROM ip)),
c AS (SELECT term, count(*) AS c FROM dp GROUP BY term),
e AS (SELECT a.item_id, a.u, s, p, term, row_number() OVER (PARTITION BY a.u, s ORDER BY coalesce(c, 0), p) AS r
      FROM (SELECT item_id, u, unnest(range(greatest(len(w) - 9, 1))) AS s FROM iu) a
      JOIN ip ON ip.u = a.u AND p BETWEEN s AND s + 9 LEFT JOIN c USING (term)),
pr AS (SELECT DISTINCT x.item_id, x.term AS t1, y.term AS t2, y.p - x.p AS gap
       FROM e x JOIN e y ON x.u = y.u AND x.s = y.s AND x.r = 1 AND y.r = 2),
nr AS (SELECT doc_id, count(*) AS n_near, string_agg(x, ',' ORDER BY x) AS near
       FROM (SELECT x.doc_id, item_id::VARCHAR AS x FROM pr JOIN dp x ON x.term = t1
             JOIN dp y ON y.doc_id = x.doc_id AND y.term = t2 AND abs(y.p - x.p - gap) <= {SLOP}
             EXCEPT SELECT doc_id, item_id::VARCHAR FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near, coalesce(near, '') AS near_items
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id LEFT JOIN nr ON nr.doc_id = d.doc_id
"""
