"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

The mean number of copies of a source's documents is rate = total * weight / documents of the source. Each document
draws its number of copies by inverting the Poisson distribution of that mean at a hash of (seed, row name), so a draw
does not depend on partitions or on other rows. A mean above ``PART`` is split into equal parts, each with a hash of its
own, and the draws are added (a sum of Poisson variables is one). Copies are shuffled by a hash of (seed, row name, copy).

A row's name is its doc_id, source and text (hashed) and its number, from 1, among the rows equal in these, so that rows
with a null or repeated id draw each for itself. Only rows that have equals are numbered, by partitions of the table
written for it: a partition's own numbers start behind the counts of those before it, so a hot row is many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage, table

SEED = 20240501
#: Largest mean that is inverted at once, and the entries of its distribution: beyond them the tail is under 1e-40.
PART, ENTRIES = 16.0, 128
#: Partitions of the skewed side where the rates are too many for a broadcast.
SALT = 64


def _uniform(*parts: Column) -> Column:
    """48 hash bits as a number in [0, 1)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def _distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ..."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ENTRIES)), start, lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"),
            F.array_append(s["cdf"], F.element_at(s["cdf"], -1) + s["p"] * mean / k).alias("cdf")))["cdf"]


def rates(docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source",
          total: int | None = None) -> DataFrame:
    """source, n, rate, parts, cdf. ``weights``: target shares by source (scaled to one; sources not named get none);
    None: equal shares. ``total``: expected documents out; None: as many as in. A null source is a source."""
    n = stage(docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n")), "sources")
    one = n.agg(F.sum("n").cast("double").alias("n"), F.count("*").cast("double").alias("k")).first()
    size = float(total) if total is not None else one["n"] or 0.0
    if weights is None:
        share = F.lit(1.0) / F.lit(one["k"] or 1.0)
    else:
        known = n.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, w double")
        n = n.join(broadcast_if_small(known), "source", "left")
        share = F.coalesce("w", F.lit(0.0)) / F.lit(sum(weights.values()))
    rate = F.lit(size) * share / F.col("n")
    parts = F.greatest(F.ceil(rate / PART), F.lit(1)).cast("int")
    out = n.select("source", "n", rate.alias("rate"), parts.alias("parts"))
    return stage(out.withColumn("cdf", _distribution(F.col("rate") / F.col("parts"))), "rates")


def _name(doc_id: Column, source: Column, text: Column) -> Column:
    """doc_id, source and text hash as one string; nulls are told apart from empty strings."""
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.md5(text.cast("binary")), F.lit("-")),
                       F.coalesce(F.md5(source.cast("string").cast("binary")), F.lit("-")))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``id``: the row's name and its number among the rows of that name. Rows equal in their names may
    take the numbers in any order."""
    repeated = stage(rows.groupBy("name").count().where("count > 1").select("name"), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("id", F.concat_ws("|", "name", F.lit("1"))).drop("name")
    once = rows.join(broadcast_if_small(repeated), "name", "left_anti").withColumn("n", F.lit(1).cast("long"))
    many = stage(rows.join(broadcast_if_small(repeated), "name", "left_semi").withColumn(
        "m", F.monotonically_increasing_id()), "many").withColumn("p", F.shiftright("m", 33))
    sizes = stage(many.groupBy("name", "p").agg(F.count("*").alias("c")), "sizes")  # a row for each name and partition
    up_to = Window.partitionBy("name").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("name", "p", F.coalesce(F.sum("c").over(up_to), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("name", "p").orderBy("m"))
    many = many.withColumn("own", own).join(before, ["name", "p"]).withColumn("n", F.col("before") + F.col("own"))
    both = once.unionByName(many.select(*once.columns))
    return both.withColumn("id", F.concat_ws("|", "name", F.col("n").cast("string"))).drop("name", "n")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and rate, copies, replica (from 1), shuffle_key: a row for each copy, dealt out and
    ordered by shuffle_key within each partition. Those four replace input columns of the same name.

    Null sources are one source. Rows with a null or repeated doc_id, and equal rows, draw each for itself. Null texts are
    copied like any other; an empty table gives an empty result.
    """
    r = rates(docs, weights, source_col, total)
    own = ["rate", "copies", "replica", "shuffle_key"]
    columns = [c for c in docs.columns if c not in own]
    small = broadcast_if_small(r)
    row = _numbered(docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), F.col(source_col).alias("s"),
                                _name(F.col(id_col), F.col(source_col), F.col(text_col)).alias("name")))
    if small is r:  # many sources: a hot one is dealt over SALT partitions
        row = row.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int"))
        r = r.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        row = row.join(r, F.col("s").eqNullSafe(F.col("source")) & (row["salt"] == r["salt"]))
    else:
        row = row.join(small, F.col("s").eqNullSafe(F.col("source")))
    def draw(j):
        return F.size(F.filter("cdf", lambda c: c <= _uniform(F.lit(str(seed)), F.col("id"), j.cast("string"))))

    first = F.expr("size(filter(cdf, c -> c <= u))")
    row = row.withColumn("u", _uniform(F.lit(str(seed)), F.col("id"), F.lit("1")))
    more = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda a, j: a + draw(j))
    row = row.withColumn("copies", F.when(F.col("parts") == 1, first).otherwise(more)).where("copies > 0")
    row = row.select("row", "id", "rate", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("replica"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id"), F.lit("copy"), F.col("replica").cast("string")))
    out = row.select("row.*", "rate", "copies", "replica", key.alias("shuffle_key"))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op4(spark, sf_dir) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL = f"""
WITH RECURSIVE s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n)::DOUBLE AS total, count(*)::DOUBLE AS k FROM s),
r AS (SELECT source, n, (total * (1.0::DOUBLE / k)) / n AS rate FROM s, t),
q AS (SELECT source, rate, greatest(ceil(rate / {PART}), 1)::INTEGER AS parts FROM r),
c AS (SELECT source, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS f FROM q
      UNION ALL
      SELECT c.source, c.k + 1, c.p * (q.rate / q.parts) / (c.k + 1), c.f + c.p * (q.rate / q.parts) / (c.k + 1)
      FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source WHERE c.k < {ENTRIES}),
d AS (SELECT *, concat_ws('|', coalesce(doc_id::VARCHAR, '-'), coalesce(md5(text), '-'), coalesce(md5(source), '-'),
                        row_number() OVER (PARTITION BY doc_id, source, text)) AS id FROM documents),
u AS (SELECT d.*, q.rate, q.parts, unnest(range(1, q.parts + 1)) AS j
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
v AS (SELECT *, ('0x' || substr(md5('{SEED}|' || id || '|' || j), 1, 12))::BIGINT / {float(1 << 48)}::DOUBLE AS u FROM u),
m AS (SELECT v.doc_id, v.text, v.lang, v.source, v.n_chars, v.rate, v.id, v.j,
             (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM v.source AND c.f <= v.u) AS x FROM v),
g AS (SELECT doc_id, text, lang, source, n_chars, rate, id, sum(x)::INTEGER AS copies
      FROM m GROUP BY doc_id, text, lang, source, n_chars, rate, id)
SELECT doc_id, text, lang, source, n_chars, rate, copies, replica,
       md5('{SEED}|' || id || '|copy|' || replica) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1))::INTEGER AS replica FROM g WHERE copies > 0)
"""
