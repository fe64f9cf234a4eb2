"""Mixing sources to target weights by a time-varying curriculum (operator 7).

Targets: sources in code-point order (null last) have weights 5, 2, 1, repeating, and share
150 % of all words; a source gets at most twice its own words, and what is over goes to the
others by weight until none is above. In order of cap per weight, the capped sources are a
prefix, which prefix sums over the table of sources find in one pass.

Curriculum: over training time t in [0, 1] a source's weight is its target times
1 + c (2t - 1), with c = ``SLOPES`` in turn (later, even, earlier). The integral is the
source's demand, target * ((1 - c) t + c t^2). Documents of a source queue in hash order; the
words queued before a document, as a share of the target, are the demand at its position:
inverting the integral (a quadratic) gives its time. A second pass over the source continues
the queue. Documents are range-sorted by position.

A row's place in its source's queue is the MD5 of doc_id and text key. The queue's running
sums are taken in two steps, inside ranges of places of about ``BUCKET`` rows and over their
totals, so that no source is gathered in one task. DataFrame functions only.

Defined results: a null text has size 0; sizes of 0 take nothing; a null source is a source
of its own and sorts last; a document at the end of a target is taken in part (its words
count, so each source's taken words equal its rounded target); repeated rows queue one by
one; an empty table gives an empty result. Extra columns do not matter.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import doc_id_of, documents, save, text_key, text_of

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)
SHARE = 1.5
MAX_EPOCHS = 2
BUCKET = 256
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """rank, source, rows, source_size, target, slope: one row per source of ``sizes``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    turn = F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))).cast("int")
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1))
    per = per.withColumn("slope", F.element_at(F.array(*map(F.lit, SLOPES)), turn + 1))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(MAX_EPOCHS)))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    done = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("budget", F.sum("source_size").over(every) * F.lit(SHARE))
    # The level if all before are capped; a source is capped if its cap is under that level.
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(done), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    per = per.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    used = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(every)
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    shared = (F.col("budget") - used) * F.col("weight") / F.when(F.col("capped"), 1).otherwise(open_weight)
    return per.select("rank", "source", "rows", "source_size", "slope",
                      F.when(F.col("capped"), F.col("cap")).otherwise(shared).alias("target"))


def queue(sizes: DataFrame) -> DataFrame:
    """``sizes`` (doc_id, sha, source, size) with target, source_size, slope, before (words
    of the source queued before the row), first and second (words taken in each pass)."""
    sources = save(source_targets(sizes), "sources")
    named = sources.withColumnRenamed("source", "_source")
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("place", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.hex("sha")).cast("binary")))
    part = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    buckets = F.ceil(F.col("rows") / BUCKET)
    rows = save(rows.withColumn("bucket", F.floor(part * buckets / F.lit(1 << 32))).drop("_source"), "queue")
    totals = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = save(totals.select(F.col("rank").alias("_rank"), F.col("bucket").alias("_bucket"),
                                F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base")), "buckets")
    inside = (Window.partitionBy("rank", "bucket").orderBy("place", "doc_id", "sha", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(totals, (F.col("rank") == F.col("_rank")) & (F.col("bucket") == F.col("_bucket")))
    rows = rows.withColumn("before", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal = F.round("target").cast("long")
    part = lambda ahead: F.greatest(F.lit(0), F.least(F.col("size"), goal - ahead))
    return rows.withColumn("first", part(F.col("before"))).withColumn(
        "second", part(F.col("before") + F.col("source_size")))


def _time(queued, target, slope):
    """Time at which the source's demand reaches ``queued`` words: t of (1-c) t + c t^2 = x."""
    x = F.least(F.lit(1.0), queued / target)
    c = slope
    return 2 * x / ((1 - c) + F.sqrt((1 - c) * (1 - c) + 4 * c * x))


def sizes_of(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    return docs.select(doc_id_of(docs).alias("doc_id"), text_key(text).alias("sha"),
                       docs["source"].cast("string").alias("source"), size.alias("size"))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, position (training
    position of its first words, in words; null if none is taken), range-sorted by position."""
    rows = save(queue(save(sizes_of(docs), "sizes")), "mix")
    everything = rows.groupBy().agg(F.sum(F.col("first") + F.col("second")).alias("words"))
    words = everything.head()["words"] or 0
    when = _time(F.col("before").cast("double"), F.col("target"), F.col("slope")) * float(words)
    out = rows.select("doc_id", "size", "source_size", "target",
                      (F.col("first") + F.col("second")).alias("taken"), "slope", "before")
    taken = out.where("taken > 0").withColumn("position", when)
    rest = out.where("taken <= 0").withColumn("position", F.lit(None).cast("double"))
    taken = taken.orderBy("position", "doc_id")
    return taken.unionByName(rest).drop("slope", "before")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as mixed: a row for each pass in which at least half of its words are taken, in
    training order (range-sorted by the time that the curriculum gives the pass)."""
    key = ["doc_id", "sha", "source"]
    pass_at = lambda c, ahead: F.when((F.col("size") > 0) & (2 * F.col(c) >= F.col("size")),
                                      _time(ahead.cast("double"), F.col("target"), F.col("slope")))
    rows = queue(save(sizes_of(docs), "sizes"))
    rows = save(rows.select(*key, F.array_compact(F.array(
        pass_at("first", F.col("before")),
        pass_at("second", F.col("before") + F.col("source_size")))).alias("times")), "mix")
    # Rows alike in all of the key stand for each other; the times of a row of its own come with it.
    told = save(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("times")).alias("passes"),
                                       F.max("times").alias("times")).where("passes > 0"), "passes")
    told = told.select(*[F.col(c).alias(f"_{c}") for c in [*key, "rows", "times"]])
    alike = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), doc_id_of(docs).alias("doc_id"),
                         text_key(text_of(docs)).alias("sha"), docs["source"].cast("string").alias("source"))
    found = packed.join(told, alike)
    one = found.where("_rows = 1").select("row", *key, F.explode("_times").alias("time"))
    again = rows.join(told.where("_rows > 1"), alike, "left_semi").select(
        *[F.col(c).alias(f"_{c}") for c in key], F.explode("times").alias("time"))
    many = found.where("_rows > 1").groupBy(*key).agg(F.first("row").alias("row"))
    many = many.join(again, alike).select("row", *key, "time")
    return one.unionByName(many).orderBy("time", "doc_id", "sha").select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', CAST(doc_id AS VARCHAR), upper(md5(coalesce(text, ''))))) AS place FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         CASE (rank - 1) % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0::DOUBLE ELSE -0.5::DOUBLE END AS c,
         source_size * 2.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM s),
l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
k AS (SELECT *, cap <= level * weight AS capped FROM l),
t AS (
  SELECT source, rank, source_size, c,
         CASE WHEN capped THEN cap
              ELSE (budget - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) * weight
                   / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target FROM k),
q AS (
  SELECT d.*, t.source_size, t.target, t.c, CAST(round(t.target) AS BIGINT) AS goal,
         CAST(coalesce(sum(size) OVER (PARTITION BY t.rank ORDER BY place, doc_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, greatest(0, least(size, goal - before)) + greatest(0, least(size, goal - before - source_size)) AS taken FROM q),
x AS (SELECT *, least(1.0::DOUBLE, before / target) AS share, CAST(sum(taken) OVER () AS DOUBLE) AS words FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0
            THEN 2 * share / ((1 - c) + sqrt((1 - c) * (1 - c) + 4 * c * share)) * words END AS position
FROM x
"""


def op7_source_mixing(spark, sf_dir):
    """Query: sizes, targets, words taken and positions of all documents."""
    return mix(documents(spark, sf_dir))
