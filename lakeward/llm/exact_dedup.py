"""Exact de-duplication by two-pass Bloom filtering (operator 10).

Texts are equal when identical after deleting the characters of [\\x20\\x09-\\x0D]. Each text
is reduced to the SHA-256 of what remains.

Pass 1 gives every row ``PROBES`` bit positions of a Bloom filter and finds the bits that
more than one row sets: a partial count per position inside each task, so that a text held
by a third of all rows sends a few rows per task. These bits, packed into bitmaps of 32,768,
are the filter. Pass 2 tests every row: only rows all of whose bits were set more than once
may be repeated, and only those shuffle by hash, where whole digests are compared. All
others pass straight through. A false positive costs a shuffled row and changes no result.

The filter has ``BITS_PER_ROW`` bits a row, up to ``MAX_FILTER_BITS`` (64 MB, what may be
broadcast); beyond, it lets more rows through to the shuffle and results stay the same.

Defined results: a null text is empty; empty texts are equal to each other and to texts of
white space only; of equal texts the row with the most code points in its original text
stays, then the smallest doc_id (null last); of rows that tie in both, exactly one stays;
an empty table gives an empty result. Extra columns do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import BLANKS, doc_id_of, save, text_of

PROBES = 3
BITS_PER_ROW = 8
BITMAP_BITS = 32768
MAX_FILTER_BITS = 1 << 29


def normal_digest(text: Column) -> Column:
    """SHA-256 (hex) of the text without its white space."""
    return F.sha2(F.translate(text, BLANKS, ""), 256)


def _positions(sha: Column, bits: int) -> list[Column]:
    """Bit positions of a digest (hex), from separate parts of it."""
    parts = [F.conv(F.substring(sha, 1 + 12 * i, 12), 16, 10).cast("long") for i in range(PROBES)]
    return [p % F.lit(bits) for p in parts]


def repeated_bits(digests: DataFrame, sha: str, bits: int) -> DataFrame:
    """Pass 1: bitmaps (number, bitmap) of the filter bits that several rows set."""
    hits = (digests.select(F.explode(F.array(*_positions(F.col(sha), bits))).alias("bit"))
            .groupBy("bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return (hits.groupBy(F.expr("bit div 32768").alias("number"))
            .agg(F.expr("bitmap_construct_agg(bit % 32768)").alias("bitmap")))


def _with_filter(df: DataFrame, sha: Column, maps: DataFrame, bits: int) -> DataFrame:
    """``df`` with the boolean ``_maybe``: all bits of the row's digest were set repeatedly.
    ``maps`` has at most MAX_FILTER_BITS bits in all, so it may be broadcast."""
    test = F.lit(True)
    for i, pos in enumerate(_positions(sha, bits)):
        df = df.withColumn(f"_pos{i}", pos)
        one = maps.select(F.col("number").alias(f"_num{i}"), F.col("bitmap").alias(f"_map{i}"))
        df = df.join(F.broadcast(one), F.expr(f"_pos{i} div 32768") == F.col(f"_num{i}"), "left")
        byte = F.conv(F.hex(F.expr(f"substring(_map{i}, cast((_pos{i} % 32768) div 8 as int) + 1, 1)")),
                      16, 10).cast("int")
        bit = F.expr(f"shiftleft(1, cast(_pos{i} % 8 as int))")
        test = test & F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))
    df = df.withColumn("_maybe", test)
    return df.drop(*[f"{p}{i}" for p in ("_pos", "_num", "_map") for i in range(PROBES)])


def filter_bits(rows: int) -> int:
    """Bits of the filter for so many rows."""
    whole = -(-max(rows, 1) * BITS_PER_ROW // BITMAP_BITS) * BITMAP_BITS
    return min(whole, MAX_FILTER_BITS)


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_points (code points of the original text), sha (hex) of every row."""
    text = text_of(docs)
    return docs.select(doc_id_of(docs).alias("doc_id"), F.length(text).alias("n_points"),
                       normal_digest(text).alias("sha"))


def _rank(points: Column, doc_id: Column) -> Column:
    """Greatest for the row that stays (~doc_id falls as doc_id rises; null is least)."""
    return F.struct(points.alias("p"), F.bitwise_not(doc_id).alias("d"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = save(digest_rows(docs), "digests")
    bits = filter_bits(rows.count())
    maps = save(repeated_bits(rows, "sha", bits), "bloom")
    tested = _with_filter(rows, F.col("sha"), maps, bits)
    alone = tested.where("not _maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    # Rows alike in all that is compared count as one until the end.
    kinds = save(tested.where("_maybe").groupBy("sha", "doc_id", "n_points")
                 .agg(F.count(F.lit(1)).alias("n")), "candidates")
    best = save(kinds.groupBy("sha").agg(
        F.max(_rank(F.col("n_points"), F.col("doc_id"))).alias("best"),
        F.sum("n").alias("group_size")), "groups")
    joined = kinds.join(best.withColumnRenamed("sha", "_sha"), F.col("sha") == F.col("_sha"))
    first = (F.col("n_points") == F.col("best.p")) & F.bitwise_not("doc_id").eqNullSafe(F.col("best.d"))
    maybe = joined.select(
        "doc_id", F.bitwise_not("best.d").alias("keep_id"), "group_size", first.alias("first"),
        F.col("sha").alias("text_sha256"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    maybe = maybe.select("doc_id", "keep_id", "group_size",
                         (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    return alone.unionByName(maybe)


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept. Possibly
    repeated rows are reduced to one per digest inside each task before they shuffle."""
    rows = save(digest_rows(docs).select("sha"), "digests")
    bits = filter_bits(rows.count())
    maps = save(repeated_bits(rows, "sha", bits), "bloom")
    text = text_of(docs)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                         normal_digest(text).alias("_sha"),
                         _rank(F.length(text), doc_id_of(docs)).alias("_rank"))
    tested = _with_filter(packed, F.col("_sha"), maps, bits)
    alone = tested.where("not _maybe").select("row")
    kept = tested.where("_maybe").groupBy("_sha").agg(F.max_by("row", "_rank").alias("row")).select("row")
    return alone.unionByName(kept).select("row.*")


def op10_exact_dedup(spark, sf_dir):
    """Query: groups of equal texts over all documents."""
    from .base import documents
    return exact_groups(documents(spark, sf_dir))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS sha
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY sha ORDER BY n_points DESC, doc_id ASC NULLS LAST) AS k,
         first_value(doc_id) OVER (PARTITION BY sha ORDER BY n_points DESC, doc_id ASC NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY sha) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha AS text_sha256 FROM r
"""
