"""SimHash near-duplicates (operator 1).

Fingerprints: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, 4-word shingles
(repeats included, joined by a space; fewer words: the whole sequence), XXH64 with seed 42;
a bit is 1 if set in over half of the hashes; no word: zero. Two fingerprints link at 4 or
fewer differing bits.

Search, on distinct fingerprints only (exact copies meet there): a byte-position inverted
index with count filtering. Four bits differ in at most four of the eight bytes, so linked
fingerprints share at least four positional bytes. Posting lists of single positional bytes
hold 1/256 of all rows and would be paired quadratically; the postings are therefore kept
by three positional bytes at once, for the 20 triples of positions of which every four
positions contain one (``TRIPLES``): each pair with four shared bytes meets in some list.
For pairs that meet, shared positional bytes are tallied, pairs below the guaranteed four
are dropped, and the bit distance of the rest is verified.

A list is searched breadth-first, emitting a spanning forest of its links (fewer links than
members) instead of its pairs. Lists longer than ``TILE`` are cut into chunks, and each pair
of chunks is a task of its own, so that no list is gathered whole. Components of the links
come from ``components``.

Defined results: a null text is empty; a document without a word has fingerprint zero and
links like any other; rows with equal fingerprints are one component; component_id is the
smallest doc_id of the component (nulls aside; null if it has none but nulls); repeated rows
come back as often as they came; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import (doc_id_of, documents, repeat_rows, save, ship, sorted_groups, spread,
                   text_key, text_of)
from .components import component_labels

SHINGLE = 4
MAX_BITS = 4
MIN_SHARED = 4
TILE = 2048
#: Byte positions 0-7 in three parts; a triple lies in one part, or two of it in one part and
#: one in the next: every four positions contain such a triple.
PARTS = ((0, 1, 2), (3, 4, 5), (6, 7))
TRIPLES = [t for t in ((a, b, c) for a in range(8) for b in range(a + 1, 8) for c in range(b + 1, 8))
           if sorted(sum(p in part for p in t) for part in PARTS) == [0, 0, 3]
           or any(sum(p in PARTS[i] for p in t) == 2 and sum(p in PARTS[(i + 1) % 3] for p in t) == 1
                  for i in range(3))]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    first, last = start[:n].tolist(), end[-n:].tolist()
    ones, step = np.zeros(64, np.int64), 1 << 15
    for at in range(0, n, step):
        h = [xxhash.xxh64_intdigest(joined[a:b], 42)
             for a, b in zip(first[at:at + step], last[at:at + step])]
        bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, sha (of the text, to tell rows apart) and fp (signed long) of every row."""
    def work(batches):
        for batch in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fp, np.uint64).view(np.int64))],
                ["doc_id", "sha", "fp"])

    text = text_of(docs)
    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_key(text).alias("sha"),
                       text.cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id long, sha binary, fp long")


def forest(fps: np.ndarray, max_bits: int = MAX_BITS, min_shared: int = MIN_SHARED):
    """Links (a, b) that span the components among distinct fingerprints (uint64)."""
    left, one, two = np.arange(len(fps)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            v = queue.pop()
            differ = fps[left] ^ fps[v]
            shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            found = (shared >= min_shared) & (np.bitwise_count(differ) <= max_bits)
            if found.any():
                near, left = left[found], left[~found]
                one.append(np.repeat(fps[v], len(near)))
                two.append(fps[near])
                queue.extend(near.tolist())
    none = np.zeros(0, np.uint64)
    return (np.concatenate(one), np.concatenate(two)) if one else (none, none)


def links(fps: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links (a, b) spanning the components of distinct fingerprints (``fp``, long)."""
    least = 8 - max_bits
    assert least >= MIN_SHARED, "the triples cover four shared positions or more"
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long"))
    codes = [F.lit(i << 24).cast("long") + byte(a) * 65536 + byte(b) * 256 + byte(c)
             for i, (a, b, c) in enumerate(TRIPLES)]
    posted = fps.select(F.explode(F.array(*codes)).alias("list"), "fp")
    size = posted.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = posted.join(size.withColumnRenamed("list", "_list"), F.col("list") == F.col("_list"))
    # A list of up to one tile is one task's; beyond, a row goes to each pair of its chunk.
    chunks = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), chunks - 1), lambda o: F.least(o, mine) * chunks + F.greatest(o, mine))
    tiled = spread(met.select("list", F.explode(pairs).alias("tile"), "fp"), "list", "tile")

    def work(batches):
        for rows in sorted_groups(batches, 2):
            a, b = forest(rows.column(2).to_numpy().view(np.uint64), max_bits, least)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return tiled.mapInArrow(work, "a long, b long")


def labelled(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, label) of the fingerprints that link to others."""
    distinct = save(rows.select("fp").distinct(), "fingerprints")
    return component_labels(links(distinct, max_bits)).select(F.col("node").alias("fp"), "label")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    rows = save(fingerprints(docs, shingle).select("doc_id", "fp"), "simhash")
    labels = labelled(rows, max_bits)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = save(least.join(labels, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "least"),
                 "classes")
    # Written first: a join of two tables can have its skewed partitions split.
    ids = save(least.groupBy(F.col("label").alias("_label")).agg(F.min("least").alias("component_id")), "components")
    ids = save(least.join(ids, F.col("label") == F.col("_label")).select(F.col("fp").alias("_fp"), "component_id"), "ids")
    return rows.join(ids, F.col("fp") == F.col("_fp"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest doc_id (null last),
    then of the smallest md5 of its text; of rows alike in both, one. All columns kept."""
    rows = save(fingerprints(docs, shingle), "simhash")
    labels = labelled(rows, max_bits)
    kinds = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"),
                                   F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "sha")).alias("best"))
    kinds = save(kinds.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "classes")
    best = save(kinds.groupBy(F.col("label").alias("_label")).agg(F.sum("n").alias("size"), F.min("best").alias("best"))
                .where("size > 1"), "components")
    multi = save(kinds.select("label", "fp").join(best, F.col("label") == F.col("_label")).select(
        "fp", F.col("best.doc_id").alias("b_id"), F.col("best.sha").alias("b_sha")), "kept")
    stays = F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("sha") == F.col("b_sha"))
    told = rows.join(multi.withColumnRenamed("fp", "_fp"), F.col("fp") == F.col("_fp"), "left")
    # Of a component one row stays; of a row alone in its component (rows = 1), that row.
    told = told.select("doc_id", "sha", F.when(F.col("_fp").isNull() | stays, 1).otherwise(0).alias("copies"))
    told = told.groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("rows"), F.max("copies").alias("copies"))
    return repeat_rows(docs, save(told, "decisions"))


def op1_simhash(spark, sf_dir):
    """Query: fingerprints and components of all documents."""
    return near_duplicates(documents(spark, sf_dir))


ship(__name__)
