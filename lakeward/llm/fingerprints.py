"""Document fingerprints by one-permutation MinHash (operator 12).

A text's shingles (five words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words: the whole
sequence) are hashed once. The hash's top bits name one of ``BINS`` bins, the rest is its value,
and a bin keeps its least value. Empty bins are filled by optimal densification: each bin has an
order of all bins of its own (the first visits of a random probe sequence) and takes the value of
the first one that is not empty. A bin's code is the low ``BITS`` bits of its value hashed with
the bin's number, so that bins filled from one value agree by chance independently; codes are
packed, two a byte.

Likeness of two fingerprints estimates the share of common shingles: equal codes come with
probability J + (1 - J) / 2^BITS, which is solved for J and cut to 0..1. Its standard error is at
most 0.024 (J = 0.5, 512 bins, 4 bits).

Next documents: rows are range-sorted by doc_id, descending (null last; rows of one doc_id by
text key), and each task walks its rows with the one before in hand. The first and last row of
each task come out whole; the few pairs that lie across two tasks are met in a second step. Rows
of a doc_id that more than ``HOT`` rows hold are first reduced to one per text and counted.

Defined results: a null text is empty; texts without a word have the fingerprint zero, alike to
each other (1) and to no other text (0); of rows alike in doc_id and text, one is followed by the
next row, the others by their own text; the only document of a table follows itself; bytes that
are no UTF-8 count as one code point each; an empty table gives an empty result. Extra columns do
not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import doc_id_of, documents, save, ship, text_key, text_of

SHINGLE = 5
BINS = 512
BITS = 4
#: Bytes of text hashed at a time (longer texts in pieces), and texts at a time.
PIECE = 1 << 22
TEXTS = 512
#: A doc_id with more rows is reduced to one row per text before rows are sorted.
HOT = 1000
#: Such doc_ids that may be broadcast.
BROADCAST_IDS = 100_000

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_LOW = _powers(_BASE, 1 << 12)
_STEP = pow(_BASE, 1 << 12, 1 << 64)
#: Lower-case byte + 1 by byte; 0 for white space.
_LETTER = np.array([0 if b == 32 or 9 <= b <= 13 else (b + 32 if 65 <= b <= 90 else b) + 1 for b in range(256)], np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of ``data``."""
    letter = _LETTER[np.frombuffer(data, np.uint8)]
    word = letter > 0
    start = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    if not len(start):
        return np.zeros(0, np.uint64), start
    span = np.diff(start, append=len(data))
    place = np.arange(len(data) - start[0]) - np.repeat(start - start[0], span)
    power = _LOW[place & 0xFFF]
    if place.max() > 0xFFF:
        power = power * _powers(_STEP, int(place.max() >> 12) + 1)[place >> 12]
    return mix(np.add.reduceat(letter[start[0]:] * power, start - start[0])), start


def _pieces(texts: list[bytes]):
    """(numbers of texts, their bytes joined by blanks, where each begins): several short texts, or
    a part of a long one, cut at white space."""
    some, size = [], 0
    for i, t in enumerate(texts):
        if some and (size + len(t) > PIECE or len(some) == TEXTS):
            yield some, [texts[k] for k in some]
            some, size = [], 0
        if len(t) > PIECE:
            at = 0
            while at < len(t):
                cut = _BLANK.search(t, min(at + PIECE, len(t)))
                end = cut.start() if cut else len(t)
                yield [i], [t[at:end]]
                at = end
        else:
            some.append(i)
            size += len(t)
    if some:
        yield some, [texts[k] for k in some]


def words_of(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for numbers, own in _pieces(texts):
        hashes, start = word_hashes(b" ".join(own))
        begin = np.cumsum([0] + [len(t) + 1 for t in own[:-1]])
        cuts = np.searchsorted(start, begin[1:])
        for i, part in zip(numbers, np.split(hashes, cuts)):
            out[i].append(part)
    return [p[0] if len(p) == 1 else np.concatenate(p) if p else np.zeros(0, np.uint64) for p in out]


def shingle_hashes(words: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's shingles (of the whole sequence, if shorter)."""
    size = min(shingle, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _U(0xD1B54A32D192ED03) + words[k:k + n]
    return mix(total + _U(size))


def _orders(bins: int) -> np.ndarray:
    """For each bin, all bins in the order in which it visits them."""
    pair = np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins)
    return np.argsort(mix(mix(pair + _U(_BASE)) ^ _U(0xA5A5A5A5)), axis=1, kind="stable").astype(np.int32)


_ORDERS: dict[int, np.ndarray] = {}


def densified(least: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """``least`` (texts x bins) with empty bins filled; rows of nothing stay."""
    bins = least.shape[1]
    if bins not in _ORDERS:
        _ORDERS[bins] = _orders(bins)
    order = _ORDERS[bins]
    out = least.copy()
    row, col = np.nonzero(empty & ~empty.all(1)[:, None])
    for turn in range(bins):
        if not len(row):
            break
        other = order[col, turn]
        found = ~empty[row, other]
        r, c, o = row[found], col[found], other[found]
        out[r, c] = least[r, o]
        row, col = row[~found], col[~found]
    return out


def fingerprint_texts(texts: list[bytes], bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> np.ndarray:
    """Packed fingerprints (texts x bins * bits / 8 bytes) of UTF-8 texts. ``bins`` is a power of
    two and ``bits`` 1, 2, 4 or 8."""
    out = np.zeros((len(texts), bins * bits // 8), np.uint8)
    shift, none = _U(64 - (bins.bit_length() - 1)), np.uint64(2**64 - 1)
    for at in range(0, len(texts), TEXTS):
        some = [shingle_hashes(w, shingle) for w in words_of(texts[at:at + TEXTS])]
        count = np.array([len(h) for h in some])
        hashes = np.concatenate(some)
        least = np.full((len(some), bins), none)
        place = np.repeat(np.arange(len(some)) * bins, count) + (hashes >> shift).astype(np.int64)
        np.minimum.at(least.reshape(-1), place, hashes & ((_U(1) << shift) - _U(1)))
        codes = densified(least, least == none)
        codes = mix(codes + np.arange(1, bins + 1, dtype=np.uint64) * _U(_BASE)) & _U((1 << bits) - 1)
        codes[count == 0] = 0
        per = 8 // bits
        packed = np.zeros((len(some), bins // per), np.uint64)
        for k in range(per):
            packed |= codes[:, k::per] << _U(8 - bits * (k + 1))
        out[at:at + len(some)] = packed.astype(np.uint8)
    return out


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints row by row, corrected for codes equal by chance."""
    differ, per = a ^ b, 8 // bits
    same = sum((((differ >> (bits * k)) & ((1 << bits) - 1)) == 0).sum(1) for k in range(per))
    chance = 0.5 ** bits
    share = np.clip((same / (a.shape[1] * per) - chance) / (1 - chance), 0.0, 1.0)
    zero = ~a.any(1) | ~b.any(1)
    return np.where(zero, (differ == 0).all(1).astype(float), share)


def fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (binary) of every row."""
    def work(batches):
        for batch in batches:
            prints = fingerprint_texts([t.as_py() for t in batch.column(1)], bins, bits, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.tobytes() for p in prints], pa.binary())],
                                             ["doc_id", "fingerprint"])

    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id long, fingerprint binary")


def likeness_of(a: Column, b: Column, bits: int = BITS) -> Column:
    """Likeness of two columns of fingerprints (binary; null if one is)."""
    @F.pandas_udf("double")
    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        known = (left.notna() & right.notna()).to_numpy()
        out = np.full(len(left), np.nan)
        if known.any():
            read = lambda s: np.stack([np.frombuffer(v, np.uint8) for v in s[known]])
            out[known] = likeness(read(left), read(right), bits)
        return pd.Series(out).where(known, None)
    return compare(a, b)


_FIELDS = [("kind", pa.int32()), ("part", pa.int32()), ("times", pa.int64()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
           ("edited_sha", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
           ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.binary())]
_SCHEMA = ("kind int, part int, times long, doc_id long, n_chars long, edited_sha binary, fingerprint binary, "
           "edited_fingerprint binary, near_edited double, near_next double, text binary")
RESULT, FIRST, LAST = 0, 1, 2


def edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of the text, and the text whose last third gives way to the other's beginning."""
    own = text.decode("utf-8", "surrogateescape")
    third = len(own) // 3
    other = following[:4 * third].decode("utf-8", "surrogateescape")[:third]
    return len(own), (own[:len(own) - third] + other).encode("utf-8", "surrogateescape")


def _results(own: list, following: list, prints=None) -> dict:
    """Columns of the results of rows (doc_id, text, times) and the texts that follow them.
    ``prints``: fingerprints of both, if known."""
    texts = [r[1] for r in own]
    fp, next_fp = prints if prints else (fingerprint_texts(texts), fingerprint_texts(following))
    pairs = [edited(t, f) for t, f in zip(texts, following)]
    edited_fp = fingerprint_texts([p[1] for p in pairs])
    held = lambda a: [p.tobytes() for p in a]
    return {"kind": [RESULT] * len(own), "part": [0] * len(own), "times": [r[2] for r in own],
            "doc_id": [r[0] for r in own], "n_chars": [p[0] for p in pairs],
            "edited_sha": [hashlib.sha256(p[1]).digest() for p in pairs], "fingerprint": held(fp),
            "edited_fingerprint": held(edited_fp), "near_edited": likeness(fp, edited_fp),
            "near_next": likeness(fp, next_fp), "text": [None] * len(own)}


def _batch(cols: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[n], t) for n, t in _FIELDS], [n for n, _ in _FIELDS])


def _edge(kind: int, row: tuple) -> pa.RecordBatch:
    return _batch({n: [None] for n, _ in _FIELDS} | {
        "kind": [kind], "part": [TaskContext.get().partitionId()], "times": [row[2]], "doc_id": [row[0]], "text": [row[1]]})


def _walk(batches):
    """Results of sorted rows (doc_id, text, copies), each followed by the next; the first and the
    last row come out whole."""
    held = held_fp = None
    for batch in batches:
        if not batch.num_rows:
            continue
        doc_id, text, copies = (batch.column(i).to_pylist() for i in range(3))
        rows = list(zip(doc_id, text, copies))
        prints = fingerprint_texts(text)
        many = [i for i, r in enumerate(rows) if r[2] > 1]
        if many:  # all copies but one are followed by their own text
            own, fp = [rows[i][:2] + (rows[i][2] - 1,) for i in many], prints[many]
            yield _batch(_results(own, [r[1] for r in own], (fp, fp)))
        rows = [r[:2] + (1,) for r in rows]
        if held is None:
            yield _edge(FIRST, rows[0])
        else:
            rows, prints = [held] + rows, np.concatenate([held_fp, prints])
        if len(rows) > 1:
            yield _batch(_results(rows[:-1], [r[1] for r in rows[1:]], (prints[:-1], prints[1:])))
        held, held_fp = rows[-1], prints[-1:]
    if held is not None:
        yield _edge(LAST, held)


def _meet(batches):
    """Results of rows (doc_id, text, following)."""
    for batch in batches:
        doc_id, text, following = (batch.column(i).to_pylist() for i in range(3))
        if doc_id:
            yield _batch(_results([(d, t, 1) for d, t in zip(doc_id, text)], following))


def _sortable(docs: DataFrame) -> DataFrame:
    """doc_id, text (binary), copies, key: one row per document, or per text of a hot doc_id."""
    text = text_of(docs)
    rows = docs.select(doc_id_of(docs).alias("doc_id"), text.cast("binary").alias("text"),
                       F.lit(1).cast("long").alias("copies"), text_key(text).alias("key"))
    hot = save(docs.select(doc_id_of(docs).alias("_hot")).groupBy("_hot").agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > HOT).select("_hot"), "fingerprint-hot")
    n = hot.count()
    if not n:
        return rows
    hot = F.broadcast(hot) if n <= BROADCAST_IDS else hot
    met = F.col("doc_id").eqNullSafe(F.col("_hot"))
    some = (rows.join(hot, met, "left_semi").groupBy("doc_id", "key")
            .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    return rows.join(hot, met, "left_anti").unionByName(some.select(*rows.columns))


def edit_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited, near_next. The edited text's last third is the beginning of the next document."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").desc_nulls_last(), F.col("key").asc()]
    rows = _sortable(docs).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    walked = save(rows.select("doc_id", "text", "copies").mapInArrow(_walk, _SCHEMA), "fingerprints")
    # Pairs across tasks: one row per task that had rows.
    edge = lambda kind, *cols: walked.where(F.col("kind") == kind).select(*cols)
    order = Window.orderBy("_at")
    parts = edge(FIRST, F.col("part").alias("_at"))
    parts = parts.select("_at", F.coalesce(F.lead("_at").over(order), F.min("_at").over(Window.partitionBy())).alias("_then"))
    pairs = (edge(LAST, "part", "doc_id", "text").join(parts, F.col("part") == F.col("_at"))
             .join(edge(FIRST, F.col("part").alias("_part"), F.col("text").alias("following")), F.col("_then") == F.col("_part")))
    last = pairs.select("doc_id", "text", "following").mapInArrow(_meet, _SCHEMA)
    every = walked.where(F.col("kind") == RESULT).unionByName(last)
    every = every.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    text = lambda c: F.lower(F.hex(c))
    return every.select("doc_id", "n_chars", text("edited_sha").alias("edited_sha256"), text("fingerprint").alias("fingerprint"),
                        text("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next")


def op12_fingerprints(spark, sf_dir):
    """Query: fingerprints of all documents and of their edited texts."""
    return edit_report(documents(spark, sf_dir))


ship(__name__)
