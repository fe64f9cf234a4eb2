"""Best-fit packing with swap-based local search (operator 8).

A document's ids are those of a public tokenizer, then id 0. Documents longer than
``SEQUENCE`` ids are cut into pieces of that length; a full piece is a sequence by itself. The
others are dealt by hash into groups of about ``GROUP`` pieces, each packed in a task of its
own: best fit by falling length, then a local search on the least filled bins, which moves a
piece into another bin's gap, exchanges one piece for a smaller one there, or two pieces for
one, as long as the sum of squared fills rises, until bins are empty. Pieces of bins still
underfull go into a second round, where those of all groups meet.

Tokenizing: the tokenizer's result for a text is the concatenation of its model's results for
the parts that its pattern finds in the text's words. Distinct words of a block of texts are
looked up in bounded tables kept by each worker process, parts of new words go through the
model together; texts where that does not hold for sure (special tokens' strings, separators,
letters whose lower case or composition depends on context) are given to the tokenizer whole.

Defined results: a null text is empty and gives one piece holding id 0; a text of any length
is encoded whole; repeated rows are packed one by one; an empty table gives an empty result;
extra columns do not matter.
"""

from __future__ import annotations

import bisect
import re
import sys
import types
import unicodedata
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import doc_id_of, documents, save, ship, sorted_groups, spread, text_of

SEQUENCE = 2048
GROUP = 8192
END_ID = 0
CACHE_WORDS = 500_000
#: Texts of about so many characters are encoded at once, their words in blocks.
BLOCK_CHARS = 4_000_000
BLOCK_WORDS = 1 << 19
#: Fixed value: the tokenizer file's own pattern for the parts of a text.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PARTS_AND_ENDS = regex.compile(PARTS.pattern + r"|\n")
#: Letters that stand for bytes in byte-level vocabularies: printable bytes for themselves,
#: the others, in order, for the letters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
#: The letter of each byte; a blank, which no part holds, stays to part them.
LETTERS = np.array([32 if b == 32 else BYTE_LETTERS.get(b, b) for b in range(256)], "<u2")
#: Bins filled to this share are left as they are after the first round.
FILLED = 0.98
#: Beyond Latin letters, or what white space and composition could change: encode whole.
#: Dashes, quotes, currency signs, letter-like signs and arrows are plain.
UNSURE = re.compile(r"[\x1c-\x1f\x85\u0130\u0250-\u200f\u2028-\u202f\u205f-\u209f\u20c0-\u20ff"
                    r"\u2150-\u218f\u2200-\U0010ffff]")
UNSURE_ASCII = re.compile(r"[\x1c-\x1f]")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _encoder(path: str):
    """Kept between this worker process's tasks: tokenizer, its model over parts between blanks,
    which ids end a part, and two tables of words' ids (recently met words and older ones)."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers
    kept = sys.modules.setdefault("_lakeward_words", types.ModuleType("_lakeward_words")).__dict__
    if path not in kept:
        tok = Tokenizer.from_file(path)
        bare = Tokenizer(tok.model)
        bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = getattr(tok.model, "end_of_word_suffix", None)
        vocab = tok.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            ends[[i for name, i in vocab.items() if name.endswith(suffix)]] = True
        kept[path] = (tok, bare, ends, [{}, {}])
    return kept[path]


def _unsure(text: str) -> bool:
    """Whether a text's words by themselves might not give what the tokenizer gives for it."""
    if "<|" in text:
        return True
    if text.isascii():
        return UNSURE_ASCII.search(text) is not None
    return UNSURE.search(text) is not None or not unicodedata.is_normalized("NFC", text)


def token_bytes(text: str, path: str) -> bytes:
    """Ids of a text as little-endian 32-bit numbers, without the end id."""
    return texts_bytes([text], path)[0]


def texts_bytes(texts: list[str], path: str) -> list[bytes]:
    """``token_bytes`` of many texts: each distinct word of a block of words is looked up once."""
    tok = _encoder(path)[0]
    whole = {k: np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
             for k, text in enumerate(texts) if _unsure(text)}
    plain = pa.array(["" if k in whole else text.lower() for k, text in enumerate(texts)], pa.large_string())
    split = pc.utf8_split_whitespace(plain)  # for texts that are not unsure, the blanks of the tokenizer
    words, until = split.flatten(), split.offsets.to_numpy()  # words up to the end of each text
    blocks, sizes = [], [np.zeros(1, np.int64)]
    for at in range(0, len(words), BLOCK_WORDS):
        distinct, codes = _distinct(words.slice(at, BLOCK_WORDS))
        found = _word_bytes(distinct, path)
        ids, counts = _gather(b"".join(found), np.fromiter(map(len, found), np.int64, len(found)) // 4, codes)
        blocks.append(ids.tobytes())
        sizes.append(4 * counts)
    data = b"".join(blocks)
    bounds = np.cumsum(np.concatenate(sizes))[until].tolist()
    return [whole[k] if k in whole else data[bounds[k]:bounds[k + 1]] for k in range(len(texts))]


def _distinct(strings: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct strings, and the number of each string among them."""
    coded = strings.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()


def _gather(data: bytes, counts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the coded strings one after the other, and how many each has: ``data`` holds the
    ids of the distinct strings, ``counts`` how many each of these has."""
    starts = np.cumsum(counts) - counts
    own = counts[codes]
    at = np.repeat(starts[codes] - (np.cumsum(own) - own), own)
    at += np.arange(len(at))
    return np.frombuffer(data, "<u4")[at], own


def _word_bytes(words: list[str], path: str) -> list[bytes]:
    """Ids of distinct words. When the table of recent words is full, it becomes the one of older
    words, from which words still in use come back."""
    tables = _encoder(path)[3]
    if len(tables[0]) > CACHE_WORDS:
        tables[:] = {}, tables[0]
    recent, older = tables
    found = list(map(recent.get, words))
    unmet = [k for k, ids in enumerate(found) if ids is None]
    unknown = []
    for k in unmet:
        if (ids := older.get(words[k])) is None:
            unknown.append(k)
        else:
            found[k] = ids
    if unknown:
        for k, ids in zip(unknown, _new_words([words[k] for k in unknown], path)):
            found[k] = ids
    recent.update((words[k], found[k]) for k in unmet)
    return found


def _new_words(words: list[str], path: str) -> list[bytes]:
    """Ids of words by the tokenizer's model, which sees each distinct part once."""
    parts, codes = _distinct(pa.array(PARTS_AND_ENDS.findall("\n".join(words) + "\n"), pa.large_string()))
    end = parts.index("\n")
    data, counts = _part_ids([p for p in parts if p != "\n"], path)
    ids, own = _gather(data, np.insert(counts, end, 0), codes)
    data = ids.astype("<u4").tobytes()
    bounds = [0, *(4 * np.cumsum(own)[codes == end]).tolist()]
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def _part_ids(parts: list[str], path: str) -> tuple[bytes, np.ndarray]:
    """Ids of matches of the tokenizer's pattern, by the tokenizer's model, and their numbers."""
    tok, bare, ends, _ = _encoder(path)
    letters = LETTERS[np.frombuffer(" ".join(parts).encode(), np.uint8)].tobytes().decode("utf-16-le")
    ids = np.array(bare.encode_batch_fast([letters], add_special_tokens=False)[0].ids, "<u4")
    last = np.flatnonzero(ends[ids])
    if len(last) == len(parts):  # a part's last id, and no other, has the end mark
        return ids.tobytes(), np.diff(last, prepend=-1)
    found = [[t.id for t in tok.model.tokenize(p)] for p in letters.split(" ")] if parts else []
    return np.array([*chain(*found)], "<u4").tobytes(), np.array([len(f) for f in found], np.int64)


def _portions(batch: pa.RecordBatch):
    """Slices of a batch, each of about ``BLOCK_CHARS`` characters of text or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(ends // BLOCK_CHARS)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def pieces(docs: DataFrame, path: str | None = None, longest: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    path = path or default_tokenizer()

    def work(batches):
        for batch in (part for b in batches for part in _portions(b)):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), texts_bytes(batch.column(1).to_pylist(), path)):
                ids += END_ID.to_bytes(4, "little")
                for k, at in enumerate(range(0, len(ids), 4 * longest)):
                    part = ids[at:at + 4 * longest]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Bins of piece numbers: best fit by falling length."""
    bins: list[list[int]] = []
    gaps: list[tuple[int, int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect.bisect_left(gaps, (size, -1))
        if at < len(gaps):
            gap, b = gaps.pop(at)
            bins[b].append(i)
        else:
            gap, b = room, len(bins)
            bins.append([i])
        if gap > size:
            bisect.insort(gaps, (gap - size, b))
    return bins


def _pairs(own: list[int], lengths: np.ndarray) -> list[list[int]]:
    """Two pieces of a bin, one pair for each sum of lengths, the largest first."""
    alike: dict[int, list[int]] = {}
    for i in own:
        alike.setdefault(int(lengths[i]), []).append(i)
    found: dict[int, list[int]] = {}
    kinds = list(alike.values())  # at most 64 lengths in a bin of 2048
    for n, one in enumerate(kinds):
        for other in kinds[n:]:
            if one is not other or len(one) > 1:
                found.setdefault(int(lengths[one[0]] + lengths[other[0]]), [one[0], other[-1]])
    return [found[size] for size in sorted(found, reverse=True)]


def improve(bins: list[list[int]], lengths: np.ndarray, room: int) -> list[list[int]]:
    """Empty the least filled bins by moves and exchanges, as long as that raises the sum of
    squared fills: a piece goes to a bin at least as full as its own after the change."""
    where = np.zeros(len(lengths), np.int64)
    for b, own in enumerate(bins):
        where[own] = b
    fill = np.bincount(where, lengths, len(bins)).astype(np.int64)
    held = [set(b) for b in bins]

    def change(out: list[int], back: list[int], a: int, b: int) -> None:
        for i in out:
            where[i] = b
            held[a].discard(i)
            held[b].add(i)
        for i in back:
            where[i] = a
            held[b].discard(i)
            held[a].add(i)
        moved = int(lengths[out].sum() - (lengths[back].sum() if back else 0))
        fill[a] -= moved
        fill[b] += moved

    for donor in np.argsort(fill, kind="stable").tolist():
        if fill[donor] >= FILLED * room or room - fill[donor] <= 1:
            continue  # filled by now; later ones may not be
        improved = True
        while improved and held[donor]:
            improved = False
            own = sorted(held[donor], key=lambda i: -lengths[i])
            for one in own:  # a move into the tightest gap
                gap = room - fill
                fits = np.flatnonzero((gap >= lengths[one]) & (fill + lengths[one] > fill[donor]) & (fill > 0))
                fits = fits[fits != donor]
                if len(fits):
                    change([one], [], donor, int(fits[np.argmin(gap[fits])]))
                    improved = True
                    break
            if improved:
                continue
            # One or two pieces of the donor for one of another bin, the largest gain first.
            sizes = list({int(lengths[i]): i for i in own}.values())  # pieces of one length are alike
            offers = [[i] for i in sizes] + _pairs(own, lengths)
            gap = (room - fill)[where]
            after = fill[where]
            for out in offers:
                more = int(lengths[out].sum()) - lengths
                good = (more > 0) & (more <= gap) & (where != donor) & (after + more > fill[donor])
                if good.any():
                    best = int(np.argmax(np.where(good, more, -1)))
                    change(out, [best], donor, int(where[best]))
                    improved = True
                    break
    return [sorted(h) for h in held if h]


def _packed(rows: DataFrame, group_rows: int, room: int, number: int) -> DataFrame:
    """One round: ``rows`` with sequence_id, offset and fill of their sequence."""
    groups = -(-rows.count() // group_rows) or 1
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    dealt = spread(dealt.select("group", *rows.columns), "group")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + \
        ", sequence_id long, offset long, fill long"

    def work(batches):
        for table in sorted_groups(batches, 1):
            lengths = table.column("length").to_numpy()
            bins = improve(best_fit(lengths, room), lengths, room)
            group = table.column(0)[0].as_py()
            n = len(lengths)
            seq, off, fill = (np.zeros(n, np.int64) for _ in range(3))
            for b, own in enumerate(bins):
                sizes = lengths[own]
                seq[own] = (number << 60) + (group << 20) + b
                off[own] = np.cumsum(sizes) - sizes
                fill[own] = sizes.sum()
            out = table.drop_columns(["group"])
            for name, col in (("sequence_id", seq), ("offset", off), ("fill", fill)):
                out = out.append_column(name, pa.array(col))
            yield from out.to_batches()

    return dealt.mapInArrow(work, schema)


def pack(docs: DataFrame, path: str | None = None, room: int = SEQUENCE, group_rows: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = save(pieces(docs, path, room), "pieces")
    full = rows.where(F.col("length") == room).withColumn(
        "sequence_id", F.lit(3 << 60) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    first = save(_packed(rows.where(F.col("length") < room), group_rows, room, 0), "packed")
    good = F.col("fill") >= int(FILLED * room)
    again = first.where(~good).select(*rows.columns)
    second = _packed(again, group_rows, room, 1)
    return full.unionByName(first.where(good).drop("fill")).unionByName(second.drop("fill"))


def op8_best_fit_packing(spark, sf_dir):
    """Query: all documents packed into sequences of at most 2048 ids."""
    return pack(documents(spark, sf_dir))


ship(__name__)
