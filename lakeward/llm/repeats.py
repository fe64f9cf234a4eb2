"""Repeated passages by longest-previous-factor arrays (operator 4).

A byte is repeated if a ``LENGTH``-byte string that covers it also starts somewhere else, in
the same or another document (texts are UTF-8 bytes; matches never cross documents).

1. Anchors. In every string of LENGTH bytes the ``GRAM``-byte gram of least hash (rightmost
   of equals) is its anchor: a function of the string alone, so equal strings have equal
   anchors at equal offsets. Texts are read whole; about one byte in 185 is an anchor.
2. Anchors whose gram occurs at one place only are dropped by a partial aggregate.
3. For the others, the strings they anchor are taken in slices of ``SLICE`` consecutive
   starts. A slice's strings share a core; what differs are two flanks. Occurrences with equal
   core meet by the core's hash. Equal occurrences (same flanks) are one kind, which stands in
   the order below with its first and its last place.
4. Distinct flanks of a core form a small suffix order: sorted by what follows the core, with
   the longest common prefixes of neighbours. Within those that agree x bytes to the left,
   the previous and next smaller positions in that order give each suffix its longest
   previous factor. A string is repeated if its factor reaches LENGTH; ``keep="none"`` marks
   both ends of such a factor. Only x at which some class changes are tried.
5. A core with over ``MAX_MEMBERS`` distinct flanks is not gathered: each of its strings is
   hashed and counted on its own (``_by_counting``), with the same result.

``keep="first"`` removes later copies and keeps the first occurrence, by (smallest doc_id of
the text, text key, start); ``keep="none"`` removes all occurrences.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing; equal texts of
LENGTH bytes or more are copies of each other; of rows alike in doc_id and text, none counts
as first but all are copies; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, doc_id_of, documents, save, ship, shuffles_removed, spread, text_key, text_of

LENGTH = 400
GRAM = 32
SLICE = 93
PASSAGE_WORDS = 51
WORD_BYTES = 4
MAX_MEMBERS = 20_000
CHUNK = 1 << 19
JOINED = 1 << 15
ROUNDS = 64
EXPANDED = 1 << 18
BASE = 0x9E3779B97F4A7C15


def saved(df: DataFrame, name: str) -> DataFrame:
    """``save``, whose shuffle files go with the query: each of these tables is written once."""
    with shuffles_removed(df.sparkSession):
        return save(df, name)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of BASE and of its inverse, mod 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        power = np.full(n, base, np.uint64)
        power[:1] = 1
        out.append(np.cumprod(power))
    return tuple(out)


def gram_hashes(raw: np.ndarray, gram: int = GRAM, known: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """64-bit hash of every ``gram``-byte substring: a polynomial in an odd base, mod 2^64, by
    prefix sums, brought to a common power and mixed. ``known``: ``powers``, if at hand."""
    n = len(raw)
    power, back = known if known and len(known[0]) >= n else powers(n)
    sums = raw.astype(np.uint64)
    sums += np.uint64(1)
    sums *= power[:n]
    np.cumsum(sums, out=sums)
    h = sums[gram - 1:].copy()
    h[1:] -= sums[:-gram]
    h *= back[:n - gram + 1]
    sums = sums[:len(h)]
    h ^= np.right_shift(h, np.uint64(31), out=sums)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= np.right_shift(h, np.uint64(29), out=sums)
    return h


def least_grams(raw: np.ndarray, length: int, gram: int, known=None) -> tuple[np.ndarray, np.ndarray]:
    """Place of the gram of least hash (rightmost of equals) in the string of ``length`` bytes at
    each start, and the hashes of all grams."""
    h = gram_hashes(raw, gram, known)
    m, width = len(h), length - gram + 1
    low = np.uint64((1 << 20) - 1)
    # Hash first, then the rightmost place; 20 bits hold any place of a chunk.
    least, spare = h & ~low, np.arange(int(low), int(low) - m, -1, dtype=np.uint64)
    least |= spare
    # The least of 2, 4, 8, .. neighbours, then of two such stretches that make up the width.
    k = 1
    while 2 * k <= width:
        np.minimum(least[:m - k], least[k:m], out=spare[:m - k])
        least, spare, m, k = spare, least, m - k, 2 * k
    starts = len(h) - width + 1
    least = np.minimum(least[:starts], least[width - k:width - k + starts])
    least &= low
    return (low - least).view(np.int64), h


def anchor_arrays(text: bytes, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """Arrays pos, first start, last start and gram hash of the anchors of a text, by pos."""
    n = len(text)
    found: list[list[np.ndarray]] = []
    for at in range(0, n - length + 1, CHUNK):
        raw = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, n - at), at)
        place, h = least_grams(raw, length, gram)
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([edge[1:], [len(place)]]) - 1
        part = [place[edge] + at, edge + at, last + at, h[place[edge]]]
        # An anchor may serve the last starts of a chunk and the first ones of the next.
        if found and part[0][0] == found[-1][0][-1]:
            found[-1][2][-1] = part[2][0]
            part = [c[1:] for c in part]
        if len(part[0]):
            found.append(part)
    if not found:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
    return [np.concatenate(c) for c in zip(*found)]


def joined_anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, known=None) -> list[np.ndarray]:
    """Array of the text's number, and the arrays of ``anchor_arrays``, of several texts of
    ``length`` bytes or more, at most JOINED in all: hashed one after the other, strings that lie
    in two texts left out."""
    size = np.array([len(t) for t in texts])
    end = np.cumsum(size)
    place, h = least_grams(np.frombuffer(b"".join(texts), np.uint8), length, gram, known)
    own = np.repeat(np.arange(len(texts)), size)[:len(place)]
    start = np.flatnonzero(np.arange(length, length + len(place)) <= end[own])
    own, place = own[start], place[start]
    edge = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (own[1:] != own[:-1])]))
    last = np.concatenate([edge[1:], [len(place)]]) - 1
    at = (end - size)[own[edge]]
    return [own[edge], place[edge] - at, start[edge] - at, start[last] - at, h[place[edge]]]


def many_anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """The same arrays of any texts of ``length`` bytes or more, by text and pos."""
    out, i, known = [], 0, powers(JOINED)
    while i < len(texts):
        j, total = i + 1, len(texts[i])
        while j < len(texts) and total + len(texts[j]) <= JOINED:
            total += len(texts[j])
            j += 1
        if total > JOINED:
            cols = anchor_arrays(texts[i], length, gram)
            out.append([np.full(len(cols[0]), i), *cols])
        else:
            own, *cols = joined_anchors(texts[i:j], length, gram, known)
            out.append([own + i, *cols])
        i = j
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM):
    """(pos, first start, last start, gram hash) of every anchor of a text."""
    return list(zip(*(c.tolist() for c in anchor_arrays(text, length, gram))))


def anchor_rows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, doc_id, pos, first, last, gram of every anchor of every text."""
    def work(batches):
        for batch in batches:
            own, pos, first, last, gram = many_anchors(batch.column(2).to_pylist(), length)
            own, gram = pa.array(own), (gram ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own), *map(pa.array, (pos, first, last, gram))],
                ["key", "doc_id", "pos", "first", "last", "gram"])

    text = text_of(docs)
    rows = docs.select(text_key(text).alias("key"), doc_id_of(docs).alias("doc_id"),
                       text.cast("binary").alias("text")).where(F.octet_length("text") >= length)
    return rows.mapInArrow(work, "key binary, doc_id long, pos long, first long, last long, gram long")


def slices(text: bytes, pos: int, first: int, last: int, length: int = LENGTH, width: int = SLICE):
    """(a0, core hash, left flank, right flank) of each slice of an anchor's strings; their
    starts are pos - a for a in a0 .. a0 + width - 1."""
    for a0 in range((pos - last) // width * width, pos - first + 1, width):
        a1 = a0 + width - 1
        core = text[pos - a0:pos + length - a1]
        name = hashlib.blake2b(core, digest_size=16, salt=a0.to_bytes(4, "little")).digest()
        yield a0, name, text[max(0, pos - a1):pos - a0], text[pos + length - a1:pos + length - a0]


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    return len(os.path.commonprefix([a, b]))


def candidates(ranks: list, lcps: list[int]) -> list[tuple[int, int, int, int]]:
    """For suffixes in suffix order (lcps[i]: common prefix of i - 1 and i), the suffixes of the
    previous and of the next smaller rank in that order, each with the prefix it has in common:
    (previous, common, next, common); -1 and -1 where there is none."""
    n = len(ranks)
    sides = []
    for order in (range(n), range(n - 1, -1, -1)):
        own = [(-1, -1)] * n
        stack: list[tuple] = []  # (suffix, common prefix with the one stacked below)
        for i in order:
            near = lcps[i] if order.step > 0 else (lcps[i + 1] if i + 1 < n else 0)
            while stack and ranks[stack[-1][0]] > ranks[i]:
                near = min(near, stack.pop()[1])
            if stack:
                own[i] = (stack[-1][0], near)
            stack.append((i, near))
        sides.append(own)
    return [(*a, *b) for a, b in zip(*sides)]


def factors(ranks: list, lcps: list[int]) -> list[int]:
    """The longest previous factor of each suffix, -1 if no suffix has a smaller rank."""
    return [max(a, b) for _, a, _, b in candidates(ranks, lcps)]


def flank_rows(flanks: list[bytes], back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Flanks as rows of a matrix, filled with zeros, and their lengths; ``back``: read from
    their ends."""
    size = np.fromiter(map(len, flanks), np.int64, len(flanks))
    width = int(size.max(initial=1))
    at = np.arange(width)
    rows = np.zeros((len(flanks), width), np.uint8)
    rows[at >= width - size[:, None] if back else at < size[:, None]] = np.frombuffer(b"".join(flanks), np.uint8)
    return rows[:, ::-1] if back else rows, size


def suffix_order(group: np.ndarray, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group and flank, and the longest common prefix of each with the one
    before it in its group, -1 for the first one."""
    # Filled with zeros, then by length: the order of the flanks themselves.
    key = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), rows,
                          size.astype(">u2").view(np.uint8).reshape(-1, 2)], 1)
    order = np.argsort(np.ascontiguousarray(key).view(f"S{key.shape[1]}").ravel(), kind="stable")
    a, b = order[:-1], order[1:]
    other = np.concatenate([rows[a] != rows[b], np.ones((len(a), 1), bool)], 1)
    lcp = np.minimum(other.argmax(1), np.minimum(size[a], size[b]))
    return order, np.concatenate([[-1], np.where(group[a] == group[b], lcp, -1)])


def many_candidates(ranks: np.ndarray, lcps: np.ndarray, first: np.ndarray):
    """``candidates`` of many suffix orders, which stand one after the other (``first`` marks
    where each begins): each side's (places in the array or -1, common prefixes). All suffixes
    look at their neighbour, then at its candidate, and so on; orders in which some suffix
    still looks after ROUNDS steps are taken one by one."""
    n = len(ranks)
    begin = np.append(np.flatnonzero(first), n)
    # From the right, the common prefix with a neighbour stands at that neighbour.
    sides = ((-1, first, lcps.copy()), (1, np.append(first[1:], True), np.append(lcps[1:], -1)))
    for side, (step, edge, near) in enumerate(sides):
        own = np.where(edge, -1, np.arange(n) + step)
        todo = np.flatnonzero(~edge)
        for _ in range(ROUNDS):
            todo = todo[(own[todo] >= 0) & (ranks[own[todo]] > ranks[todo])]
            if not len(todo):
                break
            past = own[todo]
            own[todo], near[todo] = own[past], np.minimum(near[todo], near[past])
        for i in np.unique(np.searchsorted(begin, todo, "right") - 1).tolist():
            a, b = begin[i:i + 2].tolist()
            got = np.array(candidates(ranks[a:b].tolist(), lcps[a:b].tolist()))[:, 2 * side:2 * side + 2]
            own[a:b], near[a:b] = np.where(got[:, 0] < 0, -1, got[:, 0] + a), got[:, 1]
        yield own, near


def repeated_starts(group: np.ndarray, lefts: list[bytes], rights: list[bytes], ranks: np.ndarray, need: int, later: bool):
    """Arrays (least, greatest) x of each member whose string with x bytes of its left flank and
    need - x of its right flank stands in a member of its group of smaller rank too; greatest
    is -1 if there is none. ``later`` marks both ends of such a factor, which finds every repeated
    string: of equal strings, all but the first have an earlier one among their two candidates,
    and the first is a candidate of its neighbour in suffix order."""
    right, right_lcp = suffix_order(group, *flank_rows(rights))
    left, left_lcp = suffix_order(group, *flank_rows(lefts, True))
    n = len(group)
    least, most = np.full(n, need + 1), np.full(n, -1)
    place = np.empty(n, np.int64)
    place[right] = np.arange(n)
    place = place[left]  # of the members in the left order
    begin = np.flatnonzero(left_lcp < 0)
    members = np.diff(np.append(begin, n))
    # At these x some class of members that agree to the left, or the prefix it takes, changes.
    number = np.cumsum(left_lcp < 0) - 1
    tries = np.concatenate([np.minimum(left_lcp, need), np.maximum(0, need - right_lcp)])
    tries = np.unique((np.concatenate([number, number]) * (need + 1) + tries)[np.concatenate([left_lcp, right_lcp]) >= 0])
    number, tries = np.divmod(tries, need + 1)
    walk = np.append(right_lcp, -1)
    total = np.cumsum(members[number])
    i = 0
    while i < len(tries):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + EXPANDED, "right")))
        each = members[number[i:j]]
        x = np.repeat(tries[i:j], each)
        at = np.arange(len(x)) + np.repeat(begin[number[i:j]] - np.cumsum(each) + each, each)
        i = j
        edge = left_lcp[at] < x
        kind = np.cumsum(edge) - 1
        own = place[at]
        # Classes of several members, each in the right order, with the least common prefix on
        # the way between neighbours.
        several = np.bincount(kind)[kind] > 1
        kind, own, x = kind[several], own[several], x[several]
        if not len(own):
            continue
        order = np.argsort(kind * n + own, kind="stable")
        kind, own, x = kind[order], own[order], x[order]
        first = np.concatenate([[True], kind[1:] != kind[:-1]])
        way = np.stack([own[:-1] + 1, own[1:] + 1], 1).ravel()
        lcps = np.concatenate([[-1], np.minimum.reduceat(walk, way)[::2]])
        lcps[first] = -1
        # Only classes in which some neighbours' factor is long enough.
        top = np.maximum.reduceat(lcps, np.flatnonzero(first))
        size = np.bincount(kind)
        size = size[size > 0]
        row = np.flatnonzero(np.repeat(top >= need - x[first], size))
        member, tried = right[own[row]], x[row]
        for to, near in many_candidates(ranks[member], lcps[row], first[row]):
            hit = np.flatnonzero((to >= 0) & (near >= need - tried))
            for e in (hit, to[hit]) if later else (hit,):
                np.minimum.at(least, member[e], tried[hit])
                np.maximum.at(most, member[e], tried[hit])
    return least, most


def whole_groups(batches):
    """Batches sorted by their first column as tables of many whole groups."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(0).to_pylist()
        cut = names.index(names[-1])
        if held and (cut or names[0] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        last = names[-1]
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


#: Verdicts of a kind: at its first place and, if it has more places, at those after it.
VERDICT = ["core", "flanks", "d", "k", "p", "least", "most", "later_least", "later_most"]


def _by_gathering(members: DataFrame, width: int, later: bool) -> DataFrame:
    dealt = spread(members.select("core", "flanks", "lf", "rf", *[F.col(f"{e}.{c}").alias(f"{e}_{c}")
                                                                  for e in ("start", "end") for c in "dkp"]), "core")

    def work(batches):
        for t in whole_groups(batches):
            core = t.column(0).to_pylist()
            group = np.cumsum([False] + [a != b for a, b in zip(core, core[1:])])
            # Cores with several kinds, or with a kind of several places.
            some = np.bincount(group)[group] > 1
            for a, b in zip(range(4, 7), range(7, 10)):
                some |= pc.not_equal(t.column(a), t.column(b)).to_numpy()
            t, group = t.filter(pa.array(some)), group[some]
            n = t.num_rows
            if not n:
                continue
            lefts, rights = (t.column(i).to_pylist() for i in (2, 3))
            # Ranks: places by doc_id, text key and position.
            d, p = (np.concatenate([t.column(i + j).to_numpy() for j in (0, 3)]) for i in (4, 6))
            _, k = np.unique(np.array(t.column(5).to_pylist() + t.column(8).to_pylist(), object), return_inverse=True)
            order = np.lexsort((p, k, d))
            d, k, p = (c[order] for c in (d, k, p))
            ranks = np.empty(2 * n, np.int64)
            ranks[order] = np.cumsum(np.concatenate([[False], (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (p[1:] != p[:-1])]))
            # A kind of several places has two suffixes of the order: its first and its last one.
            again = np.flatnonzero(ranks[:n] != ranks[n:])
            least, most = repeated_starts(
                np.concatenate([group, group[again]]), lefts + [lefts[i] for i in again], rights + [rights[i] for i in again],
                np.concatenate([ranks[:n], ranks[n + again]]), width - 1, later)
            after = [np.full(n, width), np.full(n, -1)]
            for own, got in zip(after, (least, most)):
                own[again] = got[n:]
            hit = np.flatnonzero((most[:n] >= 0) | (after[1] >= 0))
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [t.column(c).combine_chunks().take(pa.array(hit)) for c in (0, 1, 4, 5, 6)]
                    + [pa.array(c[hit], mask=last[hit] < 0) for c, last in ((least[:n], most[:n]), (most[:n], most[:n]),
                                                                            (after[0], after[1]), (after[1], after[1]))], VERDICT)

    return dealt.mapInArrow(work, "core binary, flanks long, d long, k binary, p long, least long, most long, "
                                  "later_least long, later_most long")


def _by_counting(members: DataFrame, width: int, later: bool) -> tuple[DataFrame, DataFrame]:
    """The same for cores of any size: every string by itself, hashed and counted. Beside the
    verdicts, the saved table that they read."""
    need = width - 1
    tried = members.select("core", "flanks", "lf", "rf", "start", "end", F.explode(F.sequence(F.lit(0), F.lit(need))).alias("x"))
    tried = tried.where((F.octet_length("lf") >= F.col("x")) & (F.octet_length("rf") >= need - F.col("x")))
    string = F.sha2(F.concat(F.expr(f"substring(lf, cast(octet_length(lf) - x + 1 as int), cast(x as int))"),
                             F.expr(f"substring(rf, 1, cast({need} - x as int))")), 256)
    tried = tried.select("core", "flanks", "start", "end", "x", string.alias("s"))
    many = saved(tried.groupBy("core", "x", "s").agg(F.min("start").alias("a"), F.max("end").alias("b"))
                .where("a <> b").select(F.col("core").alias("_c"), F.col("x").alias("_x"), F.col("s").alias("_s"), "a"),
                "counted")
    hit = tried.join(many, (F.col("core") == F.col("_c")) & (F.col("x") == F.col("_x")) & (F.col("s") == F.col("_s")))
    x = F.col("x").cast("long")
    at_first = x if later else F.when(F.col("start") > F.col("a"), x)
    after = F.when(F.col("start") != F.col("end"), x)
    return hit.groupBy("core", "flanks", F.col("start.d").alias("d"), F.col("start.k").alias("k"), F.col("start.p").alias("p")).agg(
        F.min(at_first).alias("least"), F.max(at_first).alias("most"),
        F.min(after).alias("later_least"), F.max(after).alias("later_most")), many


def cut_slices(docs: DataFrame, length: int = LENGTH, width: int = SLICE) -> DataFrame:
    """core, lf, rf, key, doc_id, pos, a0, flanks of each slice of the anchors whose gram stands at
    several places (saved, so that the texts are not read again)."""
    found = saved(anchor_rows(docs, length), "anchors")
    place = F.xxhash64("key", "pos")
    grams = found.groupBy("gram").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b")
    grams = saved(grams.select(F.col("gram").alias("_gram")), "grams")
    met = found.join(grams, F.col("gram") == F.col("_gram"))
    per_text = met.groupBy("key").agg(F.min("doc_id").alias("doc_id"),
                                      F.collect_set(F.struct("pos", "first", "last")).alias("places"))
    per_text = saved(per_text.select(F.col("key").alias("_key"), F.col("doc_id").alias("_doc"), "places"), "places")
    discard(found, grams)

    def work(batches):
        for batch in batches:
            places = batch.column(3).flatten()
            texts = batch.column(2).to_pylist()
            own = np.repeat(np.arange(len(texts)), batch.column(3).value_lengths().to_numpy(zero_copy_only=False)).tolist()
            rows, of, at = [], [], []
            for i, *place in zip(own, *(places.field(f).to_pylist() for f in ("pos", "first", "last"))):
                got = list(slices(texts[i], *place, length, width))
                rows += got
                of += [i] * len(got)
                at += [place[0]] * len(got)
            a0, core, lf, rf = zip(*rows) if rows else [()] * 4
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.binary()) for c in (core, lf, rf)), batch.column(0).take(of), batch.column(1).take(of),
                 pa.array(at, pa.int64()), pa.array(a0, pa.int64())], ["core", "lf", "rf", "key", "doc_id", "pos", "a0"])

    text = text_of(docs)
    rows = docs.select(text_key(text).alias("key"), doc_id_of(docs).alias("doc_id"), text.cast("binary").alias("text"))
    rows = rows.where(F.octet_length("text") >= length)
    # One row of each text (or a few, if doc_ids repeat; they count as one below).
    rows = rows.join(per_text, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    cut = rows.select("key", "doc_id", "text", "places").mapInArrow(
        work, "core binary, lf binary, rf binary, key binary, doc_id long, pos long, a0 long")
    cut = saved(cut.withColumn("flanks", F.xxhash64("lf", "rf", F.octet_length("lf"))), "slices")
    discard(per_text)
    return cut


def spans(docs: DataFrame, keep: str = "none", length: int = LENGTH, width: int = SLICE,
          max_members: int = MAX_MEMBERS) -> DataFrame:
    """(key, start, stop): repeated stretches of texts, by text key; they may overlap."""
    return repeated_spans(cut_slices(docs, length, width), keep, length, width, max_members)


def repeated_spans(cut: DataFrame, keep: str, length: int, width: int, max_members: int = MAX_MEMBERS) -> DataFrame:
    """``spans`` of the texts of these slices (``cut_slices``), which go once they are read."""
    later = keep == "none"
    start = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), F.col("key").alias("k"), F.col("pos").alias("p"))
    # A kind has the flanks of any of its places.
    kinds = saved(cut.groupBy("core", "flanks").agg(F.min(start).alias("start"), F.max(start).alias("end"),
                                                   F.first("lf").alias("lf"), F.first("rf").alias("rf")), "kinds")
    large = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_members)
    large = saved(large.select(F.col("core").alias("_core")), "cores")
    same = F.col("core") == F.col("_core")
    told = _by_gathering(kinds.join(large, same, "left_anti"), width, later)
    by_counting, counted = _by_counting(kinds.join(large, same, "left_semi"), width, later)
    told = told.unionByName(by_counting)
    told = saved(told.select(*[F.col(c).alias(f"_{c}") for c in VERDICT]), "verdicts")
    discard(kinds, large, counted)
    at = cut.select("core", "flanks", "key", "pos", "a0", start.alias("start"))
    at = at.join(told, (F.col("core") == F.col("_core")) & (F.col("flanks") == F.col("_flanks")))
    own = F.col("start") == F.struct(F.col("_d").alias("d"), F.col("_k").alias("k"), F.col("_p").alias("p"))
    least, most = (F.when(own, F.col(f"_{c}")).otherwise(F.col(f"_later_{c}")) for c in ("least", "most"))
    out = at.select("key", "pos", "a0", least.alias("least"), most.alias("most")).where("least <= most")
    out = saved(out.select("key", (F.col("pos") - F.col("a0") - F.col("most")).alias("start"),
                          (F.col("pos") + F.lit(length) - F.col("a0") - F.col("least")).alias("stop")), "spans")
    discard(cut, told)
    return out


def hashed_words(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, origin (key of the text) and text: its words ([^\\x20\\x09-\\x0D]+) as their CRC32s
    of four bytes, one after the other; texts under ``words`` words are left out."""
    def work(batches):
        for batch in batches:
            out = []
            for d, k, text in zip(*(batch.column(i) for i in range(3))):
                own = text.as_py().split()   # of bytes: at the contract's white space only
                if len(own) >= words:
                    out.append((d.as_py(), k.as_py(), np.fromiter(map(zlib.crc32, own), np.uint32, len(own)).astype(">u4").tobytes()))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.binary(), pa.binary()])],
                                             ["doc_id", "origin", "text"])

    text = text_of(docs)
    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_key(text).alias("origin"), text.cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id long, origin binary, text binary")


def shared_words(docs: DataFrame, words: int = PASSAGE_WORDS, **options) -> DataFrame:
    """(origin, n_shared): by key of the text, how many of its words stand in runs of ``words``
    words or more that also start somewhere else, in the same or another document; texts
    without such a run have no row. Found as repeated strings are, over words in place of
    characters (``hashed_words``), so blanks and line ends do not matter."""
    hashed = saved(hashed_words(docs, words), "words")
    rows = saved(hashed.select("origin", text_key(F.col("text")).alias("key"),
                              (F.octet_length("text") / WORD_BYTES).cast("long").alias("n")), "origins")
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # One slice for all strings of an anchor: its core is the gram.
    length = words * WORD_BYTES
    width = length - GRAM + 1
    sliced = cut_slices(hashed, length, width)
    discard(hashed)
    found = repeated_spans(sliced, "none", length, width, **options)
    # Whole words only: a run of equal words also matches itself between two words.
    cut = found.select("key", F.ceil(F.col("start") / WORD_BYTES).alias("start"), F.floor(F.col("stop") / WORD_BYTES).alias("stop"))
    cuts = cut.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("cuts"))

    def work(batches):
        for batch in batches:
            got = [sum(b - a for a, b in merged(c)) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.int64())], ["key", "covered"])

    per = cuts.mapInArrow(work, "key binary, covered long").join(copies, "key", "full")
    per = saved(per.select(F.col("key").alias("_key"), "covered", "rows"), "runs")
    # Texts that differ in blanks alone are copies here, each with an origin of its own.
    shared = F.when(F.col("rows").isNotNull(), F.col("n")).otherwise(F.col("covered"))
    met = rows.join(per, F.col("key") == F.col("_key")).groupBy("origin").agg(F.max(shared).alias("n_shared"))
    out = saved(met, "shared")
    discard(rows, found, per)
    return out


def without_repeats(docs: DataFrame, keep: str = "none", length: int = LENGTH, passage: int | None = None,
                    **options) -> DataFrame:
    """One row per document: doc_id, text (binary, what is kept), n_bytes, n_removed, n_spans;
    and with ``passage`` n_shared, the words in runs of that many words that stand elsewhere too
    (``shared_words``), whether or not their bytes are removed."""
    text = text_of(docs)
    rows = docs.select(text_key(text).alias("key"), doc_id_of(docs).alias("doc_id"), text.cast("binary").alias("text"))
    copies = rows.select("key", "doc_id", F.octet_length("text").alias("n")).where(F.col("n") >= length)
    copies = copies.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("least")).where("rows > 1")
    cut = spans(docs, keep, length, **options)
    per = cut.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("cuts"))
    per = per.join(copies, "key", "full")
    if passage:
        shared = shared_words(docs, passage)
        per = per.join(shared.withColumnRenamed("origin", "key"), "key", "full")
    else:
        per = per.withColumn("n_shared", F.lit(None).cast("long"))
    per = saved(per.select(F.col("key").alias("_key"), "cuts", "rows", "least", "n_shared"), "cuts")
    discard(cut, *([shared] if passage else []))
    again = F.col("rows").isNotNull()
    if keep == "first":
        again = again & ~F.col("doc_id").eqNullSafe(F.col("least"))
    rows = rows.join(per, F.col("key") == F.col("_key"), "left").select(
        "doc_id", "text", "cuts", F.coalesce(again, F.lit(False)).alias("again"),
        F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"))

    def work(batches):
        for batch in batches:
            out = []
            for d, text, cuts, whole, shared in zip(*(batch.column(i) for i in range(5))):
                raw = text.as_py()
                runs = [(0, len(raw))] if whole.as_py() else merged(cuts.as_py() or [])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                out.append((d.as_py(), b"".join(kept), len(raw), sum(b - a for a, b in runs), len(runs), shared.as_py()))
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "n_shared"])

    out = rows.mapInArrow(work, "doc_id long, text binary, n_bytes long, n_removed long, n_spans long, n_shared long")
    return out if passage else out.drop("n_shared")


def merged(cuts: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of sorted, overlapping or touching stretches."""
    runs: list[list[int]] = []
    for c in cuts:
        if runs and c["start"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], c["stop"])
        else:
            runs.append([c["start"], c["stop"]])
    return [tuple(r) for r in runs]


def op4_suffix_array_dedup(spark, sf_dir):
    """Query: bytes under repeated 400-byte strings, removed from all documents. Beside the
    contract's columns, n_shared_words and has_passage (any) tell of runs of over 50 words that
    stand elsewhere too; many of them are shorter than 400 bytes and stay in the text."""
    out = without_repeats(documents(spark, sf_dir), passage=PASSAGE_WORDS)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"),
                      F.col("n_shared").alias("n_shared_words"), (F.col("n_shared") > 0).alias("has_passage"))


ship(__name__)
