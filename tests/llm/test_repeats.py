import glob
import hashlib
import os
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeward.llm import repeats as R
from conftest_llm import ODD, docs, many  # noqa: F401


def brute(rows, length, keep="none"):
    """(doc_id, n_bytes, n_removed, n_spans, kept text) by looking every string up."""
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    key = lambda t: hashlib.md5(t).digest()
    least = {}
    for d, t in texts:
        if d is not None:
            least[t] = min(least.get(t, d), d)
    places = defaultdict(set)
    for n, (d, t) in enumerate(texts):
        for i in range(len(t) - length + 1):
            first = least.get(t)
            own = d == first
            places[t[i:i + length]].add((first is None, first or 0, key(t), i, 0 if own else 1, 0 if own else n))
    copies = defaultdict(int)
    for d, t in texts:
        copies[t, d if keep == "first" else None] += 1
    out = []
    for n, (d, t) in enumerate(texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            first = least.get(t)
            own = d == first
            me = (first is None, first or 0, key(t), i, 0 if own else 1, 0 if own else n)
            same = places[t[i:i + length]]
            if keep == "none":
                hit = len(same) > 1 or copies[t, None] > 1
            else:
                hit = min(same) != me
            if hit:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def passages(seed):
    """Texts sharing passages around the length, with varied surroundings; runs of one byte."""
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choices("abcdefgh é", k=k))
    shared = [text(rnd.randint(35, 90)) for _ in range(6)]
    rows = [(200 + i, text(rnd.randint(0, 60)) + rnd.choice(shared) + text(rnd.randint(0, 50)) +
             (rnd.choice(shared)[rnd.randint(0, 20):] if i % 2 else "")) for i in range(60)]
    return rows + [(300, "x" * 150), (301, "y" * 39), (302, "ab" * 60), (303, "zz" * 20), (304, "y" * 40),
                   (305, rows[0][1]), (306, rows[0][1] + "!")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("width,members", [(9, 20_000), (5, 3), (1, 20_000)])
def test_removed_bytes_match_brute_force(docs, keep, width, members):
    rows = ODD + passages(1)
    got = R.without_repeats(docs(rows), keep, length=40, width=width, max_members=members).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.text)) for r in got), key=str)
    assert got == brute(rows, 40, keep)


def test_production_length(docs):
    rnd = random.Random(4)
    shared = "".join(rnd.choices("abcdefghij ", k=700))
    rows = [(i, r[1] + shared[rnd.randint(0, 300):rnd.randint(400, 700)] + r[1][::-1]) for i, r in enumerate(many(8, 40))]
    rows += ODD + [(900, "q" * 2000), (901, rows[3][1])]
    got = R.without_repeats(docs(rows)).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.text)) for r in got), key=str)
    want = brute(rows, 400)
    assert got == want and sum(r[2] > 0 for r in want) > 10


def test_anchors_depend_on_the_string_alone():
    rnd = random.Random(2)
    text = bytes(rnd.choices(range(256), k=3000))
    own = {p for p, *_ in R.anchors(text)}
    starts = sorted((a, b, p) for p, a, b, _ in R.anchors(text))
    assert starts[0][0] == 0 and starts[-1][1] == len(text) - 400
    assert all(x[1] + 1 == y[0] for x, y in zip(starts, starts[1:]))
    for i in (0, 7, 1234):
        (p, *_), = R.anchors(text[i:i + 400])
        assert i + p in own
    assert R.anchors(b"a" * 399) == []


def test_anchors_across_chunks(monkeypatch):
    rnd = random.Random(3)
    text = bytes(rnd.choices(b"abc", k=5000)) + b"z" * 1000
    want = sorted(R.anchors(text))
    monkeypatch.setattr(R, "CHUNK", 777)
    assert sorted(R.anchors(text)) == want


def test_factors_are_longest_previous_factors():
    rnd = random.Random(5)
    for _ in range(50):
        text = "".join(rnd.choices("ab", k=12))
        order = sorted(range(12), key=lambda i: text[i:])
        lcps = [0] + [R.common(text[a:].encode(), text[b:].encode()) for a, b in zip(order, order[1:])]
        got = R.factors(order, lcps)
        for i, f in zip(order, got):
            assert f == max([R.common(text[i:].encode(), text[j:].encode()) for j in range(i)], default=-1)
        for k, (before, a, after, b) in enumerate(R.candidates(order, lcps)):
            assert before == max([x for x in range(k) if order[x] < order[k]], default=-1)
            assert after == min([x for x in range(k + 1, 12) if order[x] < order[k]], default=-1)
            for j, c in ((before, a), (after, b)):
                assert c == (-1 if j < 0 else R.common(text[order[k]:].encode(), text[order[j]:].encode()))


def test_extra_columns_and_empty(docs):
    table = docs(many(1, 10)).withColumn("key", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("cuts", F.lit(3))
    assert R.without_repeats(table).count() == 10
    assert R.without_repeats(docs([])).collect() == []


def brute_words(rows, need):
    """(doc_id, words in runs of ``need`` words that start elsewhere too), by looking runs up."""
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    places = defaultdict(int)
    for _, w in texts:
        for i in range(len(w) - need + 1):
            places[tuple(w[i:i + need])] += 1
    out = []
    for d, w in texts:
        hit = set()
        for i in range(len(w) - need + 1):
            if places[tuple(w[i:i + need])] > 1:
                hit.update(range(i, i + need))
        out.append((d, len(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_words_match_brute_force(docs, seed):
    """Runs of 51 words and more count, of 50 do not; blanks and line ends do not matter; short
    and long words; copies, texts of one word repeated, and every odd text."""
    rnd = random.Random(seed)
    words = ["a", "of", "the", "it", "Größe", "internationalisation", "x1", "данные", "so"] + [f"w{i}" for i in range(400)]
    text = lambda n: rnd.choices(words, k=n)
    shared = [text(n) for n in (50, 51, 52, 75, 120, 300)]
    rows = []
    for i in range(60):
        own = text(rnd.randint(0, 80)) + rnd.choice(shared) + text(rnd.randint(0, 80))
        if i % 3 == 0:
            own += rnd.choice(shared)[rnd.randint(0, 10):]
        rows.append((1000 + i, "".join(w + rnd.choice([" ", "  ", "\n", "\t"]) for w in own)))
    rows += [(2000, rows[0][1]), (2001, rows[1][1].replace(" ", "\r\n")), (2002, "so " * 50), (2003, "so " * 51),
             (2004, "go " * 53), (2005, "short of " * 10), (2006, rows[4][1]), (2006, rows[4][1])]
    rows += ODD
    got = R.without_repeats(docs(rows), passage=R.PASSAGE_WORDS).collect()
    want = brute_words(rows, 51)
    assert sorted(((r.doc_id, r.n_shared) for r in got), key=str) == want
    assert sum(n > 0 for _, n in want) > 20 and sum(n == 0 for _, n in want) > 10
    # The other columns are those of the plain run.
    plain = R.without_repeats(docs(rows)).collect()
    assert "n_shared" not in plain[0].asDict()
    bare = lambda rs: sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.text)) for r in rs), key=str)
    assert bare(plain) == bare(got)


def test_many_cores_at_once_match_strings_looked_up(monkeypatch):
    """Members of many cores in any order, in one call: x of the strings that stand in a member of
    their core of smaller rank (first kept) or in any other (all marked); bytes of zero, empty
    flanks, classes that take one step or several, small pieces of work."""
    import numpy as np
    rnd = random.Random(11)
    for rounds, expanded in ((64, 1 << 18), (0, 9), (1, 50)):
        monkeypatch.setattr(R, "ROUNDS", rounds)
        monkeypatch.setattr(R, "EXPANDED", expanded)
        for need in (0, 1, 5, 9):
            ranks = rnd.sample(range(1000), 90)
            flank = lambda: bytes(rnd.choices(b"\0a", k=rnd.randint(0, need)))
            rows = [(i % rnd.choice([3, 20]), flank(), flank(), ranks[i]) for i in range(90)]
            group, lefts, rights, ranks = zip(*rows)
            places = defaultdict(list)
            for i, (g, lf, rf, rank) in enumerate(rows):
                for x in range(need + 1):
                    if len(lf) >= x and len(rf) >= need - x:
                        places[g, x, lf[len(lf) - x:], rf[:need - x]].append((rank, i))
            for later in (False, True):
                want = defaultdict(list)
                for (_, x, *_), own in places.items():
                    for place in own:
                        if len(own) > 1 and (later or place != min(own)):
                            want[place[1]].append(x)
                least, most = R.repeated_starts(np.array(group), list(lefts), list(rights), np.array(ranks), need, later)
                got = {i: (a, b) for i, (a, b) in enumerate(zip(least.tolist(), most.tolist())) if b >= 0}
                assert got == {i: (min(x), max(x)) for i, x in want.items()}


def test_texts_hashed_together_have_their_own_anchors(monkeypatch):
    """Strings that lie in two texts are none; texts over the joined size go alone."""
    rnd = random.Random(12)
    monkeypatch.setattr(R, "JOINED", 5000)
    texts = [bytes(rnd.choices(b"ab ", k=rnd.choice([400, 401, 700, 4000, 9000]))) for _ in range(40)] + [b"z" * 900] * 3
    own, *cols = (c.tolist() for c in R.many_anchors(texts))
    assert list(zip(own, *cols)) == [(i, *a) for i, t in enumerate(texts) for a in R.anchors(t)]
    assert [len(c) for c in R.many_anchors([])] == [0] * 5


def test_what_is_read_goes_at_once(docs, spark, monkeypatch):
    """Each saved table leaves no shuffle files behind, the hashed words go once they are cut, and of
    all scratch tables the last one alone stays; strings counted one by one too."""
    from lakeward.session import work_dir
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for d in manager.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}
    tables = lambda: set(glob.glob(f"{work_dir(spark)}/lakeward/llm-*"))
    names = lambda paths: sorted(os.path.basename(p).split("-")[1] for p in paths)
    save, old, earlier, seen, left = R.save, shuffles(), tables(), [], []

    def watched(df, name):
        # Files are removed beside the caller, so a while after it has gone on; one wait is enough to fail.
        until = time.time() + 10
        while shuffles() - old and time.time() < until and not any(left):
            time.sleep(0.05)
        left.append(len(shuffles() - old))
        old.update(shuffles())
        seen.append((name, names(tables() - earlier)))
        return save(df, name)

    monkeypatch.setattr(R, "save", watched)
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = many(3, 40) + [(900, "so " * 300), (901, "to be " * 200)]
    out = R.without_repeats(docs(rows), passage=R.PASSAGE_WORDS, max_members=3)
    assert names(tables() - earlier) == ["cuts"]
    kinds = [there for name, there in seen if name == "kinds"]
    assert len(kinds) == 2 and not any("words" in there for there in kinds)
    assert len(left) > 15 and not any(left)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    assert sum(r.n_removed > 0 for r in out.collect()) > 5
