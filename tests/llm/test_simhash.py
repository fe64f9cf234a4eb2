import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lakeward.llm import components as C
from lakeward.llm import simhash as S
from conftest_llm import ODD, docs, many  # noqa: F401


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(rows):
    fp = [plain_fingerprint(r[1]) for r in rows]
    near = [(i, j) for i, j in combinations(range(len(rows)), 2) if (fp[i] ^ fp[j]).bit_count() <= 4]
    label = classes(range(len(rows)), near)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(least.get(label[i], r[0]), r[0])
    return [(r[0], f"{fp[i]:016x}", least.get(label[i])) for i, r in enumerate(rows)]


def test_every_four_positions_hold_a_triple():
    assert len(S.TRIPLES) == 20
    assert all(any(set(t) <= set(q) for t in S.TRIPLES) for q in combinations(range(8), 4))


def test_components_match_brute_force(docs):
    rows = ODD + many(3, 120)
    got = sorted((tuple(r) for r in S.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    assert len({r[2] for r in got}) < len({r[1] for r in got})


def clustered(seed, n):
    """Fingerprints in clusters, some chains of links of 4 bits."""
    rng = np.random.default_rng(seed)
    out = [int(rng.integers(0, 1 << 63))]
    while len(out) < n:
        if rng.random() < 0.1:
            out.append(int(rng.integers(0, 1 << 63)))
        else:
            x = out[rng.integers(0, len(out))]
            for b in rng.integers(0, 63, rng.integers(1, 6)):
                x ^= 1 << int(b)
            out.append(x)
    return sorted(set(out))


def test_links_span_the_components_however_lists_are_cut(spark):
    fps = clustered(5, 400)
    want = classes(fps, [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4])
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    for tile in (2048, 3):
        links = [(r.a, r.b) for r in S.links(table, tile=tile).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        assert classes(fps, links) == want


def test_component_labels_follow_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 1500), (1500, 1700)],
                                  "a long, b long")
    labels = {r.node: r.label for r in C.component_labels(links).collect()}
    assert {labels[i] for i in range(301)} == {0} and labels[2000] == labels[1500] == labels[1700] == 1500


def test_drop_keeps_one_of_each_component(docs):
    rows = ODD + many(3, 120)
    table = docs(rows).withColumn("fp", F.lit(1)).withColumn("sha", F.lit(2)).withColumn("row", F.lit(3))
    kept = S.drop_near(table)
    assert kept.columns == table.columns
    want = brute(rows)
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got) == sorted({r[2] for r in want})


def test_long_text():
    text = " ".join(f"w{i % 977}" for i in range(80_000))
    assert S.fingerprint(text.encode()) == plain_fingerprint(text)


def test_empty(docs):
    assert S.near_duplicates(docs([])).collect() == []
    assert S.drop_near(docs([])).collect() == []
