import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeward.llm import merkle as M
from conftest_llm import DOCUMENTS, ODD, docs, many  # noqa: F401

NONE = hashlib.sha256(b"").hexdigest()


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(own):
    out = [own]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([H(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return out


def brute(table):
    """table: (doc_id, text, lang, source, n_chars) rows."""
    trees = {}
    for doc_id, text, lang, source, n_chars in table:
        own = leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        more = None if n_chars is None else n_chars + 1
        trees.setdefault(lang, []).append((doc_id, own, leaf(doc_id, source, lang, more, text) if hit else own))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    built = {s: levels([r[1] for r in trees[s]]) for s in names}
    top = levels([built[s][-1][0] for s in names]) if names else []
    out = []
    for t, s in enumerate(names):
        for i, (doc_id, own, now) in enumerate(trees[s]):
            proof = []
            for part, at in ((built[s], i), (top, t)):
                for level in part[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else None
                    if other:
                        proof.append(other)
                    now = H(other, now) if at % 2 else H(now, other or "")
                    at //= 2
            root = top[-1][0]
            out.append((doc_id, own, built[s][-1][0], root, H(*proof), now, now == root))
    return sorted(out, key=str)


def table_of(n=150):
    rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in ODD + many(4, 20)]
    langs = ["de", None, "日本", "Z", "a", "é", "one"]
    rows += [(1000 + i, f"text {i}", langs[min(i % 9, 5)], None, i if i % 5 else None) for i in range(n)]
    return rows + [(5000, "alone", "only", "s", 5)]


@pytest.mark.parametrize("stride", [1, 2, 8])
def test_matches_brute_force_at_any_stride(spark, stride):
    table = table_of()
    frame = spark.createDataFrame(table, DOCUMENTS)
    got = M.verify(frame, M.tampered(frame), stride)
    assert sorted(map(tuple, got.collect()), key=str) == brute(table)


def test_one_language_one_leaf_and_none(spark):
    for table in ([(1, "x", "en", "s", 1)], [(i, "x", None, "s", 1) for i in range(5)], []):
        frame = spark.createDataFrame(table, DOCUMENTS)
        got = M.verify(frame, M.tampered(frame)).collect()
        assert sorted(map(tuple, got), key=str) == brute(table)
    frame = spark.createDataFrame([(2, "x", "en", "s", 1)], DOCUMENTS)
    row = M.verify(frame).head()
    assert row.proof_sha256 == NONE and row.leaf == row.root == row.subroot and row.verified


def test_a_tree_wider_than_two_pages_and_a_shuffled_climb(spark, monkeypatch):
    monkeypatch.setattr(M, "BROADCAST_NODES", 0)
    table = [(i, f"t{i}", "en" if i % 10 else "de", "s", i) for i in range(700)]
    frame = spark.createDataFrame(table, DOCUMENTS).repartition(7)
    assert sorted(map(tuple, M.verify(frame, M.tampered(frame), 3).collect()), key=str) == brute(table)


def test_a_changed_text_is_found_by_any_probe(spark):
    table = [(i, f"t{i}", "en", "s", i) for i in range(40)]
    frame = spark.createDataFrame(table, DOCUMENTS)
    values = {f: frame[f] for f in M.FIELDS} | {"text": F.when(frame["doc_id"] == 17, "other").otherwise(frame["text"])}
    got = M.verify(frame, M.leaf_hash(values))
    assert [r.doc_id for r in got.where("not verified").collect()] == [17]


def test_stored_nodes_link_to_their_parents(spark):
    table = [(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(90)]
    manifest = M.build(spark.createDataFrame(table, DOCUMENTS), stride=2)
    nodes = {(r.tree, r.stage, r.idx): (r.up_tree, r.up_stage, r.up_idx) for r in manifest.nodes.collect()}
    assert len(nodes) == manifest.n_nodes
    for r in manifest.leaves.collect():
        at, steps = (r.up_tree, r.up_stage, r.up_idx), 0
        while at in nodes:
            at, steps = nodes[at], steps + 1
        assert at[0] == M.ABOVE and steps < 5


def test_values_cannot_move_between_fields(spark):
    table = [(1, "ab", "c", "s", 1), (1, "b", "c", "sa", 1), (1, None, "-", "-", 1), (1, "-", None, "-", 1)]
    got = M.verify(spark.createDataFrame(table, DOCUMENTS)).collect()
    assert len({r.leaf for r in got}) == 4
