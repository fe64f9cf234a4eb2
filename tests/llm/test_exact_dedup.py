import hashlib
from collections import defaultdict

from lakeward.llm import exact_dedup as X
from conftest_llm import ODD, docs, many  # noqa: F401


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        text = text or ""
        sha = hashlib.sha256("".join(c for c in text if c not in " \t\n\x0b\x0c\r").encode()).hexdigest()
        groups[sha].append((-len(text), doc_id is None, doc_id or 0, doc_id))
    out = []
    for sha, own in groups.items():
        own.sort(key=lambda r: r[:3])
        out += [(r[3], own[0][3], len(own), k == 0, sha) for k, r in enumerate(own)]
    return sorted(out, key=str)


def test_groups_match_brute_force(docs):
    rows = ODD + many()
    got = sorted((tuple(r) for r in X.exact_groups(docs(rows)).collect()), key=str)
    assert got == brute(rows)


def test_a_full_filter_changes_nothing(docs, monkeypatch):
    monkeypatch.setattr(X, "filter_bits", lambda rows: X.BITMAP_BITS)
    monkeypatch.setattr(X, "BITMAP_BITS", 8)
    rows = many(2)
    assert sorted((tuple(r) for r in X.exact_groups(docs(rows)).collect()), key=str) == brute(rows)


def test_drop_keeps_one_of_each_group_and_clashing_columns(spark, docs):
    rows = ODD + many()
    table = docs(rows).selectExpr("*", "doc_id as row", "text as _sha", "1 as _maybe", "2 as _pos0")
    kept = X.drop_exact(table)
    assert kept.columns == table.columns
    want = sorted((r[0], r[4]) for r in brute(rows) if r[3] and r[0] is not None)
    got = sorted((r.doc_id, hashlib.sha256("".join((r.text or "").split(" ")).translate(
        str.maketrans("", "", "\t\n\x0b\x0c\r")).encode()).hexdigest()) for r in kept.collect() if r.doc_id is not None)
    assert got == want
    assert kept.count() == len({r[4] for r in brute(rows)})


def test_empty(docs):
    assert X.exact_groups(docs([])).collect() == []
    assert X.drop_exact(docs([])).collect() == []


def test_filter_is_bounded():
    assert X.filter_bits(0) == X.BITMAP_BITS and X.filter_bits(10**13) == X.MAX_FILTER_BITS
