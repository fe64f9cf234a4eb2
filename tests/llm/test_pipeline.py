"""The pipeline against brute force on a small table."""
from collections import Counter, defaultdict

import corpus_pipeline as P
import test_exact_dedup
import test_mixing
import test_packing
import test_quality
import test_simhash
from conftest_llm import ODD, docs, many  # noqa: F401


def expected(rows):
    """Rows after the first three stages, by brute force; doc_ids are distinct here."""
    rows = [r for r in rows if test_quality.brute(r[1])[-1]]
    stays = {r[0] for r in test_exact_dedup.brute(rows) if r[3]}
    rows = [r for r in rows if r[0] in stays]
    stays = {r[2] for r in test_simhash.brute(rows)}
    return [r for r in rows if r[0] in stays]


def sources(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[2] if len(r) > 2 else "s"] += test_mixing.size(r[1])
    return out


def test_run_matches_brute_force(spark, docs, tmp_path):
    rows = [(i, *r[1:]) for i, r in enumerate(many(11, 200) + ODD + test_quality.JUNK)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = P.run(spark, str(tmp_path)).collect()
    left = expected(rows)
    assert 20 < len(left) < len(rows) - 20
    by_id = {r[0]: r for r in left}
    taken = Counter(r.doc_id for r in got if r.piece == 0)
    assert set(taken) <= set(by_id) and set(taken.values()) <= {1, 2}
    sizes = sources(left)
    target = test_mixing.plain_targets(dict(sizes))
    words, longest = defaultdict(int), defaultdict(int)
    for d, n in taken.items():
        words[by_id[d][2]] += n * test_mixing.size(by_id[d][1])
    for r in left:
        longest[r[2]] = max(longest[r[2]], test_mixing.size(r[1]))
    assert all(abs(words[s] - target[s]) <= longest[s] for s in sizes)
    mixed = [by_id[d] for d, n in taken.items() for _ in range(n)]
    bins, total = test_packing.check(mixed, got, 2048)
    assert bins <= -(-total // 2048) + 2


def test_stages_take_odd_rows_and_empty_tables(spark, docs, tmp_path):
    for rows in (ODD + ODD, []):
        table = docs(rows).selectExpr("*", "1 as row", "2 as sha", "3 as fp")
        for name, stage in P.STAGES[:-1]:
            table = stage(spark, table, str(tmp_path))
            assert table.columns[-3:] == ["row", "sha", "fp"] and len(table.columns) == 8, name
        assert P.STAGES[-1][1](spark, table, str(tmp_path)).count() >= 0


def test_stages_keep_ordinary_rows_apart(spark, docs, tmp_path):
    """Documents that no stage has a reason to touch come through the filtering stages."""
    rows = [(i, r[1]) for i, r in enumerate(many(12, 60)) if i % 5 in (0, 4) and test_mixing.size(r[1]) >= 20]
    table = docs(rows)
    for name, stage in P.STAGES[:3]:
        table = stage(spark, table, str(tmp_path))
    assert sorted(r.doc_id for r in table.collect()) == [r[0] for r in rows]
