import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries=V.ENTRIES, rounds=V.ROUNDS):
    """Plain Lloyd rounds in whole numbers: every part scans every entry."""
    rows = [(i, [float(np.float32(v)) for v in x], lab) for i, x, lab in rows
            if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return []
    n = -(-max(len(r[1]) for r in rows) // 4)
    xs = [[math.floor(1024 * v) for v in r[1]] + [0] * (4 * n - len(r[1])) for r in rows]
    cut = [[x[p * n:(p + 1) * n] for p in range(4)] for x in xs]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(4)]
    far = lambda a, b: sum((u - v) ** 2 for u, v in zip(a, b))
    nearest = lambda: [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(4)] for c in cut]
    for _ in range(rounds):
        got = nearest()
        for p in range(4):
            for k in range(len(books[p])):
                own = [c[p] for c, g in zip(cut, got) if g[p][1] == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    got = nearest()
    errors = [sum(d for d, _ in g) for g in got]
    labels = {}
    for r, e in zip(rows, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in g), e, labels[r[2]], sha)
                   for r, g, e in zip(rows, got, errors)), key=str)


def table_of(n=330, size=8, seed=5):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    rows = [(i, [c + rnd.gauss(0, 0.2) for c in rnd.choice(centres)], rnd.choice([None, 0, 1, 2])) for i in range(n)]
    same = rows[3][1]
    rows += [(1000 + i, list(same), 1) for i in range(40)] + [(3, list(same), rows[3][2])]  # copies and a repeated row
    rows += [(-5, None, 1), (-4, [None] * size, 1), (-3, [float("nan")] * size, 1), (-2, [float("inf")] + [0.0] * (size - 1), None)]
    return rows + [(None, [0.5] * size, None)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 6])
def test_matches_plain_rounds(spark, parts):
    rows = table_of()
    got = rows_of(V.compress(spark.createDataFrame(rows, SCHEMA).repartition(parts)))
    assert got == brute(rows)


def test_few_short_empty_and_no_vectors(spark):
    for rows in ([(1, [0.1, 0.2, 0.3, 0.4], 1)], [(1, [], 1), (2, [], None)], [(1, [], 1), (2, [1.0, -1.0, 3.0], 2), (3, [2.0] * 9, 2)],
                 [(1, None, None)], []):
        assert rows_of(V.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_extra_columns_change_nothing(spark):
    table = spark.createDataFrame(table_of(60, 4), SCHEMA)
    extra = table
    for c in ("code", "far", "x", "error", "label_error", "total", "_label", "part", "entry", "n"):
        extra = extra.withColumn(c, F.lit("x"))
    assert rows_of(V.compress(extra)) == rows_of(V.compress(table))


def test_components_beyond_a_long_are_bounded(spark):
    rows = [(1, [1e30, 0.0, -1e30, 1.0], 1), (2, [0.0, 0.0, 0.0, 0.0], 1), (3, [4e5, -4e5, 4e5, 7.0], 2)]
    got = {r.vec_id: r for r in V.compress(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3 and all(r.error >= 0 for r in got.values())
    rows = [(i, [4e3 * i, -1e5, 3.5 * i, 9e4], 1) for i in range(300)]
    assert rows_of(V.compress(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


@pytest.mark.parametrize("exact", [True, False])
def test_active_entries_give_a_full_scans_entries(exact):
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (400, 3))
    book = rng.integers(-3, 4, (20, 3))  # few values: many ties
    code, far = V.assign(x, book, None, None, np.ones(20, bool), exact)
    for _ in range(12):
        new = book.copy()
        some = rng.choice(20, 4, replace=False)
        new[some] = rng.integers(-3, 4, (4, 3))
        code, far = V.assign(x, new, code, far, (new != book).any(1), exact)
        d = ((x[:, None] - new[None]) ** 2).sum(2)
        assert (code == d.argmin(1)).all() and (far == d.min(1)).all()
        book = new


def test_only_moved_entries_are_compared(monkeypatch):
    seen = []
    plain = V.distances
    monkeypatch.setattr(V, "distances", lambda x, e, exact: seen.append((len(x), len(e))) or plain(x, e, exact))
    x, book = np.arange(40).reshape(-1, 1), np.array([[0], [10], [20], [30]])
    code, far = V.assign(x, book, None, None, np.ones(4, bool), True)
    moved = np.array([False, True, False, False])
    V.assign(x, np.array([[0], [11], [20], [30]]), code, far, moved, True)
    own = int((code == 1).sum())
    assert seen == [(40, 4), (own, 4), (40 - own, 1)]
