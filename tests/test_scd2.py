"""SCD-01/03/04, QA-21/22, JN-05: type-2 history semantics, skew-safe buckets, overlap
metrics (the self-join pair count without forming pairs)."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeward.operators.scd2 import (END, START, reference_overlaps, scd2_history, split_counts,
                                     strict_overlaps)

D0 = dt.datetime(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def feed(spark):
    rows = [  # FIXTURES.md §5 (seq 4 arrives last)
        (day(1), "nm0000001", "Ann Lee", None, "actor", None),
        (day(2), "nm0000001", "Ann Lee", None, "actor", 1950),
        (day(3), "nm0000001", "Ann Roe", None, "actor", 1950),
        (day(5), "nm0000001", "Ann Lee", None, "actor", 1950),
        (day(4), "nm0000001", "Ann Roe", 2020, "actor", 1950),
        (day(1), "nm0000002", "Bo Ek", None, None, 1970),
    ]
    return spark.createDataFrame(rows, "load_dt timestamp, nconst string, primaryName string, "
                                       "deathYear int, primaryProfession string, birthYear int")


TRACKED = ["primaryName", "deathYear", "primaryProfession"]


@pytest.mark.parametrize("width", [1, 86400, 86400 * 2, 86400 * 1000])
def test_fixture_versions(spark, width):
    h = scd2_history(feed(spark), ["nconst"], "load_dt", TRACKED, bucket_width=width)
    got = sorted((r.nconst, r[START], r[END], r.primaryName, r.deathYear, r.birthYear)
                 for r in h.collect())
    assert got == [
        ("nm0000001", day(1), day(3), "Ann Lee", None, 1950),   # birthYear refreshed in place
        ("nm0000001", day(3), day(4), "Ann Roe", None, 1950),
        ("nm0000001", day(4), day(5), "Ann Roe", 2020, 1950),
        ("nm0000001", day(5), None, "Ann Lee", None, 1950),
        ("nm0000002", day(1), None, "Bo Ek", None, 1970),
    ]
    s = split_counts(h, ["nconst"]).collect()[0]
    assert (s.current_rows, s.historical_rows, s.total_rows, s.distinct_keys) == (2, 3, 5, 2)
    assert strict_overlaps(h, ["nconst"]).collect()[0].overlaps == 0
    assert reference_overlaps(h, ["nconst"]).collect()[0].pairs == 0


def test_ties_collapse_to_greatest(spark):
    df = spark.createDataFrame([(1, "k", "a", 1), (1, "k", "b", 2), (2, "k", "b", 3)],
                               "seq long, key string, t string, u int")
    h = scd2_history(df, ["key"], "seq", ["t"], bucket_width=1)
    # (k, 1) ties: greatest struct (t, u) = ("b", 2) wins -> one version "b" from 1
    assert [(r.t, r.u, r[START], r[END]) for r in h.collect()] == [("b", 3, 1, None)]


def test_a_b_a_gives_three_versions(spark):
    df = spark.createDataFrame([(1, "k", "A"), (2, "k", "B"), (3, "k", "A")],
                               "seq long, key string, t string")
    h = scd2_history(df, ["key"], "seq", ["t"])
    assert sorted((r[START], r[END], r.t) for r in h.collect()) == \
        [(1, 2, "A"), (2, 3, "B"), (3, None, "A")]


def test_null_tracked_values_are_compared_null_safe(spark):
    df = spark.createDataFrame([(1, "k", None), (2, "k", None), (3, "k", "x"), (4, "k", None)],
                               "seq long, key string, t string")
    h = scd2_history(df, ["key"], "seq", ["t"], bucket_width=1)
    assert sorted((r[START], r[END], r.t) for r in h.collect()) == \
        [(1, 3, None), (3, 4, "x"), (4, None, None)]


def brute_force(rows, ntracked):
    """Per key in seq order: versions as (key, start, end, last row values)."""
    def rank(vals):  # Spark struct order: a NULL field sorts lowest
        return tuple((v is not None, v) for v in vals)

    by = {}
    for r in rows:
        cur = by.setdefault(r[0], {}).get(r[1])
        if cur is None or rank(r[2:]) > rank(cur):
            by[r[0]][r[1]] = r[2:]
    out = []
    for k, seqs in by.items():
        order = sorted(seqs)
        versions = []
        for s in order:
            vals = seqs[s]
            if not versions or versions[-1][1][:ntracked] != vals[:ntracked]:
                versions.append([s, vals])
            else:
                versions[-1][1] = vals
        for i, (s, vals) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((k, s, end) + tuple(vals))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [3, 50, 10_000])
def test_random_against_brute_force_with_hot_key(spark, width):
    rnd = random.Random(7)
    rows = []
    for i in range(1500):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        rows.append((k, rnd.randint(0, 400), rnd.choice(["a", "b", None]), rnd.randint(0, 5)))
    df = spark.createDataFrame(rows, "key string, seq long, t string, u int")
    h = scd2_history(df, ["key"], "seq", ["t"], bucket_width=width)
    got = sorted(((r.key, r[START], r[END], r.t, r.u) for r in h.collect()), key=str)
    assert got == brute_force(rows, 1)


def test_overlap_metrics_against_self_join(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(300):
        k = rnd.randint(0, 5)
        s = rnd.randint(0, 100)
        e = None if rnd.random() < 0.15 else s + rnd.randint(1, 30)
        rows.append((k, s, e))
    df = spark.createDataFrame(rows, "k int, s long, e long")
    pairs = sum(1 for a in rows for b in rows
                if a[0] == b[0] and a[2] is not None and b[2] is not None
                and a[1] < b[2] and a[2] > b[1] and a[1] != b[1])
    assert reference_overlaps(df, ["k"], "s", "e", 7).collect()[0].pairs == pairs
    strict = 0
    for k in {r[0] for r in rows}:
        rs = sorted((r for r in rows if r[0] == k),
                    key=lambda r: (r[1], -1 if r[2] is None else 0, r[2] or 0))
        for a, b in zip(rs, rs[1:]):
            strict += a[2] is None or b[1] < a[2]
    assert strict_overlaps(df, ["k"], "s", "e", 7).collect()[0].overlaps == strict


def test_plan_exchanges_by_key_and_bucket(spark):
    """Exchanges on the key also have the time bucket (or the per-bucket carry table below)."""
    h = scd2_history(feed(spark), ["nconst"], "load_dt", TRACKED)
    plan = h._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.split("\n") if "hashpartitioning(nconst" in x]
    assert any("hashpartitioning(nconst" in x and x.count("#", 0, x.index(")")) >= 2 for x in dealt)


def test_stream_writer_replay_and_out_of_order(spark, tmp_path):
    """SCD-02: batches in any order equal the batch history; a replayed batch id is a no-op."""
    from lakeward.streaming.scd2_stream import Scd2Writer, read_dimension
    df = feed(spark)
    w = Scd2Writer(str(tmp_path / "dim"), str(tmp_path / "log"), ["nconst"], "load_dt", TRACKED,
                   key_buckets=3)
    b1 = df.filter(F.col("load_dt") >= day(4))          # later rows first
    b2 = df.filter(F.col("load_dt") < day(4))
    w(b1, 0)
    w(b2, 1)
    expected = sorted(map(str, scd2_history(df, ["nconst"], "load_dt", TRACKED).collect()))

    def current():
        d = read_dimension(spark, str(tmp_path / "dim"))
        return sorted(map(str, d.select(*df.columns, START, END).collect()))
    assert current() == expected
    w(b2, 1)                                             # re-delivered batch
    assert current() == expected


@pytest.mark.parametrize("hot_rows", [50, 300])
def test_dense_slices_cut_finer_same_result(spark, hot_rows):
    """Adaptive buckets: a (key, slice) crowded with rows is cut finer; result unchanged."""
    rnd = random.Random(11)
    rows = [("hot", rnd.randint(0, 100), rnd.choice(["a", "b"]), rnd.randint(0, 9)) for _ in range(900)]
    rows += [(f"k{i % 7}", rnd.randint(0, 5000), rnd.choice(["a", "b"]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, seq long, t string, u int")
    h = scd2_history(df, ["key"], "seq", ["t"], bucket_width=1000, max_bucket_rows=hot_rows)
    got = sorted(((r.key, r[START], r[END], r.t, r.u) for r in h.collect()), key=str)
    assert got == brute_force(rows, 1)
    assert h.columns == ["key", "seq", "t", "u", START, END]


def test_null_sequence_rows_are_not_applied(spark):
    df = spark.createDataFrame([(None, "k", "Z"), (1, "k", "A"), (2, "k", "B")],
                               "seq long, key string, t string")
    h = scd2_history(df, ["key"], "seq", ["t"])
    assert sorted((r[START], r[END], r.t) for r in h.collect()) == [(1, 2, "A"), (2, None, "B")]


def test_overlap_metrics_with_dense_slices(spark):
    """QA-22 with tiny max_bucket_rows: dense slices are cut finer, counts unchanged."""
    rnd = random.Random(5)
    rows = []
    for _ in range(400):
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, 4)
        s = rnd.randint(0, 50)
        rows.append((k, s, None if rnd.random() < 0.1 else s + rnd.randint(1, 20)))
    df = spark.createDataFrame(rows, "k int, s long, e long")
    a = reference_overlaps(df, ["k"], "s", "e", 10).collect()[0].pairs
    b = reference_overlaps(df, ["k"], "s", "e", 10, max_bucket_rows=20).collect()[0].pairs
    c = strict_overlaps(df, ["k"], "s", "e", 10).collect()[0].overlaps
    d = strict_overlaps(df, ["k"], "s", "e", 10, max_bucket_rows=20).collect()[0].overlaps
    assert a == b and c == d and a > 0 and c > 0


def test_stream_writer_in_order_fast_path(spark, tmp_path):
    """SCD-02 fast path: in-order batches touch only open versions; an out-of-order batch and
    a replay take the full path; every state equals the batch history of all rows so far."""
    from lakeward.streaming.scd2_stream import Scd2Writer, read_dimension
    rnd = random.Random(21)
    batches, seq = [], 0
    for b in range(5):
        rows = []
        for _ in range(60):
            seq += rnd.randint(1, 3)
            rows.append(("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 8)}", seq,
                         rnd.choice(["a", "b", None]), rnd.randint(0, 9)))
        batches.append(rows)
    late = [(f"k{i}", 5 + i, "z", 99) for i in range(3)]   # arrives after, sequenced early
    later = [(f"k{i}", 7 + i, "y", 98) for i in range(3)]  # another all-late batch
    w = Scd2Writer(str(tmp_path / "dim"), str(tmp_path / "log"), ["key"], "seq", ["t"],
                   key_buckets=4)
    schema = "key string, seq long, t string, u int"
    seen, paths = [], []

    def check():
        got = sorted(((r.key, r[START], r[END], r.t, r.u)
                      for r in read_dimension(spark, str(tmp_path / "dim")).collect()), key=str)
        assert got == brute_force(seen, 1)

    plan = [(0, batches[0]), (1, batches[1]), (2, batches[2]), (3, late + batches[3]),
            (4, later), (5, batches[4])]
    for bid, rows in plan:
        w(spark.createDataFrame(rows, schema), bid)
        seen += rows
        paths.append(w.last_path)
        check()
    # a few late rows -> per-key mixed path; only late rows -> full recompute
    assert paths == ["full", "in_order", "in_order", "mixed", "full", "in_order"]
    w(spark.createDataFrame(batches[4], schema), 5)        # replay of the last batch
    assert w.last_path == "full"
    check()


def test_null_key_is_its_own_key_batch_and_stream(spark, tmp_path):
    """NULL key values form one key (joins are NULL-safe), in batch and in the stream's
    in-order fast path."""
    from lakeward.streaming.scd2_stream import Scd2Writer, read_dimension
    b1 = [(None, 1, "a", 1), (None, 2, "b", 2), ("k", 1, "a", 3)]
    b2 = [(None, 3, "b", 4), (None, 4, "a", 5), ("k", 5, "c", 6)]
    schema = "key string, seq long, t string, u int"
    h = scd2_history(spark.createDataFrame(b1 + b2, schema), ["key"], "seq", ["t"])
    want = sorted(((r.key, r[START], r[END], r.t, r.u) for r in h.collect()), key=str)
    assert want == brute_force(b1 + b2, 1)
    w = Scd2Writer(str(tmp_path / "dim"), str(tmp_path / "log"), ["key"], "seq", ["t"],
                   key_buckets=2)
    w(spark.createDataFrame(b1, schema), 0)
    w(spark.createDataFrame(b2, schema), 1)
    assert w.last_path == "in_order"
    got = sorted(((r.key, r[START], r[END], r.t, r.u)
                  for r in read_dimension(spark, str(tmp_path / "dim")).collect()), key=str)
    assert got == want


def _files(root):
    return {str(p): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_an_in_order_batch_writes_open_versions_and_what_it_closes(spark, tmp_path):
    """SCD-02: 100 changed keys against 64,000 stored rows: no closed version is written again,
    open versions of the touched buckets only, and a current read lists no closed file."""
    from lakeward.streaming.scd2_stream import Scd2Writer, read_current, read_dimension
    target = tmp_path / "dim"
    w = Scd2Writer(str(target), str(tmp_path / "log"), ["key"], "seq", ["t"], key_buckets=64)
    history = spark.range(64_000).selectExpr("id % 8000 AS key", "id AS seq", "concat('v', id div 8000) AS t", "id AS u")
    w(history, 0)
    assert w.written == [{"open": 8000, "closed": 56_000}]
    before = _files(target)
    change = spark.range(100).selectExpr("id * 3 AS key", "100000 + id AS seq", "'new' AS t", "id AS u")
    w(change, 1)
    assert w.last_path == "in_order"
    after = _files(target)
    closed = lambda files: {f: t for f, t in files.items() if "_part=closed" in f}
    assert {f: t for f, t in closed(after).items() if "_batch=1" not in f} == closed(before)
    touched = {f.split("_kb=")[1].split("/")[0] for f in after if "_batch=1/" in f}
    rewritten = {f.split("_kb=")[1].split("/")[0] for f, t in after.items() if "_part=open" in f and before.get(f) != t}
    assert rewritten == touched and len(touched) < 64
    stored = spark.read.parquet(str(target))
    in_touched = stored.filter("_part = 'open'").filter(F.col("_kb").isin(sorted(map(int, touched)))).count()
    assert w.written[1] == {"open": in_touched, "closed": 100}
    got = read_dimension(spark, str(target))
    want = scd2_history(history.unionByName(change), ["key"], "seq", ["t"])
    assert got.count() == 64_100 and got.exceptAll(want.select(*got.columns)).isEmpty()
    current = read_current(spark, str(target))
    assert current.count() == 8000 and not any("_part=closed" in f for f in current.inputFiles())


class _Dies(Exception):
    pass


@pytest.mark.parametrize("step", ["log", "removed", "written"])
def test_a_batch_that_fails_anywhere_is_right_after_its_replay(spark, tmp_path, step, monkeypatch):
    """SCD-02: the batch dies after its log, after removing closed folders of late buckets, or
    after writing only some buckets; delivered again it gives the batch history."""
    from lakeward.streaming import scd2_stream as X
    rnd = random.Random(31)
    make = lambda lo, hi, n: [(f"k{rnd.randint(0, 20)}", rnd.randint(lo, hi), rnd.choice("ab"), rnd.randint(0, 9))
                              for _ in range(n)]
    batches = [make(0, 100, 120), make(101, 200, 40) + [("k1", 50, "z", 1), ("k2", 3, "y", 2)], make(201, 300, 30)]
    schema = "key string, seq long, t string, u int"
    w = X.Scd2Writer(str(tmp_path / "dim"), str(tmp_path / "log"), ["key"], "seq", ["t"], key_buckets=8)
    w(spark.createDataFrame(batches[0], schema), 0)
    second = spark.createDataFrame(batches[1], schema)
    write = w._write_target

    def die(*args):
        raise _Dies

    def some(versions, batch_id):   # half of the buckets come through
        write(versions.filter(X.key_bucket(["key"], 8) % 2 == 0), batch_id)
        raise _Dies

    monkeypatch.setattr(w, {"log": "late_buckets", "removed": "_write_target", "written": "_write_target"}[step],
                        some if step == "written" else die)
    with pytest.raises(_Dies):
        w(second, 1)
    monkeypatch.undo()
    w(second, 1)
    w(spark.createDataFrame(batches[2], schema), 2)
    got = sorted(((r.key, r[START], r[END], r.t, r.u) for r in X.read_dimension(spark, str(tmp_path / "dim")).collect()), key=str)
    assert got == brute_force(sum(batches, []), 1)


def test_late_keys_rebuild_their_buckets_only(spark, tmp_path):
    """SCD-02: one late key; closed files of buckets without a late key stay as they are."""
    from lakeward.streaming.scd2_stream import Scd2Writer, read_dimension
    target = tmp_path / "dim"
    w = Scd2Writer(str(target), str(tmp_path / "log"), ["key"], "seq", ["t"], key_buckets=16)
    first = [(i % 50, i, "ab"[(i // 50) % 2], i) for i in range(200)]
    w(spark.createDataFrame(first, "key long, seq long, t string, u long"), 0)
    before = _files(target)
    second = [(7, 10, "late", 0)] + [(k, 500 + k, "n", 0) for k in range(20)]
    w(spark.createDataFrame(second, "key long, seq long, t string, u long"), 1)
    assert w.last_path == "mixed"
    gone = {f.split("_kb=")[1].split("/")[0] for f in before if "_part=closed" in f and f not in _files(target)}
    assert len(gone) == 1
    got = sorted(((r.key, r[START], r[END], r.t, r.u) for r in read_dimension(spark, str(target)).collect()), key=str)
    assert got == brute_force(first + second, 1)
    # a bucket whose open versions were lost is rebuilt from its log
    import shutil
    lost = next(iter(gone))
    shutil.rmtree(target / "_part=open" / f"_kb={lost}")
    third = [(7, 900, "x", 0)]
    w(spark.createDataFrame(third, "key long, seq long, t string, u long"), 2)
    got = sorted(((r.key, r[START], r[END], r.t, r.u) for r in read_dimension(spark, str(target)).collect()), key=str)
    assert w.last_path == "full" and got == brute_force(first + second + third, 1)
