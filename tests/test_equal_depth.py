"""SCD-01: slices of equal depth from a quantile sketch; full instants reduced before they meet."""
import random

import pytest
from pyspark.sql import functions as F

from lakeward.operators import segmented as S
from lakeward.operators.scd2 import END, START, scd2_history
from test_scd2 import brute_force

SCHEMA = "key string, seq long, t string, u int"


def rows_of(seed, n=3000, base=1_700_000_000_000_000):
    """A key with 40 % of the rows; a third of all rows at one instant; microseconds, crowded at
    the start and thin later."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = "hot" if rnd.random() < 0.4 else rnd.choice([f"k{i}" for i in range(12)] + [None])
        seq = base if rnd.random() < 0.33 else base + int(rnd.random() ** 6 * 10**12)
        out.append((k, seq if rnd.random() > 0.01 else None, rnd.choice(["a", "b", None]), rnd.randint(0, 5)))
    return out


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(S, "MIN_SLICE_ROWS", 40)


@pytest.mark.parametrize("cuts", [1024, 7])
def test_history_with_hot_key_and_hot_instant(spark, small, monkeypatch, cuts):
    monkeypatch.setattr(S, "MAX_CUTS", cuts)
    monkeypatch.setattr(S, "CUT_STEP", 4)
    rows = rows_of(cuts)
    h = scd2_history(spark.createDataFrame(rows, SCHEMA), ["key"], "seq", ["t"], max_bucket_rows=60)
    got = sorted(((r.key, r[START], r[END], r.t, r.u) for r in h.collect()), key=str)
    assert got == brute_force([r for r in rows if r[1] is not None], 1)


def test_slices_are_even_and_ordered_and_instants_reduced(spark, small):
    df = spark.createDataFrame(rows_of(3, 6000), SCHEMA)
    out = S.with_equal_depth_bucket(df, ["key"], "seq", 100, ["t", "u"])
    hot = out.where("key = 'hot'")
    per = hot.groupBy(S.BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    per = sorted(map(tuple, per.collect()))
    assert len(per) > 10 and max(n for _, n, _, _ in per) <= 220     # of about 2,400 rows
    assert all(a[3] < b[2] for a, b in zip(per, per[1:]))
    # the hot instant of the hot key: one row, the greatest (t, u)
    instant = hot.groupBy("seq").count().orderBy(F.desc("count")).head()
    assert instant["count"] < 50
    base = df.where("key = 'hot' AND seq = 1700000000000000")
    kept = hot.where("seq = 1700000000000000").select("t", "u").collect()
    assert [tuple(r) for r in kept] == [tuple(base.orderBy(F.desc("t"), F.desc("u")).select("t", "u").head())]


def test_small_keys_are_one_slice(spark):
    df = spark.createDataFrame(rows_of(5, 200), SCHEMA)
    out = S.with_equal_depth_bucket(df, ["key"], "seq", 1_000_000, ["t", "u"])
    assert [r[0] for r in out.select(S.BUCKET).distinct().collect()] == [0]
    assert out.count() == df.where("seq IS NOT NULL").count()


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "double"])
def test_other_sequence_types(spark, small, kind):
    rnd = random.Random(9)
    rows = [("hot" if i % 2 else f"k{i % 5}", rnd.randint(0, 300), rnd.choice("ab"), i) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    as_kind = {"date": "date_add(DATE'2020-01-01', cast(seq as int))", "double": "cast(seq as double) / 8",
               "timestamp_ntz": "cast(timestamp_seconds(seq) as timestamp_ntz)"}[kind]
    by = df.withColumn("at", F.expr(as_kind)).select("key", "at", "t", "u")
    h = scd2_history(by, ["key"], "at", ["t"], max_bucket_rows=50)
    assert h.count() == len(brute_force(rows, 1))
    assert h.where(f"{END} IS NULL").count() == len({r[0] for r in rows})
