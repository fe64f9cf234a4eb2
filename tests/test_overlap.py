"""JN-05 / QA-22: the self-join metric by sweeps and dominance counts, for periods of any kind."""
import datetime as dt
import random

import pytest

from lakeward.operators import segmented as S
from lakeward.operators.scd2 import reference_overlaps


def pairs(rows):
    return sum(1 for a in rows for b in rows
               if a[0] == b[0] and None not in a and None not in b
               and a[1] < b[2] and a[2] > b[1] and a[1] != b[1])


def rows_with_hot_key(seed, n=500, span=60):
    """A key holds 40 % of the rows, of which most have ``start >= end``; copies and NULLs."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        hot = rnd.random() < 0.4
        s = rnd.randint(0, span)
        e = s - rnd.randint(0, 25) if rnd.random() < (0.7 if hot else 0.2) else s + rnd.randint(1, 25)
        out.append((0 if hot else rnd.choice([1, 2, 3, None]), rnd.choice([s, s, s, None]) if rnd.random() < 0.05 else s,
                    None if rnd.random() < 0.05 else e))
    return out + out[:40]


@pytest.mark.parametrize("width,most", [(7, None), (10, 20), (1000, None), (1000, 5)])
def test_degenerate_periods_equal_the_self_join(spark, width, most):
    rows = rows_with_hot_key(width + (most or 0))
    df = spark.createDataFrame(rows, "k int, s long, e long")
    assert reference_overlaps(df, ["k"], "s", "e", width, most).collect()[0].pairs == pairs(rows) > 0


def test_timestamps_and_only_degenerate_periods(spark):
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(8)
    rows = [(i % 2, t0 + dt.timedelta(hours=rnd.randint(0, 90)), t0 + dt.timedelta(hours=rnd.randint(0, 90))) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, s timestamp, e timestamp")
    assert reference_overlaps(df, ["k"], "s", "e", 86_400, 16).collect()[0].pairs == pairs(rows)
    rows = [(1, 5, 5), (1, 5, 2), (1, 3, 1)]
    df = spark.createDataFrame(rows, "k int, s long, e long")
    assert reference_overlaps(df, ["k"], "s", "e").collect()[0].pairs == pairs(rows) == 0
    assert reference_overlaps(df.limit(0), ["k"], "s", "e").collect()[0].pairs == 0


def test_dominance_count_and_no_join_of_periods(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 30), rnd.randint(0, 30), rnd.randint(0, 1), rnd.randint(1, 3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, _x long, _y long, _asks int, _w long")
    want = sum(q[4] * p[4] for q in rows for p in rows
               if q[3] and not p[3] and q[0] == p[0] and p[1] <= q[1] and p[2] >= q[2])
    got = S.dominated(df, ["k"], 9, 25)
    assert got.collect()[0].pairs == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
