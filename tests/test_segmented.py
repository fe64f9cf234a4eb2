"""Skew-safe per-key scans against pandas brute force."""
import random

import pandas as pd
from pyspark.sql import functions as F

from lakeward.operators.segmented import next_value, number_bucket, running_sums


def data(spark, n=800, seed=1):
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 9)}", i, rnd.randint(-3, 9))
            for i in rnd.sample(range(10_000), n)]
    return rows, spark.createDataFrame(rows, "k string, pos long, v int")


def test_running_sums(spark):
    rows, df = data(spark)
    out = running_sums(df, ["k"], [F.col("pos")], {"cs": F.col("v"), "cnt": F.lit(1)},
                       number_bucket("pos", 97)).toPandas()
    p = pd.DataFrame(rows, columns=["k", "pos", "v"]).sort_values(["k", "pos"])
    p["cs"] = p.groupby("k")["v"].cumsum()
    p["cnt"] = p.groupby("k").cumcount() + 1
    m = out.merge(p, on=["k", "pos"], suffixes=("", "_e"))
    assert len(m) == len(rows)
    assert (m["cs"] == m["cs_e"]).all() and (m["cnt"] == m["cnt_e"]).all()


def test_next_value(spark):
    rows, df = data(spark, seed=2)
    out = next_value(df, ["k"], "pos", "pos", number_bucket("pos", 53), "nxt").toPandas()
    p = pd.DataFrame(rows, columns=["k", "pos", "v"]).sort_values(["k", "pos"])
    p["nxt_e"] = p.groupby("k")["pos"].shift(-1)
    m = out.merge(p, on=["k", "pos"])
    assert ((m["nxt"].isna() & m["nxt_e"].isna()) | (m["nxt"] == m["nxt_e"])).all()
