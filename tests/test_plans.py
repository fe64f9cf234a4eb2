"""Plan assertions: pruning, pushdown, broadcast behind a size check, shuffle counts."""
import os

from pyspark.sql import functions as F

import lakeward.plans.registry as R

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_the_scan(spark):
    df = R._t(spark, SF, "lineitem").groupBy("l_suppkey").count()
    p = plan(df)
    assert "ReadSchema: struct<l_suppkey:bigint>" in p


def test_filter_pushdown(spark):
    from lakeward.operators.expectations import expect
    from lakeward.specs import DROP, Rule
    df = expect(R._t(spark, SF, "orders"), [Rule("c", "o_custkey IS NOT NULL", DROP)])
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan(df)


def test_coded_dimension_broadcasts_the_lookup(spark):
    df = R._coded(spark, SF)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p or "Broadcast" in p


def test_orphan_check_aggregates_before_the_anti_join(spark):
    from lakeward.operators.checks import orphan_counts
    df = orphan_counts(R._t(spark, SF, "lineitem"), "l_orderkey", R._t(spark, SF, "orders"),
                       "o_orderkey")
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # the child side is an Aggregate on the key below the single (outer) join
    join = p.index("Join LeftOuter")
    assert "Aggregate [_k" in p[join:] and p.count("Join ") == 1


def test_scd2_rows_shuffle_once(spark):
    """The feed is exchanged once on (key, bucket); the carry branch reuses that exchange;
    no aggregate runs over the rows after it (only per-bucket SortAggregate on sorted data)."""
    import re
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = R._scd(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    row_exchanges = re.findall(r"\+- Exchange hashpartitioning\(user_id#\d+L, _b#\d+L", p)
    assert len(row_exchanges) == 1
    assert "ReusedExchange" in p
    assert p.count("FileScan parquet") == 1
