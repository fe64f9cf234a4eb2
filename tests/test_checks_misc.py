"""LIM-02 sample, FN-13 typed NULL, SNK-02 table write, AGG-03/04 NULL counts and duplicate
groups with JN-06 (one-row aggregates side by side), AGG-08 / SRT-01 / LIM-01 distribution."""
from pyspark.sql import functions as F

from lakeward.functions.cleanse import typed_null
from lakeward.operators.audit import AuditTarget, quality_row
from lakeward.operators.checks import first_non_null
from lakeward.sources.tables import read_table, write_table


def test_first_non_null_sample(spark):
    """LIM-02."""
    df = spark.createDataFrame([(None,), (["a", "b"],)], "g array<string>")
    assert first_non_null(df, "g").collect()[0].g == ["a", "b"]


def test_quality_row_on_empty_and_null_columns(spark, tmp_path):
    """AGG-03, QL-4..6, SNK-02, SRC-08: NULL counts are 0 on an empty table (P8)."""
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2)], "k string, v int")
    write_table(df, str(tmp_path / "t"))
    t = read_table(spark, str(tmp_path / "t"))
    r = quality_row(t, AuditTarget("t", ("k",), ("k", "v"))).collect()[0]
    assert r.null_counts == "k:1,v:1" and r.duplicate_count == 1 and r.issues_found == "DUPLICATE_PK|1"
    empty = quality_row(t.filter("false"), AuditTarget("t", ("k",), ("k", "v"))).collect()[0]
    assert empty.null_counts == "k:0,v:0" and empty.total_rows == 0 and empty.quality_score == 100.0
    assert spark.range(1).select(typed_null("int").alias("x")).schema["x"].dataType.typeName() == "integer"
    assert F is not None


def test_distribution_top_k_with_key_tie_break(spark):
    """AGG-08, SRT-01, LIM-01: top-15 counts, ties broken by the value."""
    from lakeward.plans.reports import distribution
    rows = [(f"t{i:02d}",) for i in range(20) for _ in range(1 + (i % 3))]
    got = [(r.title_type, r["count"]) for r in
           distribution(spark.createDataFrame(rows, "title_type string"), "title_type").collect()]
    want = sorted(((f"t{i:02d}", 1 + i % 3) for i in range(20)), key=lambda x: (-x[1], x[0]))[:15]
    assert got == want
