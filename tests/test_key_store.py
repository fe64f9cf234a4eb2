"""One row per key as a store of key buckets (STR-03, AGG-09)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakeward.sources import tables as TB


def grow(spark, root, batches, build=lambda b: b.distinct(), **options):
    for rows in batches:
        rows.write.mode("append").parquet(f"{root}/t")
        q = TB.new_keys_stream(TB.stream_table(spark, f"{root}/t"), build, "k", f"{root}/dim",
                               f"{root}/ck", **options)
        q.awaitTermination()
    return q


def files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{root}/dim") for f in fs if f.startswith("part-")
            and "_schema" not in d}


@pytest.mark.parametrize("limit", [0, 10_000_000])
def test_a_million_keys_over_three_batches(spark, tmp_path, monkeypatch, limit):
    """Keys meet whether the batch filters the stored keys or both sides are shuffled; every
    batch is written by several tasks."""
    monkeypatch.setattr(TB, "FILTER_MAX_ROWS", limit)
    root = str(tmp_path)
    made = [spark.range(a, a + 400_000, 1, 8).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
            for a in (0, 300_000, 600_000)]
    before = set()
    for rows in made:
        grow(spark, root, [rows])
        own, before = files(root) - before, files(root)
        assert len(own) == TB.KEY_BUCKETS
    got = TB.read_table(spark, f"{root}/dim")
    assert got.count() == got.select("k").distinct().count() == 1_000_000
    sizes = {r["_batch_id"]: r["count"] for r in got.groupBy("_batch_id").count().collect()}
    assert sizes == {0: 400_000, 1: 300_000, 2: 300_000}


def test_few_keys_open_few_buckets_and_no_new_key_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    grow(spark, root, [spark.range(1000).select(F.col("id").cast("string").alias("k"))])
    before = files(root)
    q = grow(spark, root, [spark.createDataFrame([("7",), ("8",), ("7",), (None,)], "k string")])
    assert q.key_batches[-1][1] == 3 and q.key_batches[-1][2] <= 3
    assert len(files(root) - before) == 1          # NULL is the one new key
    before = files(root)
    grow(spark, root, [spark.createDataFrame([("7",), (None,)], "k string")])
    assert files(root) == before
    got = TB.read_table(spark, f"{root}/dim")
    assert got.count() == 1001 and got.where("k IS NULL").count() == 1
    plan = TB.stored_keys(spark, f"{root}/dim", "k", [3], 9)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_kb" in plan.split("PartitionFilters")[1].split("]")[0]


def test_small_batches_do_not_shuffle_stored_keys(spark, tmp_path):
    root = str(tmp_path)
    grow(spark, root, [spark.range(1000).select(F.col("id").cast("string").alias("k"))])
    rows = spark.createDataFrame([("7", 1)], "k string, _kb int")
    stored = TB.stored_keys(spark, f"{root}/dim", "k", [1], 9)
    plan = TB.new_keys(rows, stored, "k", 1, 17)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "broadcast" in plan


def test_a_replayed_batch_gives_the_same_rows(spark, tmp_path):
    """The batch is applied again after its rows were written: its partitions are replaced."""
    root = str(tmp_path)
    grow(spark, root, [spark.createDataFrame([("a",), ("b",)], "k string"),
                       spark.createDataFrame([("b",), ("c",)], "k string")])
    os.remove(f"{root}/ck/commits/1")
    for f in (f"{root}/ck/commits/.1.crc",):
        if os.path.exists(f):
            os.remove(f)
    TB.new_keys_stream(TB.stream_table(spark, f"{root}/t"), lambda b: b.distinct(), "k", f"{root}/dim",
                       f"{root}/ck").awaitTermination()
    got = sorted((r["k"], r["_batch_id"]) for r in TB.read_table(spark, f"{root}/dim").collect())
    assert got == [("a", 0), ("b", 0), ("c", 1)]


def test_a_table_not_stored_by_bucket_is_refused(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("a", 0)], "k string, _batch_id long").write.partitionBy("_batch_id").parquet(f"{root}/dim")
    with pytest.raises(ValueError, match="rebuild"):
        TB.stored_keys(spark, f"{root}/dim", "k", [0], 1)


def test_an_empty_batch(spark, tmp_path):
    root = str(tmp_path)
    grow(spark, root, [spark.createDataFrame([], "k string")])
    grow(spark, root, [spark.createDataFrame([("a",)], "k string")])
    assert [r["k"] for r in TB.read_table(spark, f"{root}/dim").collect()] == ["a"]
