"""SRC-05/07, SRC-09, SNK-05: schemas kept with the tables; headers of a batch in one job."""
import os

import pytest
from pyspark.sql import functions as F

from lakeward.sources import tables as TB
from lakeward.sources import tsv as S


def write(folder, name, header, rows, end="\n"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(end.join("\t".join(r) for r in [header, *rows]) + end)


def jobs(spark, work):
    """Result of ``work`` and the number of Spark jobs it started."""
    sc = spark.sparkContext
    sc.setJobGroup("count-jobs", "")
    out = work()
    n = len(sc.statusTracker().getJobIdsForGroup("count-jobs"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out, n


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    folder = str(tmp_path / "raw set")          # a blank in the path
    for i in range(120):
        write(folder, f"f {i:03}.tsv", ["a", "b"] if i % 3 else ["a", "b", f"c{i % 9}"],
              [[str(i), "x\rx"] + ([] if i % 3 else ["y"])], "\r\n" if i % 5 == 0 else "\n")
    open(f"{folder}/empty.tsv", "w").close()
    files = S.list_files(spark, folder, "*.tsv")
    groups, n = jobs(spark, lambda: S.header_groups(spark, files))
    assert n <= 3      # the listing, the first lines and the shuffle of them, whatever the files
    assert sum(map(len, groups.values())) == 120
    for (header, crlf), own in groups.items():
        for f in own:
            i = int(f[-7:-4])
            assert crlf == (i % 5 == 0) and header == (("a", "b") if i % 3 else ("a", "b", f"c{i % 9}"))


def test_a_lone_carriage_return_stays_inside_its_field(spark, tmp_path):
    """SRC-03 (a registered query reads such files too: ``ingest_lone_cr``)."""
    write(str(tmp_path / "raw"), "a.tsv", ["k", "v"], [["1", "x\ry"], ["2", "z"]])
    df = S.read_tsv_evolving(spark, S.list_files(spark, str(tmp_path / "raw")), True)
    assert sorted((r.k, r.v) for r in df.collect()) == [("1", "x\ry"), ("2", "z")]


def test_schema_is_kept_and_evolves_with_the_batch(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "t")
    args = (spark, raw, target, str(tmp_path / "ck"), False, ["a", "b"])
    write(raw, "1.tsv", ["a", "b"], [["1", "x"]])
    S.ingest_stream(*args).awaitTermination()
    assert TB.stored_schema(spark, target).names[:2] == ["a", "b"]
    write(raw, "2.tsv", ["a", "c", "b"], [["2", "new", "y"]])
    S.ingest_stream(*args).awaitTermination()
    write(raw, "3.tsv", ["a", "b"], [["3", "z"]])
    S.ingest_stream(*args).awaitTermination()
    assert len(os.listdir(f"{target}/_schema")) >= 2 and "c" in TB.stored_schema(spark, target).names
    got = S.read_ingested(spark, target)
    assert sorted((r.a, r.b, r.c) for r in got.collect()) == [("1", "x", None), ("2", "y", "new"), ("3", "z", None)]
    assert TB.stream_table(spark, target).columns == got.columns
    # By name in the catalog, with the added column and all partitions.
    TB.register_table(spark, "evolved_t", target, "x", {"quality": "bronze"})
    by_name = TB.read_catalog_table(spark, "evolved_t")
    assert sorted((r.a, r.c) for r in by_name.select("a", "c").collect()) == [("1", None), ("2", "new"), ("3", None)]
    spark.sql("DROP TABLE evolved_t")


def test_a_column_of_another_type_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    TB.keep_schema(spark, path, spark.range(1).schema)
    with pytest.raises(ValueError, match="id is stored as bigint and arrives as string"):
        TB.keep_schema(spark, path, spark.range(1).select(F.col("id").cast("string").alias("id")).schema)
    assert TB.keep_schema(spark, path, spark.range(1).schema).names == ["id"]


def test_tables_without_a_kept_schema_are_read_as_they_are(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert TB.stored_schema(spark, str(tmp_path / "t")) is None
    assert TB.read_table(spark, str(tmp_path / "t")).count() == 3
