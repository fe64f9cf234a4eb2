"""The command line runs all layers and both reports on the fixtures."""
import json
import os

from conftest import FIXTURES, copy_raw

from lakeward.__main__ import main
from lakeward.specs import TableLayout
from lakeward.streaming.runner import load_tables, register_layout


def test_run_and_report(spark, tmp_path, capsys):
    root = str(tmp_path)
    copy_raw("run1", root)
    main(["run", "--root", root, "--countries", os.path.join(FIXTURES, "lookups/iso_country_codes.csv"),
          "--languages", os.path.join(FIXTURES, "lookups/iso_language_codes.csv"), "--key-buckets", "4"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["expectations"]["silver_title_ratings_rules"]["dropped"] == 8
    main(["report", "--root", root, "--as-of", "2030-01-01 00:00:00"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["qa_silver_report"]["PASS"] > 0 and summary["qa_gold_report"]["PASS"] > 0
    gold = spark.read.parquet(f"{root}/qa/qa_gold_report")
    assert gold.filter("check_id = 'QA-26' AND status = 'FAIL'").count() == 10   # stale as of 2030


def test_tables_by_name_are_those_by_path(spark, tmp_path):
    """SRC-09: what audits and reports read with and without a database."""
    layout, names = TableLayout(str(tmp_path)), ["bronze_title_ratings", "gold_dim_genre", "silver_title_ratings"]
    for name in names:
        spark.createDataFrame([("tt0000001", name), (None, "x")], "k string, v string").write.parquet(
            layout.path(name.split("_")[0], name))
    assert sorted(register_layout(spark, layout, "lakeward_named")) == [f"lakeward_named.{n}" for n in names]
    by_path, by_name = load_tables(spark, layout), load_tables(spark, layout, database="lakeward_named")
    assert sorted(by_path) == sorted(by_name) == names
    for n in names:
        assert sorted(map(str, by_path[n].collect())) == sorted(map(str, by_name[n].collect()))
    assert list(load_tables(spark, layout, ["gold_dim_genre"], "lakeward_named")) == ["gold_dim_genre"]


def test_size_partitions_from_raw_metadata(spark, tmp_path):
    from lakeward.__main__ import size_partitions
    copy_raw("run1", str(tmp_path))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        conf = size_partitions(spark, f"{tmp_path}/raw")
        assert int(conf["spark.sql.shuffle.partitions"]) >= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
