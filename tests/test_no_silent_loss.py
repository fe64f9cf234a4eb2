"""Data that was once lost without a word: old files, many micro-batches, ragged records,
degenerate periods, listing errors, absent tables, replayed rule counts."""
import os
import time

import pytest
from pyspark.errors import AnalysisException

from lakeward.operators.scd2 import reference_overlaps
from lakeward.plans.reports import gold_report, silver_report
from lakeward.sources import tables as TB
from lakeward.sources import tsv as S
from lakeward.specs import DROP, Rule, TableLayout
from lakeward.streaming.runner import _rule_totals, load_tables, run_layers


def put(folder, name, lines, days_old=0):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if days_old:
        old = time.time() - days_old * 86400
        os.utime(path, (old, old))


def ingest(spark, root, rules=()):
    q = S.ingest_stream(spark, f"{root}/raw", f"{root}/bronze", f"{root}/ck", expected=["k", "v"],
                        rules=rules, dataset="d", metrics_path=f"{root}/log")
    q.awaitTermination()
    return q


def test_old_files_are_ingested(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/raw", "a.tsv", ["k\tv", "1\ta"])
    ingest(spark, root)
    put(f"{root}/raw", "b.tsv", ["k\tv", "2\tb"], days_old=30)
    put(f"{root}/raw", "c.tsv", ["k\tv", "3\tc"])
    ingest(spark, root)
    assert sorted(r.k for r in S.read_ingested(spark, f"{root}/bronze").collect()) == ["1", "2", "3"]


def test_old_table_files_are_streamed(spark, tmp_path):
    root = str(tmp_path)
    for i, days in ((0, 0), (1, 30), (2, 0)):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(f"{root}/t")
        for f in os.listdir(f"{root}/t"):
            if days and f.startswith("part-"):
                old = time.time() - days * 86400
                os.utime(f"{root}/t/{f}", (old, old))
        TB.append_stream(TB.stream_table(spark, f"{root}/t"), f"{root}/out", f"{root}/ck").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == [0, 1, 2]


def test_counts_of_all_batches_beyond_the_progress_history(spark, tmp_path):
    root = str(tmp_path)
    spark.range(0, 12).repartition(6).write.parquet(f"{root}/t")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        q = TB.checked_stream(TB.stream_table(spark, f"{root}/t", max_files_per_trigger=1), lambda b: b,
                              [Rule("even", "id % 2 = 0"), Rule("small", "id < 9", DROP)],
                              f"{root}/out", f"{root}/ck", "d", f"{root}/log")
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert _rule_totals(q) == {"rows": 12, "dropped": 3, "failed_even": 6, "failed_small": 3}
    log = spark.read.parquet(f"{root}/log").groupBy("dataset", "rule").sum("failed").collect()
    assert sorted(tuple(r) for r in log) == [("d", "even", 6), ("d", "small", 3)]
    assert spark.read.parquet(f"{root}/out").count() == 9


def test_ragged_records_are_kept_and_counted(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/raw", "a.tsv", ["k\tv", "1\ta\textra", "2\tb", "3"])
    q = ingest(spark, root, [Rule("has_v", "v IS NOT NULL")])
    got = {r.k: r[S.MALFORMED] for r in S.read_ingested(spark, f"{root}/bronze").collect()}
    assert got == {"1": "1\ta\textra", "2": None, "3": "3"}
    assert _rule_totals(q) == {"rows": 3, "dropped": 0, "failed_has_v": 1, "failed_well_formed_record": 2}


def test_a_replayed_batch_leaves_the_rule_log_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5)
    for _ in range(2):
        S.write_checked_batch(df, [Rule("even", "id % 2 = 0")], 0, f"{root}/t", "d", f"{root}/log")
    assert [(r.failed, r.passed) for r in spark.read.parquet(f"{root}/log").collect()] == [(2, 3)]
    assert spark.read.parquet(f"{root}/t").count() == 5


def test_listing_errors_are_raised_and_a_missing_root_is_empty(spark, tmp_path):
    assert S.folders_with_files(spark, str(tmp_path / "none")) == set()
    with pytest.raises(Exception) as e:
        S.folders_with_files(spark, "nosuchscheme://x/y")
    assert not (isinstance(e.value, AnalysisException) and e.value.getCondition() == "PATH_NOT_FOUND")
    with pytest.raises(Exception):
        run_layers(spark, TableLayout("nosuchscheme://x/y"), "a", "b")


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_of_any_periods_match_the_self_join(spark, seed):
    import random
    rnd = random.Random(seed)
    rows = [(rnd.choice(["k", "m", None]), rnd.choice([None, *range(10)]), rnd.choice([None, *range(10)])) for _ in range(60)]
    if seed == 0:
        rows = [("k", 1, 10), ("k", 5, 5), ("k", 8, 3), ("m", 1, 4), ("m", 2, 6)]
    h = spark.createDataFrame(rows, "k string, s bigint, e bigint")
    want = sum(1 for a in rows for b in rows if None not in (*a, *b) and a[0] == b[0]
               and a[1] < b[2] and a[2] > b[1] and a[1] != b[1])
    h = h.filter("k is not null")
    assert reference_overlaps(h, ["k"], "s", "e").collect()[0].pairs == want
    if seed == 0:
        assert want == 6


def test_absent_tables_fail_their_checks(spark):
    genre = spark.createDataFrame([("a", "a")], "genre_key string, genre_name string").selectExpr("*", "current_timestamp() as load_dt")
    got = [(r.check_id, r.table_name, r.status, r.metric) for r in gold_report(spark, {"gold_dim_genre": genre}).collect()]
    failed = {(c, t) for c, t, s, m in got if s == "FAIL" and m is None}
    assert {("QA-11", "gold_dim_job"), ("QA-20", "gold_fact_ratings"), ("QA-21", "gold_dim_person"),
            ("QA-22", "gold_dim_person"), ("QA-25", "gold_dim_title"), ("QA-13", "gold_dim_title"),
            ("QA-26", "gold_fact_episodes"), ("QA-17", "gold_fact_ratings"), ("QA-19", "gold_bridge_title_genre")} <= failed
    assert ("QA-11", "gold_dim_genre", "PASS", 1.0) in got
    got = {(r.check_id, r.table_name) for r in silver_report(spark, {}).collect() if r.status == "FAIL" and r.metric is None}
    assert {c for c, _ in got} == {"QA-01", "QA-02", "QA-03", "QA-04", "QA-05", "QA-06", "QA-07", "QA-08", "QA-09", "QA-10"}


def test_no_tables_at_all(spark, tmp_path):
    layout = TableLayout(str(tmp_path / "empty"))
    assert load_tables(spark, layout) == {}


def test_one_row_per_key_over_batches_with_a_partial_aggregate(spark, tmp_path):
    """A key in every micro-batch, and NULL, are stored once; the batch is reduced inside the
    tasks before rows move."""
    root = str(tmp_path)
    rows = [("hot", i) for i in range(50)] + [(None, 1), ("a", 2), (None, 3), ("b", 4)]
    spark.createDataFrame(rows, "k string, v int").repartition(4).write.parquet(f"{root}/t")
    build = lambda b: b.select("k").distinct()
    TB.new_keys_stream(TB.stream_table(spark, f"{root}/t", max_files_per_trigger=1), build, "k",
                       f"{root}/dim", f"{root}/ck").awaitTermination()
    stored = spark.read.parquet(f"{root}/dim")
    assert sorted(str(r.k) for r in stored.collect()) == ["None", "a", "b", "hot"]
    from lakeward.operators.dims import exploded_dimension
    d = exploded_dimension(spark.read.parquet(f"{root}/t").selectExpr("array(k) as ks"), "ks", "key", "name")
    plan = d._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("hashpartitioning")
    assert "HashAggregate" in plan[exchange:]
