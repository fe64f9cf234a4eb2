"""GD-01/02, SCD-03, PRJ-13, FN-15, QL-3: two dated deliveries through the same checkpoints."""
import datetime as dt
import glob

from pyspark.sql import functions as F

from lakeward.functions.cleanse import at_clock
from lakeward.operators.audit import row_count_history
from lakeward.operators.scd2 import END, START
from lakeward.plans import model_queries as M
from lakeward.specs import TableLayout
from lakeward.streaming.runner import load_tables, run_audits, run_layers

ONE, TWO = (dt.datetime.fromisoformat(c) for c in M.CLOCKS)


def deliver(spark, root, rows, clock, name):
    folder = f"{root}/raw/name_basics"
    text = "nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles\n"
    text += "".join("\t".join("\\N" if v is None else v for v in r) + "\n" for r in rows)
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.tsv", "w") as f:
        f.write(text)
    return run_layers(spark, TableLayout(str(root)), "", "", clock=clock)


def test_a_changed_person_gets_a_second_version(spark, tmp_path):
    first = [("nm0000001", "Ann Lee", "1950", None, "actor", None), ("nm0000002", "Bo Ek", "1960", None, None, None),
             ("nm0000003", "Cy Orr", "1970", None, "director", None)]
    second = [("nm0000001", "Ann Roe", "1950", None, "actor", None), ("nm0000002", "Bo Ek", "1961", None, None, None),
              ("nm0000004", "Di Fox", None, None, None, None)]
    deliver(spark, tmp_path, first, M.CLOCKS[0], "a")
    before = set(glob.glob(f"{tmp_path}/gold/gold_dim_person/_part=closed/**/*.parquet", recursive=True))
    metrics = deliver(spark, tmp_path, second, M.CLOCKS[1], "b")
    assert not before and [p for _, p in metrics["gold_dim_person_paths"]] == ["in_order"]
    layout = TableLayout(str(tmp_path))
    person = load_tables(spark, layout, ["gold_dim_person"])["gold_dim_person"]
    got = sorted((r.nconst, r.primaryName, r.birthYear, r.load_dt, r[START], r[END]) for r in person.collect()
                 if r[END] is None) + [(r.nconst, r.primaryName, r.birthYear, r.load_dt, r[START], r[END])
                                       for r in person.collect() if r[END] is not None]
    assert got == [("nm0000001", "Ann Roe", 1950, TWO, TWO, None), ("nm0000002", "Bo Ek", 1961, TWO, ONE, None),
                   ("nm0000003", "Cy Orr", 1970, ONE, ONE, None), ("nm0000004", "Di Fox", None, TWO, TWO, None),
                   ("nm0000001", "Ann Lee", 1950, ONE, ONE, TWO)]
    stamps = load_tables(spark, layout)
    assert {r[0] for r in stamps["bronze_name_basics"].select("_loaded_at").distinct().collect()} == {ONE, TWO}
    silver = stamps["silver_name_basics"].select("source_loaded_at", "silver_processed_at").distinct().collect()
    assert {tuple(r) for r in silver} == {(ONE, ONE), (TWO, TWO)}


def test_a_repeated_run_replaces_its_own_snapshot(spark, tmp_path):
    deliver(spark, tmp_path, [("nm0000001", "Ann Lee", None, None, None, None)], M.CLOCKS[0], "a")
    layout = TableLayout(str(tmp_path))
    for run, clock in (("one", M.CLOCKS[0]), ("one", M.CLOCKS[0]), ("two", M.CLOCKS[1]), ("two", M.CLOCKS[1])):
        out = run_audits(spark, layout, clock, run)
    rows = row_count_history(spark, out["qa_row_count_history"]).orderBy("recorded_at").collect()
    assert [(r.row_count, r.recorded_at, r.delta_from_previous) for r in rows] == [(1, ONE, 0), (1, TWO, 0)]
    checked = spark.read.parquet(out["qa_data_quality"]).select("check_timestamp").distinct().collect()
    assert [r[0] for r in checked] == [TWO]


def test_at_clock_sets_clock_columns_only(spark):
    df = spark.createDataFrame([(1, "x")], "a int, `b.c` string").withColumn("load_dt", F.current_timestamp())
    assert at_clock(df, None) is df
    got = at_clock(df, M.CLOCKS[0])
    assert got.columns == df.columns and tuple(got.head()) == (1, "x", ONE)


def test_the_shared_run_follows_its_input_files(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(M, "_RUNS", {})
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    run = lambda: M._shared_run(spark, str(tmp_path), "x", ["t"], made.append)
    first = run()
    assert run() is first and len(made) == 1
    spark.range(4).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert run() is not first and len(made) == 2
