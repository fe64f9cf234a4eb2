"""Cases every operator must stand: clashing columns, very long texts, repeated rows, part files,
and tables whose columns are all null."""
import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD, docs, many  # noqa: F401
from lakeward.llm import (exact_dedup, fingerprints, licences, lm_score, merkle, mixing, packing, personal_data, quality, queries,
                          repeats, simhash, url_filter)

OPERATORS = {
    "simhash": simhash.near_duplicates, "licences": licences.licences, "personal_data": personal_data.personal_data,
    "repeats": repeats.without_repeats, "quality": quality.judge, "mixing": mixing.mix,
    "packing": lambda d: packing.pack(d).select("doc_id", "piece", "start", "length", "ids_crc32"),
    "lm_score": lm_score.score, "exact_dedup": exact_dedup.exact_groups, "merkle": merkle.verify,
    "fingerprints": fingerprints.edit_report}
CLASHES = ["row", "sha", "fp", "key", "word", "n", "pos", "core", "group", "sequence_id", "offset", "size", "target", "kept",
           "label", "list", "tile", "cuts", "n_words", "spans", "e_email", "m_ip", "rank", "place", "bucket", "_sha", "_rank",
           "_maybe", "component_id", "held_out", "piece"]


def rows_of(df):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_change_nothing(docs, name, monkeypatch):
    monkeypatch.setattr(lm_score.train, "__defaults__", (lm_score.CLASSES, 4, 5, 9))
    table = docs(ODD + many(21, 25))
    extra = table
    for c in CLASHES:
        extra = extra.withColumn(c, F.lit("x"))
    assert rows_of(OPERATORS[name](extra)) == rows_of(OPERATORS[name](table))


@pytest.mark.parametrize("name", OPERATORS)
def test_one_very_long_text_and_nothing_but_nulls(docs, name, monkeypatch):
    monkeypatch.setattr(lm_score.train, "__defaults__", (lm_score.CLASSES, 4, 5, 9))
    long = " ".join(f"word{i % 5003}" for i in range(60_000)) + "x" * 20_000
    got = OPERATORS[name](docs([(1, long), (2, None), (2, None), (None, None, None)]))
    assert {r.doc_id for r in got.collect()} == {1, 2, None}


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_queries_read_tables_of_part_files(spark, docs, tmp_path):
    docs(ODD + many(22, 20)).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "http://a.example.org/x", ""), (2, None, None)], "page_id long, url string, html string") \
        .write.parquet(str(tmp_path / "pages.parquet"))
    for name in ("op2_licence_scan", "op3_personal_data", "op5_quality_rules", "op6_url_filter", "op10_exact_dedup"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == (2 if "url" in name else len(ODD) + 20)


def test_url_filter_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.example.org/x")], "page_id long, url string")
    extra = pages.withColumn("rule", F.lit(1)).withColumn("verdict", F.lit(2)).withColumn("p_block", F.lit(3)).withColumn("path", F.lit(4))
    weights = url_filter.train(url_filter.seed_labels(extra))
    assert rows_of(url_filter.judge(extra, weights)) == rows_of(url_filter.judge(pages, weights))
