"""SRC-01..06, SNK-01, STR-02: TSV dialect, header-aware evolution, lineage, incremental runs."""
import os

from conftest import FIXTURES, copy_raw

from lakeward.sources import tsv as S
from lakeward.specs import raw_spec


def test_dialect_null_marker_and_literal_quotes(spark):
    path = os.path.join(FIXTURES, "run1/raw/title_basics")
    spec = raw_spec("bronze_title_basics")
    df = S.read_tsv(spark, path, spec.columns)
    r = {x.tconst: x for x in df.collect()}
    assert r["tt0000005"].primaryTitle == 'Eps "Quoted"'      # quoting off
    assert r["tt0000003"].titleType is None                      # \N -> NULL
    assert r["tt0000002"].genres == " Drama,Drama"               # text kept as is
    assert all(x._source_file.endswith("title_basics.tsv") for x in df.collect())
    assert dict(df.dtypes)["startYear"] == "string"              # SRC-04


def test_schema_evolution_maps_by_name(spark, tmp_path):
    root = str(tmp_path)
    copy_raw("run1", root)
    copy_raw("run2", root)
    files = S.list_files(spark, f"{root}/raw/name_basics", "*.tsv*")
    assert len(files) == 2
    spec = raw_spec("bronze_name_basics")
    df = S.read_tsv_evolving(spark, files, False, spec.columns)
    assert df.columns[:6] == list(spec.columns) and "extraInfo" in df.columns
    r = {(x.nconst, x.primaryName): x for x in df.collect()}
    assert r[("nm0000001", "Ann Roe")].extraInfo == "renamed"    # reordered file, by name
    assert r[("nm0000001", "Ann Lee")].extraInfo is None         # older rows: NULL


def test_incremental_ingest_only_new_files(spark, tmp_path):
    root = str(tmp_path)
    spec = raw_spec("bronze_title_ratings")
    target, ckpt = f"{root}/bronze/r", f"{root}/_ck/r"
    copy_raw("run1", root)
    S.ingest_stream(spark, f"{root}/raw/title_ratings", target, ckpt, expected=spec.columns,
                    glob="*.tsv*").awaitTermination()
    first = S.read_ingested(spark, target)
    assert first.count() == 10
    # same files again: nothing new; then a reordered file arrives
    S.ingest_stream(spark, f"{root}/raw/title_ratings", target, ckpt, expected=spec.columns,
                    glob="*.tsv*").awaitTermination()
    assert S.read_ingested(spark, target).count() == 10
    copy_raw("run2", root)
    S.ingest_stream(spark, f"{root}/raw/title_ratings", target, ckpt, expected=spec.columns,
                    glob="*.tsv*").awaitTermination()
    after = S.read_ingested(spark, target)
    assert after.count() == 11
    new = after.filter("tconst = 'tt0000011'").collect()[0]
    assert (new.averageRating, new.numVotes) == ("5.5", "7")


def test_lookup_csv(spark):
    """SRC-10."""
    from lakeward.sources.tables import read_lookup_csv
    df = read_lookup_csv(spark, os.path.join(FIXTURES, "lookups/iso_country_codes.csv"),
                         ["region_code", "region_name"])
    assert df.count() == 4 and dict(df.dtypes)["region_code"] == "string"


def test_fixed_schema_stream_source(spark, tmp_path):
    """SRC-01 with a fixed header: streaming CSV source + lineage into a parquet sink."""
    from lakeward.sources.tables import append_stream
    root = str(tmp_path)
    copy_raw("run1", root)
    spec = raw_spec("bronze_title_crew")
    s = S.stream_tsv(spark, f"{root}/raw/title_crew", spec.columns)
    append_stream(s, f"{root}/out", f"{root}/_ck").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 3 and S.SOURCE_FILE in out.columns
    assert out.filter("tconst = 'tt0000001'").collect()[0].directors == "nm0000001,nm0000002"


def test_multiline_semantics_stay_splittable(spark, tmp_path):
    """SRC-03: same records as multiLine=true (lone CR kept in a field), but split into tasks."""
    path = str(tmp_path / "big.tsv")
    with open(path, "w", newline="") as f:
        f.write("k\tv\n")
        for i in range(40_000):
            f.write(f"{i}\t{'x' if i % 7 else 'a' + chr(13) + 'b'}{'-' * 40}\n")
    ref = (spark.read.options(**S.tsv_options(True)).schema(S.string_schema(["k", "v"]))
           .csv(path).collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "262144")
    try:
        df = S.read_tsv_evolving(spark, [path], multiline=True, expected=["k", "v"])
        assert df.rdd.getNumPartitions() > 1
        got = df.select("k", "v").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, got)) == sorted(map(tuple, ref))
    assert any("\r" in r.v for r in got)


def test_gzip_files_with_different_headers(spark, tmp_path):
    """SRC-01..05 on compressed raw files (the modelled delivery format)."""
    import gzip
    d = tmp_path / "ratings"
    d.mkdir()
    with gzip.open(d / "a.tsv.gz", "wt", newline="") as f:
        f.write("tconst\taverageRating\tnumVotes\ntt0000001\t5.5\t10\n")
    with gzip.open(d / "b.tsv.gz", "wt", newline="") as f:
        f.write("numVotes\ttconst\taverageRating\r\n7\ttt0000002\t\\N\r\n")
    files = S.list_files(spark, str(d), "*.tsv*")
    df = S.read_tsv_evolving(spark, files, True, ["tconst", "averageRating", "numVotes"])
    got = sorted((r.tconst, r.averageRating, r.numVotes) for r in df.collect())
    assert got == [("tt0000001", "5.5", "10"), ("tt0000002", None, "7")]


def test_ingest_skips_per_file_header_jobs_when_headers_match(spark, tmp_path, monkeypatch):
    """Known header: one validated scan, no per-file header jobs; a reordered file falls
    back to grouping by header and still maps by name."""
    calls = []
    real = S.header_groups
    monkeypatch.setattr(S, "header_groups", lambda *a, **k: calls.append(1) or real(*a, **k))
    root = str(tmp_path)
    copy_raw("run1", root)
    spec = raw_spec("bronze_title_ratings")
    args = (spark, f"{root}/raw/title_ratings", f"{root}/bronze", f"{root}/_ck")
    S.ingest_stream(*args, expected=spec.columns, glob="*.tsv*").awaitTermination()
    assert calls == []
    copy_raw("run2", root)                                   # reordered header arrives
    S.ingest_stream(*args, expected=spec.columns, glob="*.tsv*").awaitTermination()
    assert len(calls) == 1
    r = S.read_ingested(spark, f"{root}/bronze").filter("tconst = 'tt0000011'").collect()[0]
    assert (r.averageRating, r.numVotes) == ("5.5", "7")


def test_crlf_multiline_stream_learns_line_ending(spark, tmp_path, monkeypatch):
    """A CRLF file set under multi-line semantics: the first batch groups by header (and
    line ending), later batches of the same stream reuse both in one validated scan."""
    calls = []
    real = S.header_groups
    monkeypatch.setattr(S, "header_groups", lambda *a, **k: calls.append(1) or real(*a, **k))
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a.tsv").write_bytes(b"k\tv\r\n1\tx\r\n")
    (d / "b.tsv").write_bytes(b"k\tv\r\n2\ty\r\n")
    w = S._EvolvingBatchWriter(str(tmp_path / "bronze"), True, ["k", "v"], [], "t", None)
    for i, f in enumerate(("a.tsv", "b.tsv")):
        w(spark.createDataFrame([(str(d / f),)], "path string"), i)
    assert len(calls) == 1 and w.known_crlf
    out = sorted((r.k, r.v) for r in S.read_ingested(spark, str(tmp_path / "bronze")).collect())
    assert out == [("1", "x"), ("2", "y")]
