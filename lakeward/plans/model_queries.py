"""The film/TV model, table by table, on raw files derived from the driver tables.

Seven raw file sets are derived by SQL expressions that Spark and DuckDB both read, with
faults injected by the same formulas (bad ids, text in number fields, values out of range,
NULLs). One run of the layered runner per session and data folder writes every table; each
registered query reads one of them, without its load stamps. Lists are compared joined by
``|``. The oracle derives the same tables from the driver tables alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.plans.raw_tables import RAW_SPECS
from lakeward.plans.reports import gold_report, silver_report, title_type_distribution
from lakeward.session import fresh_dir, in_threads
from lakeward.sources import tsv as S
from lakeward.specs import CLEAN_SPECS, DEPARTMENTS, DEFAULT_DEPARTMENT, DROP, TableLayout
from lakeward.operators.audit import row_count_history
from lakeward.sources.tables import read_catalog_table
from lakeward.streaming.runner import load_tables, register_layout, run_audits, run_layers

QUERIES: dict = {}
ORACLE: dict = {}


def _id(prefix: str, number: str) -> str:
    return f"concat('{prefix}', lpad(concat('', {number}), 7, '0'))"


def _cases(*pairs: tuple[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"


def _p(n: int) -> str:
    return f"p_partkey % {n} = 0"


def _s(n: int, rest: int = 0) -> str:
    return f"s_suppkey % {n} = {rest}"


def _o(n: int, rest: int = 0) -> str:
    return f"o_orderkey % {n} = {rest}"


# folder -> (driver table, [(raw column, SQL of its text)])
RAW_SQL: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "name_basics": ("supplier", [
        ("nconst", _cases((_s(25), _id("xx", "s_suppkey")), (_s(26), "'nm123'"), (_s(27), "NULL"),
                          other=_id("nm", "s_suppkey"))),
        ("primaryName", _cases((_s(19), "'X'"), (_s(23), "NULL"), other="s_name")),
        ("birthYear", _cases((_s(6), "'0'"), (_s(6, 1), "'-12'"), (_s(6, 2), "'18x9'"), (_s(6, 3), "'427'"),
                             (_s(6, 4), "NULL"), other="concat('', 1900 + s_suppkey % 100)")),
        ("deathYear", _cases((_s(7), "concat('', 2000 + s_suppkey % 20)"), (_s(8), "'0'"), other="NULL")),
        ("primaryProfession", _cases(("s_nationkey % 3 = 0", "'actor,producer'"),
                                     ("s_nationkey % 3 = 1", "'director'"), other="NULL")),
        ("knownForTitles", _cases((_s(2), "'tt0000001,tt0000002'"), other="NULL"))]),
    "title_basics": ("part", [
        ("tconst", _cases((_p(40), _id("xx", "p_partkey")), (_p(41), "'tt12'"), other=_id("tt", "p_partkey"))),
        ("titleType", _cases((_p(17), "'tvPilotX'"), (_p(18), "NULL"), ("p_size % 4 = 0", "'movie'"),
                             ("p_size % 4 = 1", "'short'"), ("p_size % 4 = 2", "'tvSeries'"), other="'tvEpisode'")),
        ("primaryTitle", _cases((_p(29), "NULL"), other="p_name")),
        ("originalTitle", "p_name"),
        ("isAdult", _cases((_p(4), "'0'"), (_p(3), "'1'"), (_p(5), "'true'"), other="NULL")),
        ("startYear", _cases((_p(13), "'95'"), (_p(14), "'1849'"), other="concat('', 1950 + p_size)")),
        ("endYear", _cases((_p(6), "'1949'"), (_p(7), "'2036'"), other="NULL")),
        ("runtimeMinutes", _cases((_p(23), "'99999999999'"), (_p(24), "'0'"), (_p(25), "'abc'"),
                                  other="concat('', p_size * 3)")),
        ("genres", _cases((_p(9), "NULL"), (_p(8), "'Drama,Drama, Comedy'"), other="replace(p_name, ' ', ',')"))]),
    "title_ratings": ("part", [
        ("tconst", _cases((_p(42), _id("xx", "p_partkey")), other=_id("tt", "p_partkey"))),
        ("averageRating", _cases((_p(31), "'0.9'"), (_p(32), "'10.1'"), (_p(33), "'abc'"), (_p(34), "NULL"),
                                 other="concat(1 + p_partkey % 9, '.', p_partkey % 10)")),
        ("numVotes", _cases((_p(35), "'0'"), (_p(36), "'5.7'"), other="concat('', 1 + p_partkey % 500)"))]),
    "title_episode": ("part", [
        ("tconst", _cases((_p(43), _id("xx", "p_partkey")), other=_id("tt", "p_partkey"))),
        ("parentTconst", _cases((_p(21), "NULL"), (_p(22), _id("tt", "p_partkey")), (_p(37), "'parent'"),
                                other=_id("tt", "p_partkey % 100 + 1"))),
        ("seasonNumber", _cases((_p(27), "'-1'"), (_p(28), "NULL"), other="concat('', p_partkey % 10)")),
        ("episodeNumber", _cases((_p(30), "'x'"), other="concat('', p_partkey % 50)"))]),
    "title_akas": ("orders", [
        ("titleId", _cases((_o(44), _id("xx", "o_custkey")), other=_id("tt", "o_custkey"))),
        ("ordering", _cases((_o(37), "'0'"), (_o(38), "'x'"), other="concat('', 1 + o_orderkey % 1000)")),
        ("title", _cases((_o(39), "NULL"), other="concat('Title ', o_orderkey)")),
        ("region", _cases((_o(5), "'us'"), (_o(5, 1), "'DE'"), (_o(5, 2), "'xx'"), (_o(5, 3), "NULL"), other="'Fr'")),
        ("language", _cases((_o(4), "'EN'"), (_o(4, 1), "'de'"), (_o(4, 2), "NULL"), other="'zz'")),
        ("types", _cases((_o(6), "'festival,working'"), (_o(6, 1), "NULL"), other="'display'")),
        ("attributes", _cases((_o(11), "'literal title'"), other="NULL")),
        ("isOriginalTitle", _cases((_o(3), "'1'"), (_o(3, 1), "'0'"), other="NULL"))]),
    "title_principals": ("lineitem", [
        ("tconst", _cases(("l_orderkey % 50 = 0", _id("xx", "l_partkey")), other=_id("tt", "l_partkey"))),
        ("ordering", "concat('', l_linenumber)"),
        ("nconst", _id("nm", "l_suppkey")),
        ("category", _cases(("l_returnflag = 'R'", "'Actor'"), ("l_returnflag = 'A'", "'director'"),
                            other="'self'")),
        ("job", _cases(("l_linestatus = 'O'", "NULL"), other="concat('line ', l_linestatus)")),
        ("characters", "concat('[\"Role ', l_linenumber, '\"]')")]),
    "title_crew": ("part", [
        ("tconst", _cases((_p(45), _id("xx", "p_partkey")), other=_id("tt", "p_partkey"))),
        ("directors", _cases((_p(5), "NULL"), other=f"concat({_id('nm', '1 + p_partkey % 50')}, ',', {_id('nm', '1 + p_partkey % 60')})")),
        ("writers", _cases((_p(3), "NULL"), other=_id("nm", "1 + p_partkey % 70")))]),
}
COUNTRIES = [("us", "United States"), ("DE", "Germany"), ("de", "Deutschland"), ("fr", "France")]
LANGUAGES = [("en", "English"), ("DE", "German")]


def derive_raw_files(spark: SparkSession, sf: str, root: str) -> None:
    """Write the seven raw file sets, all at the same time, and the two lookups."""
    def write(folder: str, table: str, cols: list) -> None:
        src = spark.read.parquet(f"{sf}/{table}.parquet")
        S.write_tsv(src.selectExpr(*[f"{e} AS {c}" for c, e in cols]), f"{root}/raw/{folder}")
    in_threads(spark, [lambda f=folder, t=table, c=cols: write(f, t, c) for folder, (table, cols) in RAW_SQL.items()])
    for name, rows in (("region", COUNTRIES), ("language", LANGUAGES)):
        spark.createDataFrame(rows, f"{name}_code string, {name}_name string").coalesce(1) \
            .write.option("header", "true").csv(f"{root}/lookups/{name}")


_RUNS: dict[tuple, TableLayout] = {}


def _shared_run(spark: SparkSession, sf: str, name: str, tables, make) -> TableLayout:
    """The layout of this session's run ``name`` over ``sf``, made on first use and again when a
    file of its input ``tables`` has another name, size or time."""
    paths = [f"{sf}/{t}.parquet" for t in sorted(set(tables))]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    found = sorted(map(tuple, files.select("path", "length", "modificationTime").collect()))
    key = (spark.sparkContext.applicationId, name, tuple(found))
    if key not in _RUNS:
        layout = TableLayout(fresh_dir(spark, name))
        make(layout)
        _RUNS[key] = layout
    return _RUNS[key]


def model_run(spark: SparkSession, sf: str) -> TableLayout:
    """The layout of this session's run over ``sf``: all raw file sets through all layers."""
    def make(layout: TableLayout) -> None:
        root = layout.root
        derive_raw_files(spark, sf, root)
        run_layers(spark, layout, f"{root}/lookups/region", f"{root}/lookups/language", raw_glob="part-*")
    return _shared_run(spark, sf, "layered_model", [t for t, _ in RAW_SQL.values()], make)


# ---- two deliveries through the same checkpoints ----------------------------------------------

# The clock of each delivery, and what the second brings of the persons: some not at all, some
# under another name (tracked), some with another birth year (not tracked), the rest as before.
CLOCKS = ("2024-03-01 06:00:00", "2024-03-02 06:00:00")
SECOND = {"primaryName": _cases((_s(3), "concat(s_name, ' II')"), (_s(23), "NULL"), other="s_name"),
          "birthYear": _cases((_s(5), "'1955'"), other=dict(RAW_SQL["name_basics"][1])["birthYear"]),
          "deathYear": _cases((_s(11), "'2023'"), (_s(7), "concat('', 2000 + s_suppkey % 20)"), other="NULL")}
SECOND_ROWS = "s_suppkey % 4 <> 1"
DELIVERED = [[(c, e) for c, e in RAW_SQL["name_basics"][1]],
             [(c, SECOND.get(c, e)) for c, e in RAW_SQL["name_basics"][1]]]


def two_deliveries(spark: SparkSession, sf: str) -> TableLayout:
    """The layout after two deliveries of persons (the first also of ratings), each run through
    all layers at its own clock with the same checkpoints, and audited; the second audit is
    repeated under its run id, as after a failure."""
    def make(layout: TableLayout) -> None:
        root = layout.root
        persons = spark.read.parquet(f"{sf}/supplier.parquet")
        ratings = spark.read.parquet(f"{sf}/part.parquet")
        S.write_tsv(ratings.selectExpr(*[f"{e} AS {c}" for c, e in RAW_SQL["title_ratings"][1]]), f"{root}/raw/title_ratings")
        for i, (clock, cols) in enumerate(zip(CLOCKS, DELIVERED)):
            rows = persons.where(SECOND_ROWS) if i else persons
            S.write_tsv(rows.selectExpr(*[f"{e} AS {c}" for c, e in cols]), f"{root}/raw/name_basics", "append")
            run_layers(spark, layout, "", "", raw_glob="part-*", clock=clock)
            for _ in range(i + 1):
                run_audits(spark, layout, clock, f"delivery_{i + 1}")
    return _shared_run(spark, sf, "two_deliveries", ["supplier", "part"], make)


def _instant(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def person_two_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """GD-01/02, SCD-02/03, STR-06: the person dimension after two deliveries, with the bounds of
    its versions."""
    person = load_tables(spark, two_deliveries(spark, sf), ["gold_dim_person"])["gold_dim_person"]
    instants = ("load_dt", "__START_AT", "__END_AT")
    return person.select(
        *[_instant(c) if c in instants else F.array_join(c, "|").alias(c) if c == "knownForTitles" else F.col(c)
          for c in person.columns])


def layer_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-13, FN-15, SRC-06: every load stamp of bronze, silver and gold after two deliveries,
    with its rows."""
    tables = load_tables(spark, two_deliveries(spark, sf), [t for t, _ in STAMPED])
    out = None
    for name, columns in STAMPED:
        for c in columns:
            rows = tables[name].groupBy(F.lit(name).alias("table_name"), F.lit(c).alias("stamp"), _instant(c).alias("at")) \
                .agg(F.count(F.lit(1)).alias("n"))
            out = rows if out is None else out.unionByName(rows)
    return out


def row_counts_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """QL-3: the stored row-count history after two runs, of which the second was repeated."""
    history = row_count_history(spark, two_deliveries(spark, sf).path("qa", "qa_row_count_history"))
    return history.select("table_name", "row_count", _instant("recorded_at"), "delta_from_previous")


# Clock and lineage columns, left out of comparisons.
STAMPS = ("load_dt", "source_loaded_at", "silver_processed_at", "_source_file", "_loaded_at", "_batch_id",
          "_malformed_record", "__START_AT")


def comparable(df: DataFrame) -> DataFrame:
    """Without stamps; lists joined by ``|``."""
    return df.select(*[F.array_join(f.name, "|").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
                       for f in df.schema.fields if f.name not in STAMPS])


# What each table's query exercises (for the operator index).
IDS = {spec.name: f"BR-{i}, SRC-01..06, SNK-01" for i, spec in enumerate(RAW_SPECS, 1)}
IDS |= {spec.name: f"SV-{i}, PRJ-01..13, EXP-01..03, SRC-07" for i, spec in enumerate(CLEAN_SPECS, 1)}
IDS |= {"gold_dim_person": "GD-01/02, SCD-02/03, STR-06, SNK-03/04", "gold_dim_title": "GD-03",
        "gold_dim_genre": "GD-04, STR-03/04", "gold_dim_category": "GD-05, STR-03", "gold_dim_job": "GD-06, STR-03",
        "gold_dim_region": "GD-07, STR-05, SRC-08/10, SNK-02", "gold_dim_language": "GD-08, STR-05, SRC-08/10, SNK-02",
        "gold_dim_title_alternates": "GD-09", "gold_bridge_title_genre": "GD-10", "gold_fact_ratings": "GD-11",
        "gold_fact_episodes": "GD-12", "gold_fact_title_credits": "GD-13"}


def _table_query(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return comparable(load_tables(spark, model_run(spark, sf), [name])[name])
    run.__doc__ = f"{IDS[name]}: {name} of the model, from raw files through all layers."
    return run


# ---- the same tables in SQL -----------------------------------------------------------------

def _list(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN string_split(trim({c}), ',') END"


def _guarded(c: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{pattern}') THEN TRY_CAST({c} AS INTEGER) END"


def _int(c: str) -> str:
    return _guarded(c, "^[+-]?[0-9]+$")


def _flag(c: str) -> str:
    return f"COALESCE({c} = '1', false)"


def _strip(c: str) -> str:
    return f"""regexp_replace(regexp_replace(trim({c}), '^\\["', ''), '"\\]$', '')"""


DIGITS, YEAR = "^[0-9]+$", "^[0-9]{4}$"
TYPED_SQL = {
    "silver_name_basics": [
        ("nconst", "trim(nconst)"), ("primary_name", "trim(primaryName)"),
        ("birth_year", _guarded("birthYear", "^[0-9]{1,4}$")), ("death_year", _guarded("deathYear", "^[0-9]{1,4}$")),
        ("primary_professions", _list("primaryProfession")), ("known_for_titles", _list("knownForTitles"))],
    "silver_title_basics": [
        ("tconst", "trim(tconst)"), ("title_type", "trim(titleType)"), ("primary_title", "trim(primaryTitle)"),
        ("original_title", "trim(originalTitle)"), ("is_adult", _flag("isAdult")),
        ("start_year", _guarded("startYear", YEAR)), ("end_year", _guarded("endYear", YEAR)),
        ("runtime_minutes", _guarded("runtimeMinutes", DIGITS)), ("genres", _list("genres"))],
    "silver_title_ratings": [
        ("tconst", "trim(tconst)"), ("average_rating", "TRY_CAST(averageRating AS DOUBLE)"),
        ("num_votes", _int("numVotes"))],
    "silver_title_episode": [
        ("tconst", "trim(tconst)"), ("parent_tconst", "trim(parentTconst)"),
        ("season_number", _guarded("seasonNumber", DIGITS)), ("episode_number", _guarded("episodeNumber", DIGITS))],
    "silver_title_akas": [
        ("title_id", "trim(titleId)"), ("ordering", _int("ordering")), ("title", "trim(title)"),
        ("region", "upper(trim(region))"), ("language", "lower(trim(language))"), ("types", _list("types")),
        ("attributes", "trim(attributes)"), ("is_original_title", _flag("isOriginalTitle"))],
    "silver_title_principals": [
        ("tconst", "trim(tconst)"), ("ordering", _int("ordering")), ("nconst", "trim(nconst)"),
        ("category", "lower(trim(category))"), ("job", "trim(job)"), ("characters", _strip("characters"))],
    "silver_title_crew": [
        ("tconst", "trim(tconst)"), ("directors", _list("directors")), ("writers", _list("writers"))],
}
LISTS = {"primary_professions", "known_for_titles", "genres", "types", "directors", "writers", "knownForTitles",
         "release_type"}


def _ansi(predicate: str) -> str:
    return re.sub(r"(\w+) RLIKE ('[^']*')", r"regexp_matches(\1, \2)", predicate)


def _with(*names: str) -> str:
    """WITH clause that defines raw, typed and cleansed tables as needed."""
    out = []
    for spec in RAW_SPECS:
        table, cols = RAW_SQL[spec.folder]
        out.append(f"{spec.name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in cols) + f" FROM {table})")
    for spec in CLEAN_SPECS:
        out.append(f"typed_{spec.name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in TYPED_SQL[spec.name])
                   + f" FROM {spec.source})")
        drops = [f"COALESCE({_ansi(r.predicate)}, false)" for r in spec.rules if r.action == DROP]
        out.append(f"{spec.name} AS (SELECT * FROM typed_{spec.name} WHERE " + " AND ".join(drops or ["true"]) + ")")
    for name, rows in (("region", COUNTRIES), ("language", LANGUAGES)):
        values = ", ".join(f"('{c}', '{n}')" for c, n in rows)
        out.append(f"{name}_names AS (SELECT lower(c) AS c, min(n) AS n FROM (VALUES {values}) v(c, n) GROUP BY lower(c))")
    return "WITH " + ",\n".join(out) + "\n"


def _columns(cols: list[str]) -> str:
    return ", ".join(f"array_to_string({c}, '|') AS {c}" if c in LISTS else c for c in cols)


def _coded(name: str) -> str:
    return f"""SELECT k AS {name}_key, k AS {name}_code, COALESCE(n, k) AS {name}_name
FROM (SELECT DISTINCT trim({name}) AS k FROM silver_title_akas WHERE {name} IS NOT NULL) d
LEFT JOIN {name}_names r ON lower(d.k) = r.c"""


_DEPARTMENT = "CASE " + " ".join(
    f"WHEN category IN ({', '.join(repr(v) for v in values)}) THEN '{label}'" for values, label in DEPARTMENTS) \
    + f" ELSE '{DEFAULT_DEPARTMENT}' END"
_GENRES = "(SELECT tconst, unnest(genres) AS g FROM silver_title_basics)"

GOLD_SQL = {
    "gold_dim_person": """
SELECT nconst, primary_name AS "primaryName", birth_year AS "birthYear", death_year AS "deathYear",
       array_to_string(primary_professions, ',') AS "primaryProfession", len(primary_professions) AS profession_count,
       array_to_string(known_for_titles, '|') AS "knownForTitles", 'silver_name_basics' AS source_file,
       CAST(NULL AS TIMESTAMP) AS "__END_AT" FROM silver_name_basics""",
    "gold_dim_title": """
SELECT tconst, title_type AS "titleType", primary_title AS "primaryTitle", original_title AS "originalTitle",
       is_adult AS "isAdult", start_year AS "startYear", end_year AS "endYear", runtime_minutes AS "runtimeMinutes",
       'silver_title_basics' AS source_file FROM silver_title_basics""",
    "gold_dim_genre": f"SELECT DISTINCT trim(g) AS genre_key, trim(g) AS genre_name FROM {_GENRES} t",
    "gold_dim_category": f"""
SELECT DISTINCT trim(category) AS category_key, category AS category_name, {_DEPARTMENT} AS department
FROM silver_title_principals WHERE category IS NOT NULL""",
    "gold_dim_job": """
SELECT DISTINCT category || '_' || job AS job_key, trim(category) AS category_key, job AS job_name, job AS job_description
FROM silver_title_principals WHERE job IS NOT NULL""",
    "gold_dim_region": _coded("region"),
    "gold_dim_language": _coded("language"),
    "gold_dim_title_alternates": """
SELECT title_id || '_' || CAST(ordering AS VARCHAR) AS alternate_key, title_id AS tconst, trim(region) AS region_key,
       trim(language) AS language_key, title AS localized_title, array_to_string(types, '|') AS release_type, attributes,
       is_original_title, ordering, 'silver_title_akas' AS source_file FROM silver_title_akas""",
    "gold_bridge_title_genre": f"SELECT tconst, trim(g) AS genre_key, false AS is_primary_genre FROM {_GENRES} t",
    "gold_fact_ratings": """
SELECT tconst, average_rating, num_votes, 'silver_title_ratings' AS source_file, 'dlt_pipeline' AS loaded_by
FROM silver_title_ratings""",
    "gold_fact_episodes": """
SELECT tconst AS episode_tconst, parent_tconst AS series_tconst, season_number, episode_number,
       'silver_title_episode' AS source_file, 'dlt_pipeline' AS loaded_by FROM silver_title_episode""",
    "gold_fact_title_credits": """
SELECT tconst, nconst, trim(category) AS category_key, category || '_' || COALESCE(job, '') AS job_key, ordering, characters,
       'silver_title_principals' AS source_file, 'dlt_pipeline' AS loaded_by FROM silver_title_principals""",
}

for _spec in RAW_SPECS:
    QUERIES[_spec.name] = _table_query(_spec.name)
    ORACLE[_spec.name] = _with() + f"SELECT {', '.join(_spec.columns)} FROM {_spec.name}"
for _spec in CLEAN_SPECS:
    QUERIES[_spec.name] = _table_query(_spec.name)
    ORACLE[_spec.name] = _with() + f"SELECT {_columns([c for c, _ in TYPED_SQL[_spec.name]])} FROM {_spec.name}"
for _name, _sql in GOLD_SQL.items():
    QUERIES[_name] = _table_query(_name)
    ORACLE[_name] = _with() + _sql.strip()


def _deliveries() -> str:
    """WITH clause of both deliveries: raw persons d1, d2 and cleansed ones p1, p2 with ``load_dt``;
    ratings as in the model."""
    spec = next(s for s in CLEAN_SPECS if s.name == "silver_name_basics")
    drops = " AND ".join([f"COALESCE({_ansi(r.predicate)}, false)" for r in spec.rules if r.action == DROP] or ["true"])
    out = []
    for i, (clock, cols) in enumerate(zip(CLOCKS, DELIVERED), 1):
        out.append(f"d{i} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in cols) + " FROM supplier"
                   + (f" WHERE {SECOND_ROWS}" if i > 1 else "") + ")")
        typed = ", ".join(f"{e} AS {c}" for c, e in TYPED_SQL["silver_name_basics"])
        out.append(f"p{i} AS (SELECT *, '{clock}' AS load_dt FROM (SELECT {typed} FROM d{i}) t WHERE {drops})")
    return _with().rstrip() + ",\n" + ",\n".join(out) + "\n"


_KNOWN = {"primary_name": "primaryName", "birth_year": "birthYear", "death_year": "deathYear"}


def _version(row: str, start: str, end: str) -> str:
    return (f"SELECT {row}.nconst, " + ", ".join(f'{row}.{c} AS "{n}"' for c, n in _KNOWN.items())
            + f""", array_to_string({row}.primary_professions, ',') AS "primaryProfession",
       len({row}.primary_professions) AS profession_count, array_to_string({row}.known_for_titles, '|') AS "knownForTitles",
       {row}.load_dt, 'silver_name_basics' AS source_file, {start} AS "__START_AT", CAST({end} AS VARCHAR) AS "__END_AT" """)


_BOTH = "FROM p1 JOIN p2 ON p1.nconst = p2.nconst WHERE"
_SAME = """(p1.primary_name IS NOT DISTINCT FROM p2.primary_name AND p1.death_year IS NOT DISTINCT FROM p2.death_year
  AND array_to_string(p1.primary_professions, ',') IS NOT DISTINCT FROM array_to_string(p2.primary_professions, ','))"""
QUERIES["person_two_deliveries"] = person_two_deliveries
ORACLE["person_two_deliveries"] = _deliveries() + "\nUNION ALL ".join([
    f"{_version('p1', 'p1.load_dt', 'NULL')} FROM p1 WHERE nconst NOT IN (SELECT nconst FROM p2)",
    f"{_version('p2', 'p2.load_dt', 'NULL')} FROM p2 WHERE nconst NOT IN (SELECT nconst FROM p1)",
    f"{_version('p2', 'p1.load_dt', 'NULL')} {_BOTH} {_SAME}",
    f"{_version('p1', 'p1.load_dt', 'p2.load_dt')} {_BOTH} NOT {_SAME}",
    f"{_version('p2', 'p2.load_dt', 'NULL')} {_BOTH} NOT {_SAME}"])

STAMPED = [("bronze_name_basics", ["_loaded_at"]), ("bronze_title_ratings", ["_loaded_at"]),
           ("silver_name_basics", ["source_loaded_at", "silver_processed_at"]),
           ("silver_title_ratings", ["source_loaded_at", "silver_processed_at"]),
           ("gold_dim_person", ["load_dt"]), ("gold_fact_ratings", ["load_dt"])]
_STAMP_ROWS = {"bronze_name_basics": ["d1", "d2"], "silver_name_basics": ["p1", "p2"],
               "bronze_title_ratings": ["bronze_title_ratings"], "silver_title_ratings": ["silver_title_ratings"],
               "gold_fact_ratings": ["silver_title_ratings"]}
QUERIES["layer_stamps"] = layer_stamps
ORACLE["layer_stamps"] = _deliveries() + "\nUNION ALL ".join(
    [f"SELECT '{t}' AS table_name, '{c}' AS stamp, '{CLOCKS[i]}' AS at, count(*) AS n FROM {rows}"
     for t, columns in STAMPED if t in _STAMP_ROWS for c in columns for i, rows in enumerate(_STAMP_ROWS[t])]
    + [f"SELECT 'gold_dim_person', 'load_dt', load_dt, count(*) FROM ({ORACLE['person_two_deliveries'][len(_deliveries()):]}) g GROUP BY load_dt"])

def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-09, SNK-05: every table after two deliveries, registered in the catalog with its layer
    and read by name (partitioned ones too): rows, columns and rows without the key."""
    layout = two_deliveries(spark, sf)
    database = "lakeward_deliveries"
    out = None
    for name in sorted(register_layout(spark, layout, database)):
        table = read_catalog_table(spark, name)
        quality = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["quality"]
        columns = ",".join(c for c in table.columns if not c.startswith("_"))
        rows = table.agg(F.lit(name.split(".")[1]).alias("table_name"), F.lit(quality).alias("quality"),
                         F.lit(columns).alias("columns"), F.count(F.lit(1)).alias("n_rows"),
                         F.count_if(F.col(table.columns[0]).isNull()).alias("n_without_key"))
        out = rows if out is None else out.unionByName(rows)
    return out


_RATINGS = "tconst,average_rating,num_votes"
QUERIES["catalog_tables"] = catalog_tables
ORACLE["catalog_tables"] = _deliveries() + "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{q}' AS quality, '{c}' AS columns, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {k} IS NULL) AS n_without_key FROM ({rows}) r" for t, q, c, k, rows in (
        ("bronze_name_basics", "bronze", ",".join(c for c, _ in RAW_SQL["name_basics"][1]), "nconst",
         "SELECT nconst FROM d1 UNION ALL SELECT nconst FROM d2"),
        ("bronze_title_ratings", "bronze", ",".join(c for c, _ in RAW_SQL["title_ratings"][1]), "tconst",
         "SELECT tconst FROM bronze_title_ratings"),
        ("silver_name_basics", "silver", ",".join(c for c, _ in TYPED_SQL["silver_name_basics"]) + ",source_loaded_at,silver_processed_at",
         "nconst", "SELECT nconst FROM p1 UNION ALL SELECT nconst FROM p2"),
        ("silver_title_ratings", "silver", _RATINGS + ",source_loaded_at,silver_processed_at", "tconst", "SELECT tconst FROM silver_title_ratings"),
        ("gold_fact_ratings", "gold", _RATINGS + ",load_dt,source_file,loaded_by", "tconst", "SELECT tconst FROM silver_title_ratings"),
        ("gold_dim_person", "gold", "nconst,primaryName,birthYear,deathYear,primaryProfession,profession_count,knownForTitles,load_dt,source_file",
         "nconst", f"SELECT nconst FROM ({ORACLE['person_two_deliveries'][len(_deliveries()):]}) g")))

QUERIES["row_counts_two_runs"] = row_counts_two_runs
ORACLE["row_counts_two_runs"] = _deliveries() + f"""
SELECT table_name, n AS row_count, recorded_at, n - COALESCE(before, n) AS delta_from_previous FROM (
  SELECT 'bronze_name_basics' AS table_name, (SELECT count(*) FROM d1) AS n, '{CLOCKS[0]}' AS recorded_at, NULL AS before
  UNION ALL SELECT 'bronze_name_basics', (SELECT count(*) FROM d1) + (SELECT count(*) FROM d2), '{CLOCKS[1]}', (SELECT count(*) FROM d1)
  UNION ALL SELECT 'bronze_title_ratings', (SELECT count(*) FROM part), '{CLOCKS[0]}', NULL
  UNION ALL SELECT 'bronze_title_ratings', (SELECT count(*) FROM part), '{CLOCKS[1]}', (SELECT count(*) FROM part)) h"""


def rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """EXP-01..03, EX-01..39: violations of every rule, from the stored rule log."""
    log = spark.read.parquet(model_run(spark, sf).path("qa", "expectation_log"))
    return log.groupBy("dataset", "rule", "action").agg(F.sum("failed").alias("failed"), F.sum("passed").alias("passed"))


def _counted(dataset: str, source: str, rule) -> str:
    ok = f"COALESCE({_ansi(rule.predicate)}, false)"
    return (f"SELECT '{dataset}' AS dataset, '{rule.name}' AS rule, '{rule.action}' AS action, "
            f"CAST(count(*) FILTER (WHERE NOT {ok}) AS BIGINT) AS failed, "
            f"CAST(count(*) FILTER (WHERE {ok}) AS BIGINT) AS passed FROM {source}")


QUERIES["rule_counts"] = rule_counts
ORACLE["rule_counts"] = _with() + "\nUNION ALL ".join(
    [_counted(s.name, s.name, r) for s in RAW_SPECS for r in s.rules]
    + [f"SELECT '{s.name}', 'well_formed_record', 'warn', CAST(0 AS BIGINT), CAST(count(*) AS BIGINT) FROM {s.name}" for s in RAW_SPECS]
    + [_counted(s.name, f"typed_{s.name}", r) for s in CLEAN_SPECS for r in s.rules])


# ---- the validation reports -------------------------------------------------------------------

def _report_query(build, ids: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = build(spark, load_tables(spark, model_run(spark, sf)))
        metric = F.when(~F.col("check_id").isin("QA-10", "QA-26"), F.round("metric", 6))
        return rows.withColumn("metric", metric)
    run.__doc__ = (f"{ids}, QA-27 on the model's tables. Ages against the clock are not compared, their status is; "
                   "other metrics are rounded to six places.")
    return run


def report_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-09, SNK-05, QA-27: the star-schema report over tables read by name from a catalog
    database in which the run's tables were registered."""
    layout, database = model_run(spark, sf), "lakeward_model"
    register_layout(spark, layout, database)
    rows = gold_report(spark, load_tables(spark, layout, database=database))
    return rows.withColumn("metric", F.when(F.col("check_id") != "QA-26", F.round("metric", 6)))


def _result(check: str, table: str, column: str | None, metric: str, ok: str | None, threshold: str,
            source: str, counted: str = "NULL", total: str = "NULL") -> str:
    status = "'INFO'" if ok is None else f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END"
    named = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT '{check}' AS check_id, '{table}' AS table_name, {named} AS column_name, {status} AS status, "
            f"round(CAST({metric} AS DOUBLE), 6) AS metric, '{threshold}' AS threshold, "
            f"CAST({counted} AS BIGINT) AS counted, CAST({total} AS BIGINT) AS total FROM {source}")


def _violations(check: str, table: str, column: str, where: str) -> str:
    return _result(check, table, column, "m", "m = 0", "= 0",
                   f"(SELECT count(*) FILTER (WHERE {where}) AS m, count(*) AS n FROM g_{table}) x", "m", "n")


def _fixed(check: str, table: str, column: str, threshold: str, metric: str = "0") -> str:
    return _result(check, table, column, metric, "true", threshold, "(SELECT 1) x")


def _surplus(check: str, table: str, keys: str) -> str:
    return _result(check, table, keys, "m", "m = 0", "= 0",
                   f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM g_{table}) k) AS m, "
                   f"count(*) AS n FROM g_{table}) x", "m", "n")


def _orphans(check: str, table: str, column: str, parent: str, key: str, skip_null: bool = False,
             tolerance: float | None = None) -> str:
    child = f"(SELECT {column} AS k FROM g_{table}" + (f" WHERE {column} IS NOT NULL" if skip_null else "") + ") c"
    found = (f"(SELECT count(*) AS n, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM g_{parent} p WHERE p.{key} = c.k)) AS o "
             f"FROM {child}) x")
    name = f"{column}->{parent}.{key}"
    if tolerance is None:
        return _result(check, table, name, "o", "o = 0", "= 0", found, "o", "n")
    share = "coalesce(o * 100.0::DOUBLE / nullif(n, 0), 0)"
    return _result(check, table, name, share, f"{share} < {tolerance}", f"< {tolerance}", found, "o", "n")


def _reconciled(check: str, up: str, table: str, metric: str, test: str) -> str:
    return _result(check, table, None, metric, f"{metric} {test}", test,
                   f"(SELECT (SELECT count(*) FROM g_{up}) AS u, (SELECT count(*) FROM g_{table}) AS d) x", "d", "u")


def _report_sql(rows: list[str]) -> str:
    tables = [f"g_{s.name} AS (SELECT * FROM {s.name})" for s in (*RAW_SPECS, *CLEAN_SPECS)]
    tables += [f"g_{name} AS ({sql.strip()})" for name, sql in GOLD_SQL.items()]
    return _with().rstrip() + ",\n" + ",\n".join(tables) + "\n" + "\nUNION ALL ".join(rows)


_SILVER_NOT_NULL = [("name_basics", "nconst"), ("title_basics", "tconst"), ("title_ratings", "tconst"),
                    ("title_episode", "tconst"), ("title_akas", "title_id"), ("title_principals", "tconst"),
                    ("title_principals", "nconst"), ("title_crew", "tconst")]
_SILVER_FORMATS = [("name_basics", "nconst", "nm"), ("title_basics", "tconst", "tt"), ("title_ratings", "tconst", "tt"),
                   ("title_episode", "tconst", "tt"), ("title_principals", "tconst", "tt"), ("title_crew", "tconst", "tt"),
                   ("title_akas", "title_id", "tt")]
_SILVER_RANGES = [
    ("name_basics", "birth_year", "birth_year <= 0"), ("name_basics", "death_year", "death_year <= 0"),
    ("title_basics", "start_year", "start_year < 1850 OR start_year > 2035"),
    ("title_basics", "end_year", "end_year < 1850 OR end_year > 2035"),
    ("title_basics", "runtime_minutes", "runtime_minutes <= 0"),
    ("title_ratings", "average_rating", "average_rating < 1.0 OR average_rating > 10.0"),
    ("title_ratings", "num_votes", "num_votes <= 0")]
_SILVER_TYPES = [
    ("name_basics", "birth_year", "int"), ("name_basics", "death_year", "int"), ("title_basics", "start_year", "int"),
    ("title_basics", "end_year", "int"), ("title_basics", "runtime_minutes", "int"), ("title_basics", "is_adult", "boolean"),
    ("title_ratings", "average_rating", "double"), ("title_ratings", "num_votes", "int"),
    ("title_episode", "season_number", "int"), ("title_episode", "episode_number", "int"), ("title_akas", "ordering", "int"),
    ("title_akas", "is_original_title", "boolean"), ("title_principals", "ordering", "int")]
_TITLE_TYPES = ("'movie', 'short', 'tvSeries', 'tvEpisode', 'tvMiniSeries', 'tvMovie', 'tvSpecial', 'tvShort', 'video', "
                "'videoGame', 'tvPilot'")
QUERIES["silver_report"] = _report_query(silver_report, "QA-01..10, SET-01")
ORACLE["silver_report"] = _report_sql(
    [_violations("QA-02", f"silver_{t}", c, f"{c} IS NULL") for t, c in _SILVER_NOT_NULL]
    + [_violations("QA-04", f"silver_{t}", c, f"NOT regexp_matches({c}, '^{p}[0-9]+$')") for t, c, p in _SILVER_FORMATS]
    + [_violations("QA-05", f"silver_{t}", c, w) for t, c, w in _SILVER_RANGES]
    + [_violations("QA-07", "silver_title_basics", "title_type", f"title_type NOT IN ({_TITLE_TYPES})"),
       _violations("QA-08", "silver_title_episode", "tconst=parent_tconst", "tconst = parent_tconst"),
       _orphans("QA-08", "silver_title_episode", "parent_tconst", "silver_title_basics", "tconst")]
    + [_fixed("QA-10", s.name, "silver_processed_at", "< 24.0", "NULL") for s in CLEAN_SPECS]
    + [_reconciled("QA-01", s.source, s.name, "(u - d) * 100.0::DOUBLE / u", "<= 5.0") for s in CLEAN_SPECS]
    + [_fixed("QA-03", f"silver_{t}", c, f"{k}|{k}") for t, c, k in _SILVER_TYPES]
    + [_fixed("QA-06", f"silver_{t}", c, "array") for t, c in (
        ("title_basics", "genres"), ("name_basics", "primary_professions"), ("title_crew", "directors"))]
    + [_surplus("QA-09", f"silver_{t}", k) for t, k in (
        ("name_basics", "nconst"), ("title_basics", "tconst"), ("title_ratings", "tconst"), ("title_crew", "tconst"),
        ("title_akas", "title_id,ordering"), ("title_principals", "tconst,ordering"))])

_GOLD_NON_EMPTY = ("person", "genre", "category", "job", "region", "language", "title_alternates")
_GOLD_RULES = [
    ("QA-14", "gold_dim_genre", "genre_key", "genre_key IS NULL"),
    ("QA-15", "gold_dim_category", "department", "department NOT IN ('cast', 'directing', 'production', 'writing', 'other')"),
    ("QA-17", "gold_fact_ratings", "average_rating", "average_rating < 1.0 OR average_rating > 10.0"),
    ("QA-17", "gold_fact_ratings", "num_votes", "num_votes <= 0"), ("QA-14", "gold_fact_ratings", "tconst", "tconst IS NULL"),
    ("QA-17", "gold_fact_episodes", "season_number", "season_number < 0"),
    ("QA-17", "gold_fact_episodes", "episode_number", "episode_number < 0"),
    ("QA-18", "gold_fact_episodes", "episode_tconst=series_tconst", "episode_tconst = series_tconst"),
    ("QA-14", "gold_fact_title_credits", "tconst", "tconst IS NULL"),
    ("QA-14", "gold_fact_title_credits", "nconst", "nconst IS NULL"),
    ("QA-17", "gold_fact_title_credits", "ordering", "ordering <= 0"),
    ("QA-14", "gold_bridge_title_genre", "tconst", "tconst IS NULL"),
    ("QA-14", "gold_bridge_title_genre", "genre_key", "genre_key IS NULL")]
_RATING_FACTS = [("avg_rating", "avg(average_rating)"), ("min_rating", "min(average_rating)"),
                 ("max_rating", "max(average_rating)"), ("avg_votes", "avg(num_votes)"), ("total_votes", "sum(num_votes)")]
_NAMED = "coalesce(count(*) FILTER (WHERE region_name <> region_key) * 100.0::DOUBLE / nullif(count(*), 0), 0)"
_PERSON = "(SELECT count(*) AS n, count(DISTINCT nconst) AS k FROM g_gold_dim_person) x"
QUERIES["gold_report"] = _report_query(gold_report, "QA-11..26, AGG-07, SET-01")
ORACLE["gold_report"] = _report_sql(
    [_result("QA-11", t, None, "n", "n > 0", "> 0", f"(SELECT count(*) AS n FROM g_{t}) x", "n", "n") for t in (
        *(f"gold_dim_{n}" for n in _GOLD_NON_EMPTY), "gold_fact_episodes", "gold_fact_title_credits",
        "gold_bridge_title_genre")]
    + [_violations(*r) for r in _GOLD_RULES]
    + [_result("QA-16", "gold_dim_region", "region_name", "m", "m >= 80.0", ">= 80.0",
               f"(SELECT {_NAMED} AS m, count(*) FILTER (WHERE region_name <> region_key) AS c, count(*) AS n "
               "FROM g_gold_dim_region) x", "c", "n")]
    + [_result("QA-23", t, c, "c * 100.0::DOUBLE / n", None, "",
               f"(SELECT count(\"{c}\") AS c, count(*) AS n FROM g_{t}) x", "c", "n")
       for t, c in (("gold_dim_title", "primaryTitle"), ("gold_dim_title", "titleType"), ("gold_dim_title", "startYear"),
                    ("gold_dim_person", "primaryName"), ("gold_dim_person", "birthYear"),
                    ("gold_dim_person", "primaryProfession"))]
    + [_result("QA-24", "gold_fact_ratings", name, "m", None, "", f"(SELECT {value} AS m FROM g_gold_fact_ratings) x")
       for name, value in _RATING_FACTS]
    + [_fixed("QA-26", t, "load_dt", "< 24.0", "NULL") for t in (
        "gold_dim_title", "gold_dim_genre", "gold_dim_category", "gold_dim_region", "gold_dim_language",
        "gold_dim_title_alternates", "gold_bridge_title_genre", "gold_fact_ratings", "gold_fact_episodes",
        "gold_fact_title_credits")]
    + [_reconciled("QA-13", "silver_title_basics", "gold_dim_title", "d * 100.0::DOUBLE / u", ">= 95.0"),
       _reconciled("QA-13", "silver_title_ratings", "gold_fact_ratings", "d * 100.0::DOUBLE / u", ">= 99.0"),
       _orphans("QA-19", "gold_bridge_title_genre", "genre_key", "gold_dim_genre", "genre_key"),
       _orphans("QA-20", "gold_dim_title_alternates", "region_key", "gold_dim_region", "region_key", True),
       _orphans("QA-20", "gold_dim_title_alternates", "language_key", "gold_dim_language", "language_key", True),
       _orphans("QA-20", "gold_fact_ratings", "tconst", "gold_dim_title", "tconst"),
       _orphans("QA-20", "gold_fact_episodes", "episode_tconst", "gold_dim_title", "tconst"),
       _orphans("QA-20", "gold_fact_episodes", "series_tconst", "gold_dim_title", "tconst"),
       _orphans("QA-20", "gold_fact_title_credits", "tconst", "gold_dim_title", "tconst"),
       _orphans("QA-20", "gold_fact_title_credits", "nconst", "gold_dim_person", "nconst", False, 1.0),
       _orphans("QA-20", "gold_fact_title_credits", "category_key", "gold_dim_category", "category_key"),
       _surplus("QA-19", "gold_bridge_title_genre", "tconst,genre_key")]
    + [_surplus("QA-25", t, k) for t, k in (
        ("gold_dim_title", "tconst"), ("gold_dim_genre", "genre_key"), ("gold_dim_category", "category_key"),
        ("gold_dim_job", "job_key"), ("gold_dim_region", "region_key"), ("gold_dim_language", "language_key"),
        ("gold_dim_title_alternates", "alternate_key"), ("gold_fact_ratings", "tconst"))]
    + [_fixed("QA-12", "gold_dim_person", "__START_AT,__END_AT", "all present"),
       _fixed("QA-12", "gold_dim_person", "primaryName,deathYear,primaryProfession", "all present"),
       _result("QA-21", "gold_dim_person", "current_rows", "n", "n > 0", "> 0", _PERSON, "n", "n"),
       _result("QA-21", "gold_dim_person", "historical_rows", "0", None, "", _PERSON, "0", "n"),
       _result("QA-21", "gold_dim_person", "total_rows", "n", None, "", _PERSON, "n", "n"),
       _result("QA-21", "gold_dim_person", "distinct_keys", "k", None, "", _PERSON, "k", "n"),
       _result("QA-22", "gold_dim_person", "overlap_pairs", "0", "true", "= 0", _PERSON, "0", "n"),
       _result("QA-22", "gold_dim_person", "strict_overlaps", "0", "true", "= 0", _PERSON, "0", "n")])

QUERIES["gold_report_by_name"] = report_by_name
ORACLE["gold_report_by_name"] = ORACLE["gold_report"]


def q_title_types(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-08: the value distribution of the raw -> cleansed suite."""
    return title_type_distribution(load_tables(spark, model_run(spark, sf), ["silver_title_basics"]))


QUERIES["title_types"] = q_title_types
ORACLE["title_types"] = _with() + ("SELECT title_type, count(*) AS \"count\" FROM silver_title_basics "
                                   "GROUP BY title_type ORDER BY count(*) DESC, title_type LIMIT 15")
