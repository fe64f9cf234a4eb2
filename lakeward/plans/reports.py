"""Validation reports of the film/TV model (QA-27): a raw->cleansed suite and a
cleansed->star-schema suite, each returning ONE result DataFrame of check rows.

All measures of one table are evaluated in a single aggregate; duplicate, reconcile and
foreign-key checks are scans of their own that pre-aggregate per key before shuffling. A check
whose table (or whose table's partner) is absent is a FAIL row without a metric.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators import checks as K
from lakeward.operators.scd2 import END, START, reference_overlaps, split_counts, strict_overlaps
from lakeward.specs import (FOREIGN_KEYS, FRESHNESS_HOURS, GOLD_FRESH, GOLD_KEYS, MAX_DROP_PCT,
                            MAX_TITLE_YEAR, MIN_RATINGS_RATIO_PCT, MIN_REGION_NAMED_PCT,
                            MIN_TITLE_RATIO_PCT, MIN_TITLE_YEAR, PERSON_ID, PERSON_TRACKED,
                            RATING_OUT_OF_RANGE, SILVER_KEYS, SILVER_NOT_NULL, SILVER_PAIRS,
                            SILVER_TYPES, TITLE_ID, VALID_DEPARTMENTS, VALID_TITLE_TYPES)


def _measured(tables: dict, measures: dict, absent: list) -> list[DataFrame]:
    """One aggregate per table; the checks of absent tables go to ``absent``."""
    for t, ms in measures.items():
        if t not in tables:
            absent += [(m.check_id, t, m.column, K.FAIL, None, m.threshold or "table present")
                       for m in ms]
    return [K.measure_table(tables[t], t, ms) for t, ms in measures.items() if t in tables]


def _present(tables: dict, absent: list, check_id: str, table: str, column: str | None,
             *names: str) -> bool:
    """Whether all named tables are there; else a FAIL row names the missing ones."""
    missing = [n for n in names if n not in tables]
    if missing:
        absent.append((check_id, table, column, K.FAIL, None, "table present: " + ",".join(missing)))
    return not missing


def silver_report(spark: SparkSession, tables: dict, as_of: Column | None = None) -> DataFrame:
    """Raw -> cleansed checks (QA-01..10). ``tables``: name -> DataFrame."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    m: dict = defaultdict(list)
    for t, c in SILVER_NOT_NULL:
        m[t].append(K.not_null(c))
    m["silver_name_basics"].append(K.id_format("nconst", PERSON_ID))
    for t in ("silver_title_basics", "silver_title_ratings", "silver_title_episode",
              "silver_title_principals", "silver_title_crew"):
        m[t].append(K.id_format("tconst", TITLE_ID))
    m["silver_title_akas"].append(K.id_format("title_id", TITLE_ID))
    m["silver_name_basics"] += [
        K.violations("birth_year", "birth_year IS NOT NULL AND birth_year <= 0"),
        K.violations("death_year", "death_year IS NOT NULL AND death_year <= 0")]
    m["silver_title_basics"] += [
        K.violations("start_year", f"start_year IS NOT NULL AND (start_year < {MIN_TITLE_YEAR} "
                                   f"OR start_year > {MAX_TITLE_YEAR})"),
        K.violations("end_year", f"end_year IS NOT NULL AND (end_year < {MIN_TITLE_YEAR} "
                                 f"OR end_year > {MAX_TITLE_YEAR})"),
        K.violations("runtime_minutes", "runtime_minutes IS NOT NULL AND runtime_minutes <= 0"),
        K.allowed_values("title_type", VALID_TITLE_TYPES)]
    m["silver_title_ratings"] += [
        K.violations("average_rating", RATING_OUT_OF_RANGE),
        K.violations("num_votes", "num_votes <= 0")]
    m["silver_title_episode"].append(K.self_reference("tconst", "parent_tconst"))
    for _, t in SILVER_PAIRS:
        m[t].append(K.freshness("silver_processed_at", as_of, FRESHNESS_HOURS))

    rows: list = []
    out = _measured(tables, m, rows)
    out += [K.reconcile(tables[b], tables[s], s, max_drop_pct=MAX_DROP_PCT)
            for b, s in SILVER_PAIRS if _present(tables, rows, "QA-01", s, None, b, s)]
    for t, c, typ in SILVER_TYPES:
        if _present(tables, rows, "QA-03", t, c, t):
            rows += K.column_types(tables[t], t, {c: typ})
    for t, c in [("silver_title_basics", "genres"), ("silver_name_basics", "primary_professions"),
                 ("silver_title_crew", "directors")]:
        if _present(tables, rows, "QA-06", t, c, t):
            rows += K.array_columns(tables[t], t, [c])
    if _present(tables, rows, "QA-08", "silver_title_episode", "parent_tconst",
                "silver_title_episode", "silver_title_basics"):
        out.append(K.foreign_key(tables["silver_title_episode"], "silver_title_episode",
                                 "parent_tconst", tables["silver_title_basics"],
                                 "silver_title_basics", "tconst", check_id="QA-08"))
    out += [K.duplicate_keys(tables[t], t, k) for t, k in SILVER_KEYS.items()
            if _present(tables, rows, "QA-09", t, ",".join(k), t)]
    if rows:
        out.append(K.result_rows(spark, rows))
    return K.union_results(out)


def distribution(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """AGG-08, SRT-01, LIM-01: top-``n`` value counts, ties broken by the value."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(column)).limit(n))


def title_type_distribution(tables: dict) -> DataFrame | None:
    """The value distribution that goes with the raw -> cleansed suite: title types by count."""
    titles = tables.get("silver_title_basics")
    return None if titles is None else distribution(titles, "title_type")


def gold_report(spark: SparkSession, tables: dict, as_of: Column | None = None) -> DataFrame:
    """Cleansed -> star-schema checks (QA-11..26). ``tables``: name -> DataFrame."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    m: dict = defaultdict(list)
    for t in ("gold_dim_person", "gold_dim_genre", "gold_dim_category", "gold_dim_job",
              "gold_dim_region", "gold_dim_language", "gold_dim_title_alternates",
              "gold_fact_episodes", "gold_fact_title_credits", "gold_bridge_title_genre"):
        m[t].append(K.non_empty())
    m["gold_dim_genre"].append(K.not_null("genre_key", "QA-14"))
    m["gold_dim_category"].append(K.allowed_values("department", VALID_DEPARTMENTS, "QA-15"))
    m["gold_dim_region"].append(K.named_share("region_name", "region_key",
                                              MIN_REGION_NAMED_PCT))
    m["gold_fact_ratings"] += [
        K.violations("average_rating", RATING_OUT_OF_RANGE, "QA-17"),
        K.violations("num_votes", "num_votes <= 0", "QA-17"),
        K.not_null("tconst", "QA-14")]
    m["gold_fact_episodes"] += [
        K.violations("season_number", "season_number IS NOT NULL AND season_number < 0", "QA-17"),
        K.violations("episode_number", "episode_number IS NOT NULL AND episode_number < 0",
                     "QA-17"),
        K.self_reference("episode_tconst", "series_tconst", "QA-18")]
    m["gold_fact_title_credits"] += [K.not_null("tconst", "QA-14"), K.not_null("nconst", "QA-14"),
                                     K.violations("ordering", "ordering <= 0", "QA-17")]
    m["gold_bridge_title_genre"] += [K.not_null("tconst", "QA-14"),
                                     K.not_null("genre_key", "QA-14")]
    m["gold_dim_title"] += [K.completeness(c) for c in ("primaryTitle", "titleType", "startYear")]
    m["gold_dim_person"] += [K.completeness(c) for c in ("primaryName", "birthYear",
                                                         "primaryProfession")]
    m["gold_fact_ratings"] += [
        K.statistic("avg_rating", F.avg("average_rating")),
        K.statistic("min_rating", F.min("average_rating")),
        K.statistic("max_rating", F.max("average_rating")),
        K.statistic("avg_votes", F.avg("num_votes")),
        K.statistic("total_votes", F.sum("num_votes"))]
    schema_rows = []
    for t in GOLD_FRESH:
        if t not in tables:
            schema_rows.append(("QA-26", t, "load_dt", K.FAIL, None, "table readable"))
        elif "load_dt" not in tables[t].columns:
            schema_rows.append(("QA-26", t, "load_dt", K.WARN, None, "load_dt column"))
        else:
            m[t].append(K.freshness("load_dt", as_of, FRESHNESS_HOURS, "QA-26", empty_status=K.WARN))

    out = _measured(tables, m, schema_rows)
    if _present(tables, schema_rows, "QA-13", "gold_dim_title", None, "gold_dim_title",
                "silver_title_basics"):
        out.append(K.reconcile(tables["silver_title_basics"], tables["gold_dim_title"],
                               "gold_dim_title", min_ratio_pct=MIN_TITLE_RATIO_PCT,
                               check_id="QA-13"))
    if _present(tables, schema_rows, "QA-13", "gold_fact_ratings", None, "gold_fact_ratings",
                "silver_title_ratings"):
        out.append(K.reconcile(tables["silver_title_ratings"], tables["gold_fact_ratings"],
                               "gold_fact_ratings", min_ratio_pct=MIN_RATINGS_RATIO_PCT,
                               check_id="QA-13"))
    for fk in FOREIGN_KEYS:
        cid = "QA-19" if fk.child == "gold_bridge_title_genre" else "QA-20"
        if fk.audited and _present(tables, schema_rows, cid, fk.child,
                                   f"{fk.child_col}->{fk.parent}.{fk.parent_col}", fk.child, fk.parent):
            out.append(K.foreign_key(tables[fk.child], fk.child, fk.child_col, tables[fk.parent],
                                     fk.parent, fk.parent_col, fk.skip_null, fk.tolerance_pct,
                                     check_id=cid))
    if _present(tables, schema_rows, "QA-19", "gold_bridge_title_genre", "tconst,genre_key",
                "gold_bridge_title_genre"):
        out.append(K.duplicate_keys(tables["gold_bridge_title_genre"], "gold_bridge_title_genre",
                                    ["tconst", "genre_key"], "QA-19"))
    out += [K.duplicate_keys(tables[t], t, k, "QA-25") for t, k in GOLD_KEYS.items()
            if _present(tables, schema_rows, "QA-25", t, ",".join(k), t)]
    if (_present(tables, schema_rows, "QA-12", "gold_dim_person", f"{START},{END}", "gold_dim_person")
            & _present(tables, schema_rows, "QA-21", "gold_dim_person", "current_rows", "gold_dim_person")
            & _present(tables, schema_rows, "QA-22", "gold_dim_person", "overlap_pairs", "gold_dim_person")):
        person = tables["gold_dim_person"]
        schema_rows += K.required_columns(person, "gold_dim_person", [START, END], "QA-12")
        schema_rows += K.required_columns(person, "gold_dim_person", PERSON_TRACKED, "QA-12")
        if START in person.columns and END in person.columns:
            out.append(scd2_report(person, ["nconst"]))
        else:
            schema_rows.append(("QA-21", "gold_dim_person", f"{START},{END}", K.WARN, None,
                                "SCD2 columns"))
    if schema_rows:
        out.append(K.result_rows(spark, schema_rows))
    return K.union_results(out)


def scd2_report(history: DataFrame, keys, table: str = "gold_dim_person") -> DataFrame:
    """QA-21 (current > 0; historical/total reported) and QA-22 (reference pair metric and
    the strict successor check) as result rows."""
    s = split_counts(history, keys)
    ref = reference_overlaps(history, keys)
    strict = strict_overlaps(history, keys)
    j = K.side_by_side(s, ref, strict)

    def row(cid, col, metric, ok, thr):
        count = metric.cast("long")
        status = F.lit(K.INFO) if ok is None else F.when(ok, F.lit(K.PASS)).otherwise(F.lit(K.FAIL))
        return F.struct(F.lit(cid).alias("check_id"), F.lit(table).alias("table_name"),
                        F.lit(col).alias("column_name"), status.alias("status"),
                        metric.cast("double").alias("metric"), F.lit(thr).alias("threshold"),
                        count.alias("counted"), F.col("total_rows").cast("long").alias("total"))

    rows = F.array(
        row("QA-21", "current_rows", F.col("current_rows"), F.col("current_rows") > 0, "> 0"),
        row("QA-21", "historical_rows", F.col("historical_rows"), None, ""),
        row("QA-21", "total_rows", F.col("total_rows"), None, ""),
        row("QA-21", "distinct_keys", F.col("distinct_keys"), None, ""),
        row("QA-22", "overlap_pairs", F.col("pairs"), F.col("pairs") == 0, "= 0"),
        row("QA-22", "strict_overlaps", F.col("overlaps"), F.col("overlaps") == 0, "= 0"))
    return j.select(F.explode(rows).alias("r")).select("r.*")
