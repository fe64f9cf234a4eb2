"""Star schema of the film/TV model (GD-01..13) built from cleansed frames.

Stream-capable builders take a (streaming or batch) cleansed frame; the two coded
dimensions (GD-07/08) are batch recomputes over the whole cleansed table plus a lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.dims import (alternates, coded_dimension, composite_dimension,
                                     exploded_dimension, mapped_dimension, renamed)
from lakeward.operators.facts import bridge, credits_fact, fact
from lakeward.operators.scd2 import change_feed, scd2_history
from lakeward.specs import DEFAULT_DEPARTMENT, DEPARTMENTS, LOADED_BY, PERSON_TRACKED

STAMP = "load_dt"


def person_changes(silver_names: DataFrame) -> DataFrame:
    """GD-01 / SCD-03 / SNK-04: change feed for the person dimension (an unstored view is
    just this function returning a DataFrame)."""
    return change_feed(silver_names, {
        "nconst": "nconst",
        "primaryName": "primary_name",
        "birthYear": "birth_year",
        "deathYear": "death_year",
        "primaryProfession": F.array_join(F.col("primary_professions"), ","),
        "profession_count": F.size(F.col("primary_professions")),
        "knownForTitles": "known_for_titles",
    }, STAMP, ("source_file", "silver_name_basics"))


def dim_person(changes: DataFrame, bucket_width: int | None = None) -> DataFrame:
    """GD-02 / SCD-01: type-2 person dimension (batch form; SCD-02 is the stream form)."""
    return scd2_history(changes, ["nconst"], STAMP, PERSON_TRACKED, bucket_width)


def dim_title(titles: DataFrame) -> DataFrame:
    """GD-03: renamed pass-through; genres left out; no de-duplication."""
    return renamed(titles, {
        "tconst": "tconst", "titleType": "title_type", "primaryTitle": "primary_title",
        "originalTitle": "original_title", "isAdult": "is_adult", "startYear": "start_year",
        "endYear": "end_year", "runtimeMinutes": "runtime_minutes"},
        {"source_file": "silver_title_basics"}, STAMP)


def dim_genre(titles: DataFrame) -> DataFrame:
    """GD-04."""
    return exploded_dimension(titles, "genres", "genre_key", "genre_name", STAMP)


def dim_category(principals: DataFrame) -> DataFrame:
    """GD-05: categories with their department."""
    return mapped_dimension(principals, "category", "category_key", "category_name",
                            "department", DEPARTMENTS, DEFAULT_DEPARTMENT, STAMP)


def dim_job(principals: DataFrame) -> DataFrame:
    """GD-06: non-NULL jobs keyed ``category_job``."""
    return composite_dimension(principals, "category", "job", "job_key", "category_key",
                               "job_name", "job_description", STAMP)


def dim_region(akas: DataFrame, countries: DataFrame) -> DataFrame:
    """GD-07: region codes named from the country lookup (code fallback)."""
    return coded_dimension(akas, "region", countries, "region_code", "region_name",
                           "region_key", "region_code", "region_name", STAMP)


def dim_language(akas: DataFrame, languages: DataFrame) -> DataFrame:
    """GD-08: language codes named from the language lookup (code fallback)."""
    return coded_dimension(akas, "language", languages, "language_code", "language_name",
                           "language_key", "language_code", "language_name", STAMP)


def dim_title_alternates(akas: DataFrame) -> DataFrame:
    """GD-09."""
    return alternates(akas, "title_id", "ordering", "alternate_key", [
        ("tconst", "title_id"), ("region_key", F.trim("region")),
        ("language_key", F.trim("language")), ("localized_title", "title"),
        ("release_type", "types"), ("attributes", "attributes"),
        ("is_original_title", "is_original_title"), ("ordering", "ordering")],
        STAMP, {"source_file": "silver_title_akas"})


def bridge_title_genre(titles: DataFrame) -> DataFrame:
    """GD-10."""
    return bridge(titles, "tconst", "genres", "genre_key", stamp=STAMP)


def fact_ratings(ratings: DataFrame) -> DataFrame:
    """GD-11."""
    return fact(ratings, {"tconst": "tconst", "average_rating": "average_rating",
                          "num_votes": "num_votes"},
                {"source_file": "silver_title_ratings", LOADED_BY[0]: LOADED_BY[1]}, STAMP)


def fact_episodes(episodes: DataFrame) -> DataFrame:
    """GD-12."""
    return fact(episodes, {"episode_tconst": "tconst", "series_tconst": "parent_tconst",
                           "season_number": "season_number", "episode_number": "episode_number"},
                {"source_file": "silver_title_episode", LOADED_BY[0]: LOADED_BY[1]}, STAMP)


def fact_title_credits(principals: DataFrame) -> DataFrame:
    """GD-13."""
    return credits_fact(principals, "tconst", "nconst", "category", "job", "ordering",
                        {"characters": "characters"},
                        {"source_file": "silver_title_principals", LOADED_BY[0]: LOADED_BY[1]},
                        STAMP)


# Streaming gold tables: name -> (cleansed source, builder).
STREAMING_GOLD = {
    "gold_dim_title": ("silver_title_basics", dim_title),
    "gold_dim_genre": ("silver_title_basics", dim_genre),
    "gold_dim_category": ("silver_title_principals", dim_category),
    "gold_dim_job": ("silver_title_principals", dim_job),
    "gold_dim_title_alternates": ("silver_title_akas", dim_title_alternates),
    "gold_bridge_title_genre": ("silver_title_basics", bridge_title_genre),
    "gold_fact_ratings": ("silver_title_ratings", fact_ratings),
    "gold_fact_episodes": ("silver_title_episode", fact_episodes),
    "gold_fact_title_credits": ("silver_title_principals", fact_title_credits),
}


# Streaming tables with one row per key (STR-03): kept by ``new_keys_stream``.
ONE_ROW_PER_KEY = {"gold_dim_genre": "genre_key", "gold_dim_category": "category_key",
                   "gold_dim_job": "job_key"}


# Table comments of the star schema (catalog metadata, SNK-05).
COMMENTS = {
    "gold_dim_person": "People, type-2 history of name, death year and professions",
    "gold_dim_title": "Titles",
    "gold_dim_genre": "Genres",
    "gold_dim_category": "Credit categories with their department",
    "gold_dim_job": "Jobs within a credit category",
    "gold_dim_region": "Regions named from the country lookup",
    "gold_dim_language": "Languages named from the language lookup",
    "gold_dim_title_alternates": "Localized titles per region and language",
    "gold_bridge_title_genre": "Title to genre bridge",
    "gold_fact_ratings": "Ratings",
    "gold_fact_episodes": "Episodes of series",
    "gold_fact_title_credits": "Cast and crew credits",
}
