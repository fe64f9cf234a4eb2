"""Cleansed (typed) tables of the film/TV model: SV-1..7 = projection + rules (PRJ-*, EX-09..39).

Each ``project_*`` maps a bronze frame (all STRING) to typed columns; ``cleanse`` adds
the dataset's rules. Works unchanged on a streaming bronze source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeward.functions.cleanse import (DIGITS, YEAR_1_TO_4_DIGITS, YEAR_4_DIGITS, carry_load_time,
                                        flag, guarded_int, lower_code, split_list, strip_brackets,
                                        text, to_double, to_int, upper_code)
from lakeward.operators.expectations import expect
from lakeward.specs import clean_spec


def project_name_basics(b: DataFrame) -> DataFrame:
    """SV-1 projection (PRJ-01/02/03/09/13); rules EX-09..13."""
    return b.select(
        text("nconst").alias("nconst"),
        text("primaryName").alias("primary_name"),
        guarded_int("birthYear", YEAR_1_TO_4_DIGITS).alias("birth_year"),
        guarded_int("deathYear", YEAR_1_TO_4_DIGITS).alias("death_year"),
        split_list("primaryProfession").alias("primary_professions"),
        split_list("knownForTitles").alias("known_for_titles"),
        *carry_load_time())


def project_title_basics(b: DataFrame) -> DataFrame:
    """SV-2 projection (PRJ-01/02/04/05/08/09/13); rules EX-14..22."""
    return b.select(
        text("tconst").alias("tconst"),
        text("titleType").alias("title_type"),
        text("primaryTitle").alias("primary_title"),
        text("originalTitle").alias("original_title"),
        flag("isAdult").alias("is_adult"),
        guarded_int("startYear", YEAR_4_DIGITS).alias("start_year"),
        guarded_int("endYear", YEAR_4_DIGITS).alias("end_year"),
        guarded_int("runtimeMinutes", DIGITS).alias("runtime_minutes"),
        split_list("genres").alias("genres"),
        *carry_load_time())


def project_title_ratings(b: DataFrame) -> DataFrame:
    """SV-3 projection (PRJ-01/02/06/07/13); rules EX-23..25."""
    return b.select(
        text("tconst").alias("tconst"),
        to_double("averageRating").alias("average_rating"),
        to_int("numVotes").alias("num_votes"),
        *carry_load_time())


def project_title_episode(b: DataFrame) -> DataFrame:
    """SV-4 projection (PRJ-01/02/05/13); rules EX-26..30."""
    return b.select(
        text("tconst").alias("tconst"),
        text("parentTconst").alias("parent_tconst"),
        guarded_int("seasonNumber", DIGITS).alias("season_number"),
        guarded_int("episodeNumber", DIGITS).alias("episode_number"),
        *carry_load_time())


def project_title_akas(b: DataFrame) -> DataFrame:
    """SV-5 projection (PRJ-01/02/06/08/09/10/11/13); rules EX-31..34."""
    return b.select(
        text("titleId").alias("title_id"),
        to_int("ordering").alias("ordering"),
        text("title").alias("title"),
        upper_code("region").alias("region"),
        lower_code("language").alias("language"),
        split_list("types").alias("types"),
        text("attributes").alias("attributes"),
        flag("isOriginalTitle").alias("is_original_title"),
        *carry_load_time())


def project_title_principals(b: DataFrame) -> DataFrame:
    """SV-6 projection (PRJ-01/02/06/11/12/13); rules EX-35..38."""
    return b.select(
        text("tconst").alias("tconst"),
        to_int("ordering").alias("ordering"),
        text("nconst").alias("nconst"),
        lower_code("category").alias("category"),
        text("job").alias("job"),
        strip_brackets("characters").alias("characters"),
        *carry_load_time())


def project_title_crew(b: DataFrame) -> DataFrame:
    """SV-7 projection (PRJ-01/02/09/13); rules EX-39."""
    return b.select(
        text("tconst").alias("tconst"),
        split_list("directors").alias("directors"),
        split_list("writers").alias("writers"),
        *carry_load_time())


PROJECTIONS = {
    "silver_name_basics": project_name_basics,
    "silver_title_basics": project_title_basics,
    "silver_title_ratings": project_title_ratings,
    "silver_title_episode": project_title_episode,
    "silver_title_akas": project_title_akas,
    "silver_title_principals": project_title_principals,
    "silver_title_crew": project_title_crew,
}


def cleanse(name: str, bronze: DataFrame, observation=None) -> DataFrame:
    """SV-n: project, then count every rule and drop rows failing a drop rule (EXP-03)."""
    return expect(PROJECTIONS[name](bronze), clean_spec(name).rules, observation)


def drop_stamps(df: DataFrame) -> DataFrame:
    """Leave out clock columns for value comparisons."""
    return df.drop(*[c for c in ("source_loaded_at", "silver_processed_at", "_loaded_at",
                                 "load_dt") if c in df.columns])


__all__ = ["cleanse", "PROJECTIONS", "drop_stamps"]
