"""Dataset specifications: columns, keys, quality rules and foreign keys as data.

The operators are generic; what makes a concrete layered model is only this data.
The values under "FIXED VALUES" must equal the modelled film/TV source for identical
results, so they are written out plainly and in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

WARN = "warn"
DROP = "drop"


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate over the projected row. ``warn`` counts, ``drop`` removes."""
    name: str
    predicate: str
    action: str = WARN


@dataclass(frozen=True)
class RawSpec:
    """One raw delimited file set (a directory) and its bronze table."""
    name: str                 # bronze table name
    folder: str               # sub-folder of the raw root
    columns: tuple            # header columns, all read as STRING
    keys: tuple               # logical key (duplicate audits)
    rules: tuple = ()         # warn rules on the bronze row
    multiline: bool = False   # SRC-03: off by default (quoting is off, P7)
    comment: str = ""


@dataclass(frozen=True)
class CleanSpec:
    """One cleansed table: source bronze table, keys and rules over the projection."""
    name: str
    source: str
    keys: tuple
    rules: tuple = ()
    comment: str = ""


@dataclass(frozen=True)
class ForeignKey:
    """child.column -> parent.column; optional NULL skipping and tolerance in %."""
    child: str
    child_col: str
    parent: str
    parent_col: str
    skip_null: bool = False
    tolerance_pct: float | None = None
    audited: bool = True


@dataclass
class TableLayout:
    """Where the layers live: ``<root>/<layer>/<table>``."""
    root: str
    layers: dict = field(default_factory=lambda: {
        "raw": "raw", "bronze": "bronze", "silver": "silver", "gold": "gold", "qa": "qa",
        "checkpoints": "_checkpoints"})

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.layers[layer]}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/{self.layers['checkpoints']}/{table}"


def not_null_prefix(col: str, prefix: str) -> str:
    return f"{col} IS NOT NULL AND {col} LIKE '{prefix}%'"


# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the modelled source for identical results.
# ---------------------------------------------------------------------------

# Allowed title types (enumeration rule and check).
VALID_TITLE_TYPES = [
    "movie", "short", "tvSeries", "tvEpisode", "tvMiniSeries",
    "tvMovie", "tvSpecial", "tvShort", "video", "videoGame", "tvPilot",
]

# Title year range (inclusive).
MIN_TITLE_YEAR = 1850
MAX_TITLE_YEAR = 2035

# Category -> department mapping, in evaluation order; anything else is "other".
DEPARTMENTS = [
    (["actor", "actress", "self"], "cast"),
    (["director", "cinematographer"], "directing"),
    (["producer", "production_designer"], "production"),
    (["writer", "editor"], "writing"),
]
DEFAULT_DEPARTMENT = "other"
VALID_DEPARTMENTS = ["cast", "directing", "production", "writing", "other"]

# Tracked (history-opening) columns of the person dimension.
PERSON_TRACKED = ["primaryName", "deathYear", "primaryProfession"]

# Quality thresholds of the validation reports.
MAX_DROP_PCT = 5.0            # raw -> cleansed
MIN_TITLE_RATIO_PCT = 95.0    # title dimension vs cleansed titles
MIN_RATINGS_RATIO_PCT = 99.0  # ratings fact vs cleansed ratings
MIN_REGION_NAMED_PCT = 80.0   # regions resolved to a name
MAX_PERSON_ORPHAN_PCT = 1.0   # credits without a person row
FRESHNESS_HOURS = 24.0
SCORE_WITH_DUPLICATES = 80.0
SCORE_CLEAN = 100.0

# Raw tables and the cleansed tables made of them (QA-01).
SILVER_PAIRS = [("bronze_name_basics", "silver_name_basics"),
                ("bronze_title_basics", "silver_title_basics"),
                ("bronze_title_ratings", "silver_title_ratings"),
                ("bronze_title_episode", "silver_title_episode"),
                ("bronze_title_akas", "silver_title_akas"),
                ("bronze_title_principals", "silver_title_principals"),
                ("bronze_title_crew", "silver_title_crew")]

# Key columns that must not be NULL (QA-02).
SILVER_NOT_NULL = [("silver_name_basics", "nconst"), ("silver_title_basics", "tconst"),
                   ("silver_title_ratings", "tconst"), ("silver_title_episode", "tconst"),
                   ("silver_title_akas", "title_id"), ("silver_title_principals", "tconst"),
                   ("silver_title_principals", "nconst"), ("silver_title_crew", "tconst")]

# Identifier patterns and the range of ratings (QA-04/05/17).
PERSON_ID, TITLE_ID = "^nm[0-9]+$", "^tt[0-9]+$"
RATING_OUT_OF_RANGE = "average_rating < 1.0 OR average_rating > 10.0"

# Expected cleansed types (QA-03).
SILVER_TYPES = [("silver_name_basics", "birth_year", "int"),
                ("silver_name_basics", "death_year", "int"),
                ("silver_title_basics", "start_year", "int"),
                ("silver_title_basics", "end_year", "int"),
                ("silver_title_basics", "runtime_minutes", "int"),
                ("silver_title_basics", "is_adult", "boolean"),
                ("silver_title_ratings", "average_rating", "double"),
                ("silver_title_ratings", "num_votes", "int"),
                ("silver_title_episode", "season_number", "int"),
                ("silver_title_episode", "episode_number", "int"),
                ("silver_title_akas", "ordering", "int"),
                ("silver_title_akas", "is_original_title", "boolean"),
                ("silver_title_principals", "ordering", "int")]

# Keys of cleansed tables (QA-09).
SILVER_KEYS = {"silver_name_basics": ["nconst"], "silver_title_basics": ["tconst"],
               "silver_title_ratings": ["tconst"], "silver_title_crew": ["tconst"],
               "silver_title_akas": ["title_id", "ordering"],
               "silver_title_principals": ["tconst", "ordering"]}

# Star-schema tables whose load time is checked (QA-26).
GOLD_FRESH = ["gold_dim_title", "gold_dim_genre", "gold_dim_category", "gold_dim_region",
              "gold_dim_language", "gold_dim_title_alternates", "gold_bridge_title_genre",
              "gold_fact_ratings", "gold_fact_episodes", "gold_fact_title_credits"]

# Literal values written into audit and fact tables.
RAW_TABLE_PREFIX = "bronze_"        # stripped to name the raw file in the load audit
RAW_FILE_SUFFIX = ".tsv.gz"
AUDIT_STATUS = "SUCCESS"
ISSUE_DUPLICATE_PK = "DUPLICATE_PK"
LOADED_BY = ("loaded_by", "dlt_pipeline")

# Raw file sets (BR-1..7): bronze table, folder, header columns, key, warn rules
# (EX-01..08, QL-7), multiLine (SRC-03).
RAW_SPECS = [
    RawSpec("bronze_name_basics", "name_basics",
            ("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"),
            ("nconst",), (Rule("valid_nconst", not_null_prefix("nconst", "nm")),),
            True, "People, as delivered (all text)"),
    RawSpec("bronze_title_basics", "title_basics",
            ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear",
             "endYear", "runtimeMinutes", "genres"),
            ("tconst",), (Rule("valid_tconst", not_null_prefix("tconst", "tt")),),
            True, "Titles, as delivered (all text)"),
    RawSpec("bronze_title_ratings", "title_ratings",
            ("tconst", "averageRating", "numVotes"),
            ("tconst",), (Rule("valid_tconst", not_null_prefix("tconst", "tt")),),
            False, "Title ratings, as delivered (all text)"),
    RawSpec("bronze_title_episode", "title_episode",
            ("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
            ("tconst",), (Rule("valid_tconst", not_null_prefix("tconst", "tt")),),
            False, "Episode links, as delivered (all text)"),
    RawSpec("bronze_title_akas", "title_akas",
            ("titleId", "ordering", "title", "region", "language", "types", "attributes",
             "isOriginalTitle"),
            ("titleId", "ordering"), (Rule("valid_titleid", not_null_prefix("titleId", "tt")),),
            True, "Localized titles, as delivered (all text)"),
    RawSpec("bronze_title_principals", "title_principals",
            ("tconst", "ordering", "nconst", "category", "job", "characters"),
            ("tconst", "ordering"),
            (Rule("valid_tconst", not_null_prefix("tconst", "tt")),
             Rule("valid_nconst", not_null_prefix("nconst", "nm"))),
            True, "Title credits, as delivered (all text)"),
    RawSpec("bronze_title_crew", "title_crew",
            ("tconst", "directors", "writers"),
            ("tconst",), (Rule("valid_tconst", not_null_prefix("tconst", "tt")),),
            False, "Directors and writers, as delivered (all text)"),
]

_TYPES = ",".join(repr(t) for t in VALID_TITLE_TYPES)

# Cleansed tables (SV-1..7): rules EX-09..39 evaluated on the projected row (names as in
# the projection).
CLEAN_SPECS = [
    CleanSpec("silver_name_basics", "bronze_name_basics", ("nconst",), (
        Rule("valid_nconst", not_null_prefix("nconst", "nm"), DROP),
        Rule("valid_nconst_format", "LENGTH(nconst) BETWEEN 9 AND 12", DROP),
        Rule("valid_birth_year", "birth_year IS NULL OR birth_year > 0"),
        Rule("valid_death_year", "death_year IS NULL OR death_year > 0"),
        Rule("valid_name", "primary_name IS NOT NULL AND LENGTH(primary_name) > 1", DROP),
    ), "People, typed and checked"),
    CleanSpec("silver_title_basics", "bronze_title_basics", ("tconst",), (
        Rule("valid_tconst", not_null_prefix("tconst", "tt"), DROP),
        Rule("valid_tconst_format", "LENGTH(tconst) BETWEEN 9 AND 12", DROP),
        Rule("valid_title_type", f"title_type IN ({_TYPES})"),
        Rule("valid_start_year",
             f"start_year IS NULL OR (start_year >= {MIN_TITLE_YEAR} AND start_year <= {MAX_TITLE_YEAR})"),
        Rule("valid_end_year",
             f"end_year IS NULL OR (end_year >= {MIN_TITLE_YEAR} AND end_year <= {MAX_TITLE_YEAR})"),
        Rule("valid_runtime", "runtime_minutes IS NULL OR runtime_minutes > 0"),
        Rule("start_before_end", "start_year IS NULL OR end_year IS NULL OR start_year <= end_year"),
        Rule("valid_is_adult", "is_adult IN (true, false)"),
        Rule("has_primary_title", "primary_title IS NOT NULL AND LENGTH(primary_title) >= 1"),
    ), "Titles, typed and checked"),
    CleanSpec("silver_title_ratings", "bronze_title_ratings", ("tconst",), (
        Rule("valid_tconst", not_null_prefix("tconst", "tt"), DROP),
        Rule("valid_rating_range", "average_rating >= 1.0 AND average_rating <= 10.0", DROP),
        Rule("valid_num_votes", "num_votes > 0", DROP),
    ), "Title ratings, typed and checked"),
    CleanSpec("silver_title_episode", "bronze_title_episode", ("tconst",), (
        Rule("valid_tconst", not_null_prefix("tconst", "tt"), DROP),
        Rule("valid_parent_tconst", not_null_prefix("parent_tconst", "tt"), DROP),
        Rule("valid_season_number", "season_number IS NULL OR season_number >= 0"),
        Rule("valid_episode_number", "episode_number IS NULL OR episode_number >= 0"),
        Rule("episode_not_same_as_parent", "tconst != parent_tconst"),
    ), "Episode links, typed and checked"),
    CleanSpec("silver_title_akas", "bronze_title_akas", ("title_id", "ordering"), (
        Rule("valid_title_id", not_null_prefix("title_id", "tt"), DROP),
        Rule("valid_ordering", "ordering IS NOT NULL AND ordering > 0", DROP),
        Rule("has_title", "title IS NOT NULL AND LENGTH(title) >= 1"),
        Rule("valid_is_original", "is_original_title IN (true, false)"),
    ), "Localized titles, typed and checked"),
    CleanSpec("silver_title_principals", "bronze_title_principals", ("tconst", "ordering"), (
        Rule("valid_tconst", not_null_prefix("tconst", "tt"), DROP),
        Rule("valid_nconst", not_null_prefix("nconst", "nm"), DROP),
        Rule("valid_ordering", "ordering IS NOT NULL AND ordering > 0", DROP),
        Rule("valid_category", "category IS NOT NULL AND category RLIKE '^[a-z_]+$'"),
    ), "Title credits, typed and checked"),
    CleanSpec("silver_title_crew", "bronze_title_crew", ("tconst",), (
        Rule("valid_tconst", not_null_prefix("tconst", "tt"), DROP),
    ), "Directors and writers, typed and checked"),
]

# Star-schema primary keys (duplicate checks) and the modelled foreign keys.
GOLD_KEYS = {
    "gold_dim_title": ["tconst"],
    "gold_dim_genre": ["genre_key"],
    "gold_dim_category": ["category_key"],
    "gold_dim_job": ["job_key"],
    "gold_dim_region": ["region_key"],
    "gold_dim_language": ["language_key"],
    "gold_dim_title_alternates": ["alternate_key"],
    "gold_fact_ratings": ["tconst"],
}

FOREIGN_KEYS = [
    ForeignKey("gold_bridge_title_genre", "tconst", "gold_dim_title", "tconst", audited=False),
    ForeignKey("gold_bridge_title_genre", "genre_key", "gold_dim_genre", "genre_key"),
    ForeignKey("gold_dim_title_alternates", "tconst", "gold_dim_title", "tconst", audited=False),
    ForeignKey("gold_dim_title_alternates", "region_key", "gold_dim_region", "region_key", skip_null=True),
    ForeignKey("gold_dim_title_alternates", "language_key", "gold_dim_language", "language_key",
               skip_null=True),
    ForeignKey("gold_fact_ratings", "tconst", "gold_dim_title", "tconst"),
    ForeignKey("gold_fact_episodes", "episode_tconst", "gold_dim_title", "tconst"),
    ForeignKey("gold_fact_episodes", "series_tconst", "gold_dim_title", "tconst"),
    ForeignKey("gold_fact_title_credits", "tconst", "gold_dim_title", "tconst"),
    ForeignKey("gold_fact_title_credits", "nconst", "gold_dim_person", "nconst",
               tolerance_pct=MAX_PERSON_ORPHAN_PCT),
    ForeignKey("gold_fact_title_credits", "category_key", "gold_dim_category", "category_key"),
    ForeignKey("gold_fact_title_credits", "job_key", "gold_dim_job", "job_key", audited=False),
]


def raw_spec(name: str) -> RawSpec:
    return next(s for s in RAW_SPECS if s.name == name)


def clean_spec(name: str) -> CleanSpec:
    return next(s for s in CLEAN_SPECS if s.name == name)
