"""Ordered run of the layered film/TV model (STR-01..06).

raw files -> bronze (incremental, header-aware) -> silver (typed, rules) -> gold streaming
tables and the type-2 person dimension -> gold batch dimensions (region, language). Each
streaming table is its own query with its own checkpoint under the layout, run with
``availableNow`` in dependency order, so a second run only processes what is new.
Rule counts of the bronze and silver tables come from each micro-batch's own observation and
are stored in the rule log (``qa/expectation_log``), one partition per dataset and batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeward.functions.cleanse import at_clock
from lakeward.plans import star as G
from lakeward.plans.raw_tables import start_bronze
from lakeward.plans.cleansed import PROJECTIONS
from lakeward.session import in_threads
from lakeward.sources.tables import (STORAGE_COLUMNS, append_stream, checked_stream, new_keys_stream, read_catalog_table,
                                     read_lookup_csv, read_table, stream_table, write_table)
from lakeward.sources.tsv import MALFORMED, folders_with_files
from lakeward.specs import CLEAN_SPECS, RAW_SPECS, TableLayout
from lakeward.streaming.scd2_stream import apply_changes_stream


# Bounded micro-batches: a first run over a large backlog proceeds in batches of at most
# this many files, so a failure redoes one batch, not the whole history.
RAW_FILES_PER_TRIGGER = 1000
TABLE_FILES_PER_TRIGGER = 10000


def _rule_totals(q) -> dict:
    """``rows``, ``dropped`` and ``failed_<rule>`` over all micro-batches of a checked query."""
    out: dict = {}
    for b in {m["batch_id"] for m in q.expectation_metrics}:
        own = [m for m in q.expectation_metrics if m["batch_id"] == b]
        for k, v in (("rows", own[0]["rows"]), ("dropped", own[0]["dropped"]),
                     *((f"failed_{m['rule']}", m["failed"]) for m in own)):
            out[k] = out.get(k, 0) + v
    return out


def _await_all(queries: dict) -> None:
    """Wait for every query; re-raise the first failure after all have stopped."""
    errors = []
    for q in queries.values():
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 - collect, then raise
            errors.append(e)
    if errors:
        raise errors[0]


def run_layers(spark: SparkSession, layout: TableLayout, countries_csv: str, languages_csv: str,
               key_buckets: int = 64, raw_glob: str = "*.tsv*", clock=None) -> dict:
    """Run every layer once (availableNow). Returns observed rule metrics per query.
    ``clock`` dates the run: every load stamp of every layer (``cleanse.at_clock``).

    A table depends on one raw file set only, so each set goes through its layers in order and
    the sets run concurrently (one session, several streaming queries): no table waits for
    another's layer. If some fail, the others go on to their end, then the first failure is raised.
    """
    metrics: dict = {}

    def dated(build):
        return lambda *frames: at_clock(build(*frames), clock)

    # One listing job tells which raw file sets exist (not one probe per set).
    raw = folders_with_files(spark, layout.path("raw", ""), raw_glob)

    def stored(layer: str, name: str) -> bool:
        return bool(folders_with_files(spark, layout.path(layer, name), "*.parquet"))

    def rows_of(layer: str, name: str):
        return stream_table(spark, layout.path(layer, name), max_files_per_trigger=TABLE_FILES_PER_TRIGGER)

    def bronze(spec) -> None:
        """SRC-01..06, EX-01..08."""
        if spec.folder in raw:
            q = start_bronze(spark, layout, spec, max_files_per_trigger=RAW_FILES_PER_TRIGGER,
                             glob=raw_glob, clock=clock)
            _await_all({spec.name: q})
            metrics[f"{spec.name}_rules"] = _rule_totals(q)

    def silver(spec) -> None:
        """SV-1..7, EXP-01..03, one stream per table."""
        if stored("bronze", spec.source):
            q = checked_stream(rows_of("bronze", spec.source), dated(PROJECTIONS[spec.name]), spec.rules,
                               layout.path("silver", spec.name), layout.checkpoint(spec.name), spec.name,
                               layout.path("qa", "expectation_log"))
            _await_all({spec.name: q})
            metrics[f"{spec.name}_rules"] = _rule_totals(q)

    def gold(silver_name: str) -> None:
        """Gold streaming tables of one cleansed table (GD-03..06, GD-09..13, STR-03/04), the
        type-2 person dimension from the change feed (GD-01/02, SCD-02, STR-06), and batch
        dimensions after the table's stream drained (GD-07/08, STR-05)."""
        if not stored("silver", silver_name):
            return
        queries = {}
        for name, (source, build) in G.STREAMING_GOLD.items():
            if source != silver_name:
                continue
            if name in G.ONE_ROW_PER_KEY:
                queries[name] = new_keys_stream(rows_of("silver", source), dated(build), G.ONE_ROW_PER_KEY[name],
                                                layout.path("gold", name), layout.checkpoint(name))
            else:
                queries[name] = append_stream(dated(build)(rows_of("silver", source)), layout.path("gold", name),
                                              layout.checkpoint(name))
        if silver_name == "silver_name_basics":
            queries["gold_dim_person"] = apply_changes_stream(
                dated(G.person_changes)(rows_of("silver", silver_name)), layout.path("gold", "gold_dim_person"),
                layout.path("gold", "_changes_gold_dim_person"), layout.checkpoint("gold_dim_person"),
                ["nconst"], G.STAMP, G.PERSON_TRACKED, key_buckets)
        _await_all(queries)
        if "gold_dim_person" in queries:
            metrics["gold_dim_person_paths"] = list(getattr(queries["gold_dim_person"], "scd2_paths", []))
        if silver_name == "silver_title_akas":
            a = read_table(spark, layout.path("silver", silver_name))
            write_table(dated(G.dim_region)(a, read_lookup_csv(spark, countries_csv,
                                                               ["region_code", "region_name"])),
                        layout.path("gold", "gold_dim_region"))
            write_table(dated(G.dim_language)(a, read_lookup_csv(spark, languages_csv,
                                                                 ["language_code", "language_name"])),
                        layout.path("gold", "gold_dim_language"))

    def chain(spec) -> None:
        bronze(spec)
        for clean in (c for c in CLEAN_SPECS if c.source == spec.name):
            silver(clean)
            gold(clean.name)

    in_threads(spark, [lambda spec=spec: chain(spec) for spec in RAW_SPECS])
    return metrics


def run_audits(spark: SparkSession, layout: TableLayout, clock=None, run_id: str | None = None,
               database: str | None = None) -> dict:
    """QL-1..6: recompute the load-audit and data-quality tables over the raw (bronze)
    tables and append a row-count snapshot to the history; returns the three paths.
    ``clock`` dates the checks; a repeated ``run_id`` replaces its own snapshot; with
    ``database`` the raw tables are read by name."""
    from lakeward.operators.audit import AuditTarget, data_quality, load_audit, record_row_counts
    from lakeward.sources.tables import write_table as _write
    stored = load_tables(spark, layout, [s.name for s in RAW_SPECS], database)
    tables = [(stored[s.name].drop("_batch_id", MALFORMED), AuditTarget(s.name, s.keys, s.columns))
              for s in RAW_SPECS if s.name in stored]
    out = {n: layout.path("qa", n) for n in ("qa_load_audit", "qa_row_count_history",
                                            "qa_data_quality")}
    if tables:
        _write(load_audit(tables), out["qa_load_audit"])
        at = None if clock is None else F.lit(clock).cast("timestamp")
        _write(data_quality(tables, at), out["qa_data_quality"])
        record_row_counts(tables, out["qa_row_count_history"], at, run_id)
    return out


def load_tables(spark: SparkSession, layout: TableLayout, only=None, database: str | None = None) -> dict:
    """Every stored table of the layout (or those named in ``only``) as a batch DataFrame
    (name -> DataFrame). With ``database`` the tables registered there are read by name
    (SRC-09); the layout is not looked at then."""
    out = {}
    named = {t.name for t in spark.catalog.listTables(database)} if database else set()
    for layer, names in (("bronze", [s.name for s in RAW_SPECS]),
                         ("silver", [s.name for s in CLEAN_SPECS]),
                         ("gold", list(G.STREAMING_GOLD) + ["gold_dim_person", "gold_dim_region",
                                                             "gold_dim_language"])):
        names = [n for n in names if only is None or n in only]
        if database:
            have = named
        else:
            have = folders_with_files(spark, layout.path(layer, ""), "*.parquet") if names else ()
        for n in names:
            if n in have:
                df = (read_catalog_table(spark, f"{database}.{n}") if database
                      else read_table(spark, layout.path(layer, n)))
                out[n] = df.drop(*STORAGE_COLUMNS) if layer != "bronze" else df
    return out


def register_layout(spark: SparkSession, layout: TableLayout, database: str | None = None) -> list:
    """SNK-05: expose every stored table of the layout in the catalog with its comment and
    its layer as the ``quality`` property; ``database`` prefixes the names (created if
    missing). Returns the registered names."""
    from lakeward.sources.tables import register_table
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    comments = {s.name: s.comment for s in RAW_SPECS}
    comments.update({s.name: s.comment for s in CLEAN_SPECS})
    comments.update(G.COMMENTS)
    out = []
    for layer, names in (("bronze", [s.name for s in RAW_SPECS]),
                         ("silver", [s.name for s in CLEAN_SPECS]),
                         ("gold", list(G.COMMENTS))):
        have = folders_with_files(spark, layout.path(layer, ""), "*.parquet")
        for n in names:
            p = layout.path(layer, n)
            if n in have:
                full = f"{database}.{n}" if database else n
                register_table(spark, full, p, comments.get(n, ""), {"quality": layer})
                out.append(full)
    return out
