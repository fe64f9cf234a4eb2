"""Raw tables of the film/TV model: BR-1..7 = one generic ingest per ``RawSpec``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.operators.expectations import expect
from lakeward.sources.tsv import ingest_stream, list_files, read_tsv_evolving
from lakeward.specs import RAW_SPECS, RawSpec, TableLayout

RAW_GLOB = "*.tsv*"


def bronze_batch(spark: SparkSession, layout: TableLayout, spec: RawSpec,
                 observation=None) -> DataFrame | None:
    """BR-1..7 batch form: every file of the spec's folder, header-aware, warn rules
    (EX-01..08) counted."""
    files = list_files(spark, f"{layout.path('raw', spec.folder)}", RAW_GLOB)
    df = read_tsv_evolving(spark, files, spec.multiline, spec.columns)
    if df is None:
        return None
    return expect(df, spec.rules, observation)


def start_bronze(spark: SparkSession, layout: TableLayout, spec: RawSpec,
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 glob: str = RAW_GLOB, clock=None):
    """BR-1..7 incremental form (SRC-01, SNK-01): only files not yet ingested."""
    return ingest_stream(spark, layout.path("raw", spec.folder), layout.path("bronze", spec.name),
                         layout.checkpoint(spec.name), spec.multiline, spec.columns, spec.rules,
                         glob, max_files_per_trigger, available_now, dataset=spec.name,
                         metrics_path=layout.path("qa", "expectation_log"), clock=clock)


__all__ = ["bronze_batch", "start_bronze", "RAW_SPECS"]
