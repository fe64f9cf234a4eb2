"""Audit tables over raw (bronze) tables: load audit, row-count history, data quality
(QL-1..7, AGG-01/03/04/06, JN-06, SET-01).

Each table is scanned once: the total, the per-column NULL counts and the latest load
stamp are one aggregate; duplicate groups are one ``groupBy`` with map-side partial
counts (a hot key collapses before the shuffle). The two one-row results are put side by
side without a cross join (JN-06), and per-table rows are combined with ``unionByName``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.operators.checks import side_by_side
from lakeward.specs import (AUDIT_STATUS, ISSUE_DUPLICATE_PK, RAW_FILE_SUFFIX, RAW_TABLE_PREFIX,
                            SCORE_CLEAN, SCORE_WITH_DUPLICATES)


# Partition column of the stored row-count history: the run that took the snapshot.
RUN = "_run"


@dataclass(frozen=True)
class AuditTarget:
    """QL-7: one audited table — name, key columns, expected columns, file name."""
    name: str
    keys: tuple
    expected: tuple
    file_name: str | None = None
    stamp: str | None = "_loaded_at"   # load-time column (max = load_timestamp)


def data_columns(df: DataFrame) -> list[str]:
    """Columns not starting with ``_`` (lineage columns are excluded)."""
    return [c for c in df.columns if not c.startswith("_")]


def schema_drift(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """QL-2: data columns that are not expected (schema metadata only, no scan)."""
    return [c for c in data_columns(df) if c not in expected]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def load_audit_row(df: DataFrame, target: AuditTarget) -> DataFrame:
    """QL-1 for one table."""
    stamp = target.stamp
    actual = data_columns(df)
    new = schema_drift(df, target.expected)
    file_name = target.file_name or target.name.replace(RAW_TABLE_PREFIX, "") + RAW_FILE_SUFFIX
    latest = (F.max(stamp) if stamp and stamp in df.columns
              else F.lit(None).cast("timestamp"))
    return df.agg(
        F.lit(target.name).alias("table_name"),
        F.lit(file_name).alias("file_name"),
        F.lit(AUDIT_STATUS).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.count(F.lit(1)).alias("rows_loaded"),
        latest.alias("load_timestamp"),
        F.lit(",".join(actual)).alias("columns_detected"),
        F.lit(",".join(new)).alias("new_columns_added"),
        F.lit(len(new) > 0).alias("schema_drift_detected"))


def load_audit(tables: Sequence[tuple[DataFrame, AuditTarget]]) -> DataFrame:
    """QL-1/QL-2 + SET-01: one audit row per table."""
    return _union([load_audit_row(df, t) for df, t in tables])


def row_count_snapshot(tables: Sequence[tuple[DataFrame, AuditTarget]],
                       recorded_at: Column | None = None) -> DataFrame:
    """QL-3 snapshot rows: (table_name, row_count, recorded_at)."""
    ts = recorded_at if recorded_at is not None else F.current_timestamp()
    return _union([df.agg(F.lit(t.name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                          ts.alias("recorded_at")) for df, t in tables])


def with_deltas(history: DataFrame) -> DataFrame:
    """QL-3: ``delta_from_previous`` = row_count - previous snapshot's (first = 0).
    The window is per table over its snapshots (one row per run, small)."""
    w = Window.partitionBy("table_name").orderBy("recorded_at")
    return history.withColumn(
        "delta_from_previous",
        (F.col("row_count") - F.coalesce(F.lag("row_count").over(w), F.col("row_count")))
        .cast("long"))


def record_row_counts(tables: Sequence[tuple[DataFrame, AuditTarget]], history_path: str,
                      recorded_at: Column | None = None, run_id: str | None = None) -> DataFrame:
    """QL-3 persisted: add this run's snapshot to the history table, return the history with
    ``delta_from_previous`` (first snapshot of a table = 0). A snapshot is the partition of its
    run: a run repeated under its ``run_id`` (after a failure, say) replaces its own."""
    snap = row_count_snapshot(tables, recorded_at).withColumn(RUN, F.lit(run_id or uuid.uuid4().hex))
    (snap.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RUN).parquet(history_path))
    return row_count_history(snap.sparkSession, history_path)


def row_count_history(spark: SparkSession, history_path: str) -> DataFrame:
    """QL-3: the stored snapshots with their deltas."""
    return with_deltas(spark.read.parquet(history_path).drop(RUN))


def null_counts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """AGG-03: one ``count_if(isNull)`` per column (0 on an empty table, P8)."""
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-04: number of key groups with more than one row (NULL is a group, P6)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.count_if(F.col("_n") > 1).alias("duplicate_count")))


def quality_row(df: DataFrame, target: AuditTarget, check_ts: Column | None = None
                ) -> DataFrame:
    """QL-4..6 for one table: totals, ``col:n`` NULL text (FN-10 ``concat_ws``), duplicate
    groups, score, issues."""
    cols = data_columns(df)
    stats = df.agg(F.count(F.lit(1)).alias("total_rows"), *null_counts(df, cols))
    dups = duplicate_groups(df, list(target.keys))
    ts = check_ts if check_ts is not None else F.current_timestamp()
    null_text = F.concat_ws(",", *[F.concat_ws(":", F.lit(c), F.col(f"null_{c}").cast("string"))
                                   for c in cols])
    has_dups = F.col("duplicate_count") > 0
    return side_by_side(stats, dups).select(
        F.lit(target.name).alias("table_name"),
        F.col("total_rows"),
        null_text.alias("null_counts"),
        F.col("duplicate_count"),
        F.lit(",".join(target.keys)).alias("primary_key_columns"),
        ts.alias("check_timestamp"),
        F.when(has_dups, F.lit(SCORE_WITH_DUPLICATES)).otherwise(F.lit(SCORE_CLEAN))
        .alias("quality_score"),
        F.when(has_dups, F.concat_ws("|", F.lit(ISSUE_DUPLICATE_PK),
                                     F.col("duplicate_count").cast("string")))
        .otherwise(F.lit("")).alias("issues_found"))


def data_quality(tables: Sequence[tuple[DataFrame, AuditTarget]],
                 check_ts: Column | None = None) -> DataFrame:
    """QL-4 + SET-01: one quality row per table."""
    return _union([quality_row(df, t, check_ts) for df, t in tables])
