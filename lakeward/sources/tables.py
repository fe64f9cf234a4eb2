"""Reads of upstream tables and lookups (SRC-07..10) and table sinks (SNK-01..05)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Folder of a table with its schema: one JSON file for each time that columns were added.
SCHEMA = "_schema"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """SRC-05: the schema kept with the table (without partition columns), None if there is none.
    Columns are only ever added, so the widest one kept is the latest."""
    try:
        kept = spark.read.text(f"{path}/{SCHEMA}").collect()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    schemas = [T.StructType.fromJson(json.loads(r[0])) for r in kept]
    return max(schemas, key=len) if schemas else None


def keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """SRC-05: evolve the table's schema by the columns of a batch that is about to be written,
    and return it. New columns go to the end; a column that arrives with another type is an
    error. Kept before the batch's rows, so that no stored row has an unknown column; a batch
    that fails afterwards leaves a column that reads as NULL."""
    known = stored_schema(spark, path) or T.StructType()
    types = {f.name: f.dataType for f in known}
    for f in schema:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"{path}: column {f.name} is stored as {types[f.name].simpleString()} "
                             f"and arrives as {f.dataType.simpleString()}")
    new = [T.StructField(f.name, f.dataType, True) for f in schema if f.name not in types]
    if not new:
        return known
    merged = T.StructType([*known.fields, *new])
    # A file of its own each time: nothing is replaced, so a reader never meets a missing schema.
    spark.createDataFrame([(merged.json(),)], "value string").coalesce(1).write.mode("append").text(f"{path}/{SCHEMA}")
    return merged


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08/09: full batch read of a stored table, by the schema kept with it (no file footer
    is opened to learn it; a file without a later column reads as NULL there)."""
    schema = stored_schema(spark, path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


#: Columns that only say where a row is stored (partitions of streamed tables).
STORAGE_COLUMNS = ("_part", "_kb", "_batch", "_batch_id")


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-09: full batch read of a table by its catalog name, without the columns that only
    say where a row is stored."""
    return spark.table(name).drop(*STORAGE_COLUMNS)


def stream_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-07: incremental read of an upstream append-only table."""
    if schema is None:
        schema = read_table(spark, path).schema
    from lakeward.sources.tsv import MAX_FILE_AGE
    r = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_lookup_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """SRC-10: a reference CSV with a header; all columns STRING."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.option("header", "true").schema(schema).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """SNK-02: recomputed table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def checked_stream(source: DataFrame, project, rules, path: str, checkpoint: str, dataset: str,
                   metrics_path: str | None = None, available_now: bool = True):
    """SNK-01 + EXP-01..03: per micro-batch, ``project`` the rows, count and apply ``rules``,
    and overwrite the batch's partition of the table and of the rule log (so a replay changes
    neither). Every batch's counts are kept on the returned query as
    ``expectation_metrics``."""
    from lakeward.sources.tsv import write_checked_batch
    metrics: list[dict] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        metrics.extend(write_checked_batch(project(batch), rules, batch_id, path, dataset,
                                           metrics_path))

    w = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    q.expectation_metrics = metrics
    return q


#: Buckets of a one-row-per-key table, and the most keys of a batch that are sent to all tasks.
KEY_BUCKETS = 16
FILTER_MAX_ROWS = 500_000
FILTER_MAX_BYTES = 64 << 20


def stored_keys(spark: SparkSession, path: str, key: str, buckets: Sequence[int],
                before: int) -> DataFrame | None:
    """Keys that earlier micro-batches stored at ``path`` in ``buckets`` (other buckets' folders
    are not opened, other columns not read); None if there is no table yet."""
    try:
        stored = read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if "_kb" not in stored.columns:
        # The schema is kept before the first rows, so the folder may be without them.
        if "_batch_id" in stored.columns:
            raise ValueError(f"{path}: rows are not stored by key bucket; rebuild the table")
        return None
    stored = stored.filter(F.col("_kb").isin(list(buckets)) & (F.col("_batch_id") < before))
    return stored.select(F.col("_kb").alias("_known_kb"), F.col(key).alias("_known"))


def new_keys(rows: DataFrame, stored: DataFrame, key: str, n_rows: int, key_bytes: int) -> DataFrame:
    """Rows of a batch (with ``_kb``) whose key is not stored. If the batch's keys are few by
    count and bytes, they filter the stored keys where these are read, so stored keys are not
    shuffled and only those met again reach the anti-join; else both sides are shuffled by key."""
    if n_rows <= FILTER_MAX_ROWS and key_bytes <= FILTER_MAX_BYTES:
        asked = F.broadcast(rows.select(F.col("_kb").alias("_asked_kb"), F.col(key).alias("_asked")))
        stored = stored.join(asked, (F.col("_known_kb") == F.col("_asked_kb"))
                             & F.col("_known").eqNullSafe(F.col("_asked")), "left_semi")
    return rows.join(stored, (rows["_kb"] == stored["_known_kb"])
                     & rows[key].eqNullSafe(stored["_known"]), "left_anti")


def new_keys_stream(source: DataFrame, build, key: str, path: str, checkpoint: str,
                    available_now: bool = True, buckets: int = KEY_BUCKETS):
    """STR-03 / AGG-09 without state per row: a dimension with one row per ``key``, kept up to
    date from a stream as a store of key buckets (``_kb=<bucket>/_batch_id=<batch>``).

    Per micro-batch ``build`` reduces the rows to one per key (a distinct that starts inside the
    tasks, so a key held by most rows sends one row per task). Only the buckets that the batch's
    keys fall into are read, and of them only the keys; keys already there are dropped
    (``new_keys``), and the rest is written by as many tasks as it has buckets, each overwriting
    the batch's own partition of its bucket (a replay gives the same rows). A batch without new
    keys writes nothing. ``buckets`` is fixed when a table is first written: a bucket's new keys
    of one batch are one task's work, so take about (keys expected) / 1 M of them. NULL is a key
    like any other. Each batch's numbers are kept on the returned query as ``key_batches``:
    (batch, keys, buckets touched, bytes of keys)."""
    told: list[tuple] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = build(batch)
        keep_schema(spark, path, rows.schema)
        text = F.col(key).cast("string")
        rows = rows.withColumn("_kb", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")).persist()
        try:
            # At most ``buckets`` rows reach the driver.
            touched = rows.groupBy("_kb").agg(F.count(F.lit(1)).alias("n"),
                                              F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16)
                                              .alias("b")).collect()
            n, size = sum(r["n"] for r in touched), sum(r["b"] for r in touched)
            told.append((batch_id, n, len(touched), size))
            if not touched:
                return
            stored = stored_keys(spark, path, key, [r["_kb"] for r in touched], batch_id)
            new = rows if stored is None else new_keys(rows, stored, key, n, size)
            (new.withColumn("_batch_id", F.lit(batch_id).cast("long")).hint("rebalance", "_kb")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_kb", "_batch_id").parquet(path))
        finally:
            rows.unpersist()

    w = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    q.key_batches = told
    return q


def append_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                  query_name: str | None = None):
    """SNK-01: append-only streaming table (parquet sink, exactly-once via checkpoint)."""
    keep_schema(df.sparkSession, path, df.schema)
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(path)


def register_table(spark: SparkSession, name: str, path: str, comment: str = "",
                   properties: dict | None = None) -> None:
    """SNK-05: expose a stored table in the catalog with its comment and layer label."""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # The schema kept with the table, so that columns added by later batches are there by name.
    kept, whole = stored_schema(spark, path), read_table(spark, path).schema
    parts = [f for f in whole if kept is not None and f.name not in kept.names]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole) if kept else ""
    sql = f"CREATE TABLE {name}" + (f" ({columns})" if columns else "") + " USING parquet"
    if parts:
        sql += " PARTITIONED BY (" + ", ".join(f"`{f.name}`" for f in parts) + ")"
    sql += f" LOCATION '{path}'"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "''") + "'"
    if props:
        sql += f" TBLPROPERTIES ({props})"
    spark.sql(sql)
    # The catalog knows no partition of a table that is already there until they are recovered.
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
