"""Incremental type-2 dimension from a stream without a MERGE-capable table format (SCD-02).

The dimension is two tables read as one: *open* versions, one row per key, under
``_part=open/_kb=<key bucket>``, and *closed* versions under
``_part=closed/_kb=<key bucket>/_batch=<batch that closed them>``. A closed version is
never touched again by batches that arrive in order, so what a batch writes is bounded by
the open versions of the buckets it touches plus the versions it closes, whatever the
length of the history.

Each micro-batch:

1. appends its rows to a change log partitioned by ``(_kb, _batch)``; the batch's own
   partitions are *overwritten*, so a replayed batch id rewrites the same files. The
   touched buckets are observed on that write (at most ``key_buckets`` values reach the
   driver) and only their folders are read from here on;
2. compares each key's smallest new sequence with its open version (whose sequence is the
   key's latest applied one). A bucket is *late* if some key has a new row that is not newer;
3. in the other buckets, runs the open versions of the batch's keys and the new rows
   through ``scd2_history``; the result and the buckets' untouched open versions are
   written by one dynamic overwrite: open partitions of the touched buckets, closed
   partitions of this batch;
4. rebuilds late buckets (and buckets with logged rows but no open version) from their whole
   change log: their closed folders are removed and written anew under this batch.

Recovery: Spark delivers a failed batch again before any later one. A bucket whose open
versions were already replaced shows all of the batch's keys as late and is rebuilt, which
also repairs its closed versions; any other bucket repeats the step it had before, over
the same partitions. So the tables themselves tell how far a batch came, and no separate
record of applied batches is kept. Limit: the partition swap is not atomic across buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.scd2 import END, START, scd2_history
from lakeward.operators.segmented import _null_safe_join
from lakeward.sources.tables import keep_schema, read_table

KEY_BUCKET = "_kb"
BATCH = "_batch"
PART = "_part"
OPEN, CLOSED = "open", "closed"
#: Partition columns of the stored dimension; none of them is data.
STORED = (PART, KEY_BUCKET, BATCH)
# Open versions are overwritten in place, so their partitions carry one fixed batch.
OPEN_BATCH = -1


def key_bucket(keys: Sequence[str], n: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the table (nothing happens if there is none)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scd2Writer:
    """``foreachBatch`` body maintaining a type-2 table at ``target``."""

    def __init__(self, target: str, change_log: str, keys: Sequence[str], seq: str,
                 tracked: Sequence[str], key_buckets: int = 64, bucket_width: int | None = None,
                 incremental: bool = True):
        self.target, self.change_log = target, change_log
        self.keys, self.seq, self.tracked = list(keys), seq, list(tracked)
        self.key_buckets, self.bucket_width = key_buckets, bucket_width
        self.incremental = incremental
        self.last_path = ""   # "full", "mixed" or "in_order" (observability / tests)
        self.paths: list = []  # (batch_id, path) per applied micro-batch
        self.written: list = []  # {"open": rows, "closed": rows} per applied micro-batch

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = self.append_log(batch, batch_id)
        if not touched:
            return
        late = self.late_buckets(spark, touched, batch_id) if self.incremental else touched
        on_time = [k for k in touched if k not in late]
        parts = []
        if on_time:
            parts.append(self.advance(spark, on_time, batch_id))
        if late:
            parts.append(self.rebuilt(spark, late))
            for k in late:
                _remove(spark, f"{self.target}/{PART}={CLOSED}/{KEY_BUCKET}={k}")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        self.written.append(self._write_target(out, batch_id))
        self.last_path = "mixed" if on_time and late else "full" if late else "in_order"
        self.paths.append((int(batch_id), self.last_path))

    # Both writes are dealt by bucket first (``rebalance``: small buckets share a task, a large
    # one is split), so that a bucket is a few files, not one from every task.

    def append_log(self, batch: DataFrame, batch_id: int) -> list:
        """Step 1: (over)write this batch's log partitions; return the touched buckets,
        observed on that same write. A row without a sequence is never applied."""
        obs = Observation(f"scd2_touched_{batch_id}")
        (batch.withColumn(KEY_BUCKET, key_bucket(self.keys, self.key_buckets))
         .observe(obs, F.collect_set(F.when(F.col(self.seq).isNotNull(), F.col(KEY_BUCKET))).alias("kb"))
         .withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", KEY_BUCKET)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(KEY_BUCKET, BATCH).parquet(self.change_log))
        return sorted(obs.get.get("kb") or [])

    def _log(self, spark: SparkSession, buckets: list, batch_id: int | None = None) -> DataFrame:
        """Rows of the buckets' change log (of one batch), read by folder: no other bucket or
        batch is listed."""
        own = "" if batch_id is None else f"/{BATCH}={int(batch_id)}"
        paths = [f"{self.change_log}/{KEY_BUCKET}={k}{own}" for k in buckets]
        rows = spark.read.option("basePath", self.change_log).parquet(*paths)
        return rows.filter(F.col(self.seq).isNotNull()).drop(BATCH)

    def _open(self, spark: SparkSession, buckets: list) -> DataFrame | None:
        """Open versions of the buckets; None if nothing is stored yet."""
        root = f"{self.target}/{PART}={OPEN}"
        try:
            stored = spark.read.parquet(root)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        return stored.filter(F.col(KEY_BUCKET).isin(buckets)).drop(BATCH)

    def late_buckets(self, spark: SparkSession, touched: list, batch_id: int) -> list:
        """Step 2: touched buckets in which a key's open version is as new as one of its new
        rows, or whose earlier rows are logged but not stored."""
        stored = self._open(spark, touched)
        if stored is None:
            return touched
        new = self._log(spark, touched, batch_id).groupBy(*self.keys).agg(F.min(self.seq).alias("_new"))
        met = _null_safe_join(stored.select(*self.keys, F.col(self.seq).alias("_old"), KEY_BUCKET),
                              new, self.keys, "left")
        late = F.coalesce(F.max(F.col("_new") <= F.col("_old")), F.lit(False))
        told = {r[KEY_BUCKET]: r["late"] for r in met.groupBy(KEY_BUCKET).agg(late.alias("late")).collect()}
        unseen = [k for k in touched if k not in told]
        if unseen:   # new buckets, unless earlier batches logged rows for them
            paths = [f"{self.change_log}/{KEY_BUCKET}={k}" for k in unseen]
            log = spark.read.option("basePath", self.change_log).parquet(*paths)
            earlier = log.filter(F.col(BATCH) < batch_id).select(KEY_BUCKET).distinct().collect()
            told |= dict.fromkeys(unseen, False) | {r[KEY_BUCKET]: True for r in earlier}
        return [k for k in touched if told[k]]

    def advance(self, spark: SparkSession, buckets: list, batch_id: int) -> DataFrame:
        """Step 3: open versions of the batch's keys + new rows -> their new versions, with the
        buckets' other open versions as they are."""
        new = self._log(spark, buckets, batch_id).drop(KEY_BUCKET)
        stored = self._open(spark, buckets).drop(KEY_BUCKET)
        cols = new.columns

        def semi(df, keys, how):
            return df.join(keys, [df[k].eqNullSafe(keys[k]) for k in self.keys], how)

        keys = new.select(*self.keys).distinct()
        mine, others = semi(stored, keys, "left_semi"), semi(stored, keys, "left_anti")
        seeds = mine.select(*self.keys, F.col(self.seq).alias("_seed_seq"),
                            F.col(START).alias("_seed_start"))
        feed = mine.select(*cols).unionByName(new)
        hist = scd2_history(feed, self.keys, self.seq, self.tracked, self.bucket_width)
        hist = _null_safe_join(hist, seeds, self.keys, "left")
        hist = (hist.withColumn(START, F.when(F.col(START) == F.col("_seed_seq"),
                                              F.col("_seed_start")).otherwise(F.col(START)))
                .drop("_seed_seq", "_seed_start"))
        return hist.unionByName(others.select(*hist.columns))

    def rebuilt(self, spark: SparkSession, buckets: list) -> DataFrame:
        """Step 4: all versions of the buckets, from their whole change log."""
        return scd2_history(self._log(spark, buckets).drop(KEY_BUCKET), self.keys, self.seq,
                            self.tracked, self.bucket_width)

    def _write_target(self, versions: DataFrame, batch_id: int) -> dict:
        """Dynamic overwrite of the open partitions and of this batch's closed ones; returns the
        rows written to each (observed on the write itself)."""
        is_open = F.col(END).isNull()
        keep_schema(versions.sparkSession, self.target, versions.schema)
        obs = Observation(f"scd2_written_{id(versions)}")
        (versions.withColumn(PART, F.when(is_open, F.lit(OPEN)).otherwise(F.lit(CLOSED)))
         .withColumn(KEY_BUCKET, key_bucket(self.keys, self.key_buckets))
         .withColumn(BATCH, F.when(is_open, F.lit(OPEN_BATCH)).otherwise(F.lit(batch_id)).cast("long"))
         .observe(obs, F.count_if(is_open).alias(OPEN), F.count_if(~is_open).alias(CLOSED))
         .hint("rebalance", PART, KEY_BUCKET)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*STORED).parquet(self.target))
        return dict(obs.get)


def apply_changes_stream(source: DataFrame, target: str, change_log: str, checkpoint: str,
                         keys: Sequence[str], seq: str, tracked: Sequence[str],
                         key_buckets: int = 64, bucket_width: int | None = None,
                         available_now: bool = True, incremental: bool = True):
    """SCD-02 / STR-06 / SNK-03: start the stream that keeps ``target`` (the
    change-applied table) as a type-2 dimension."""
    writer = Scd2Writer(target, change_log, keys, seq, tracked, key_buckets, bucket_width,
                        incremental)
    w = source.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    q.scd2_paths = writer.paths      # which path each micro-batch took
    return q


def read_dimension(spark: SparkSession, target: str) -> DataFrame:
    """The maintained dimension, open and closed versions, without its storage columns."""
    return read_table(spark, target).drop(*STORED)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """SCD-04 on the stored dimension: open versions only; closed ones are not even listed."""
    return spark.read.parquet(f"{target}/{PART}={OPEN}").drop(*STORED)
