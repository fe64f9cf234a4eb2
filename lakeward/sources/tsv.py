"""Raw delimited-file ingest with lineage and schema evolution (SRC-01..06, SNK-01).

Dialect (SRC-02): header line, tab separator, ``\\N`` is NULL, quoting and escaping off.
Every column is read as STRING (SRC-04). Lineage (SRC-06): ``_source_file`` from the
file-metadata column and ``_loaded_at``.

Splittable multi-line semantics (SRC-03). The header read also detects the line ending,
and each group is read without ``multiLine`` (which would make every file one task) but
with options that give the same records (``group_options``).

Schema evolution (SRC-05). With an explicit schema Spark maps CSV columns *by position*
and silently mis-assigns a file whose header is reordered (P5). So files are grouped by
their header line, each group is read with its own all-STRING schema, and the groups are
combined with ``unionByName(allowMissingColumns=True)``: a column that appears later is
added (NULL in older rows) and reordered files map by name.

Incremental ingest (SRC-01). New files are discovered by a ``binaryFile`` stream that
selects only ``path`` (the file content is never read by it); its checkpoint remembers
which files were ingested. Each micro-batch reads its files as above and overwrites the
``_batch_id`` partition it owns, so a replayed batch rewrites the same rows
(exactly-once with the checkpoint).
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.cleanse import at_clock
from lakeward.specs import Rule

# FIXED VALUES — the raw file dialect.
TSV_OPTIONS = {
    "header": "true",
    "sep": "\t",
    "nullValue": "\\N",
    "quote": "",
    "escape": "",
}

# Schema of Spark's binaryFile source (a streaming source needs it up front).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

SOURCE_FILE = "_source_file"
LOADED_AT = "_loaded_at"
# The whole line of a record whose number of fields is not the header's, else NULL.
MALFORMED = "_malformed_record"

# File streams ignore files this much older than the newest one seen (7 days by default,
# which loses files copied with their time stamps); every file is to be taken, whatever
# its age. The checkpoint remembers what was taken.
MAX_FILE_AGE = "36500d"


def tsv_options(multiline: bool = False, **extra) -> dict:
    """SRC-02/03: the dialect plus the per-dataset multi-line switch."""
    opts = dict(TSV_OPTIONS)
    opts["multiLine"] = "true" if multiline else "false"
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def string_schema(columns: Sequence[str]) -> T.StructType:
    """SRC-04: every column STRING."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def with_lineage(df: DataFrame) -> DataFrame:
    """SRC-06: source file path and load time."""
    return (df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
            .withColumn(LOADED_AT, F.current_timestamp()))


def read_tsv(spark: SparkSession, paths, columns: Sequence[str], multiline: bool = False
             ) -> DataFrame:
    """Batch read with a fixed header (positional mapping; use ``read_tsv_evolving`` when
    files may differ in header)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return with_lineage(spark.read.options(**tsv_options(multiline))
                        .schema(string_schema(columns)).csv(paths))


def stream_tsv(spark: SparkSession, path: str, columns: Sequence[str], multiline: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-01 with a fixed header: a streaming CSV source over a directory."""
    r = (spark.readStream.options(**tsv_options(multiline)).schema(string_schema(columns))
         .option("maxFileAge", MAX_FILE_AGE))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_lineage(r.csv(path))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> list[str]:
    """File paths under ``path`` (recursive). Only the listing reaches the driver."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return sorted(row.path for row in r.load(path).select("path").collect())


def folders_with_files(spark: SparkSession, root: str, glob: str | None = None) -> set:
    """Names of the first-level folders under ``root`` that hold at least one (matching)
    file — one listing job; only the distinct folder names reach the driver."""
    key = _path_part(root).rstrip("/") + "/"
    key = key.replace("'", "''")
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    try:
        rel = r.load(root).select(
            F.expr(f"substring(path, instr(path, '{key}') + {len(key)})").alias("rel"))
        return {row[0] for row in rel.select(F.split("rel", "/").getItem(0).alias("f"))
                .filter(F.col("f") != "").distinct().collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":    # only a missing root has no folders
            raise
        return set()


def group_options(multiline: bool, crlf: bool) -> dict:
    """Read options for one header group, always splittable.

    With quoting off a record cannot span lines; the only effect of ``multiLine`` is that
    a lone ``\\r`` inside a field does not end the record (P7). For ``\\n``-terminated
    files ``lineSep="\\n"`` gives exactly that while keeping files splittable; for
    ``\\r\\n`` files the default line handling already equals ``multiLine``.
    """
    if multiline and not crlf:
        return tsv_options(False, lineSep="\n")
    return tsv_options(False)


def _path_part(path: str) -> str:
    """A path without scheme and authority, which different readers spell differently."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def header_groups(spark: SparkSession, files: Sequence[str], multiline: bool = False
                  ) -> "OrderedDict[tuple, list[str]]":
    """Files grouped by ``(columns, crlf)``: their first line split on the tab (quoting is off)
    and whether lines end with ``\\r\\n``. One job for all files: the first line of each is the
    least row of its first split (a partial aggregate, so a file sends one line); the lines of
    as many files as a micro-batch may take reach the driver."""
    files = list(files)
    lines = spark.read.option("lineSep", "\n").text(files).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("row"))
    first = lines.where("at = 0").groupBy("path").agg(F.min_by("value", "row").alias("line"))
    told = {_path_part(unquote(r["path"])): r["line"] for r in first.collect()}
    groups: OrderedDict[tuple, list[str]] = OrderedDict()
    for f in files:
        line = told.get(_path_part(f), "")     # empty file: nothing to read
        crlf = line.endswith("\r")
        header = tuple((line[:-1] if crlf else line).split("\t"))
        if header != ("",):
            groups.setdefault((header, crlf), []).append(f)
    return groups


def _schema_and_options(header: Sequence[str], opts: dict, malformed: bool) -> tuple:
    """All-STRING schema and options of a group; ``malformed`` adds the column that keeps a
    record with more or fewer fields than the header."""
    if not malformed:
        return string_schema(header), opts
    return (string_schema([*header, MALFORMED]),
            dict(opts, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED))


def read_tsv_evolving(spark: SparkSession, files: Sequence[str], multiline: bool = False,
                      expected: Sequence[str] | None = None, groups=None,
                      malformed: bool = False) -> DataFrame | None:
    """SRC-05: read files grouped by header and union them by column name.

    ``expected`` columns come first (in that order, NULL if no file has them); columns
    only some files carry follow in order of first appearance. ``malformed`` keeps the line
    of each record that has more or fewer fields than its header (``MALFORMED``).
    """
    files = list(files)
    if not files:
        return None
    if groups is None:
        groups = header_groups(spark, files, multiline)
    if not groups:
        return None
    parts = []
    for (header, crlf), group in groups.items():
        schema, opts = _schema_and_options(header, group_options(multiline, crlf), malformed)
        parts.append(with_lineage(spark.read.options(**opts).schema(schema).csv(group)))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _ordered(df, expected)


def _ordered(df: DataFrame, expected: Sequence[str] | None) -> DataFrame:
    """Expected columns first (NULL when absent), then extra columns, then lineage."""
    order = list(expected or [])
    last = [c for c in (MALFORMED, SOURCE_FILE, LOADED_AT) if c in df.columns]
    for c in df.columns:
        if c not in order and c not in last:
            order.append(c)
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in order]
    return df.select(*cols, *last)


# Messages of Spark's CSV header check (names differ / column count differs).
HEADER_MISMATCH = ("CSV header does not conform to the schema",
                   "in CSV header is not equal to number of fields in the schema")


def read_tsv_uniform(spark: SparkSession, files: Sequence[str], header: Sequence[str],
                     multiline: bool = False, expected: Sequence[str] | None = None,
                     crlf: bool = False, malformed: bool = False) -> DataFrame:
    """Read files that are expected to share ``header`` in one scan; Spark validates every
    file's header line against it while reading (``enforceSchema=false``), so a file with
    another header — or CRLF endings under the LF multi-line options — fails the job with
    ``HEADER_MISMATCH`` instead of being mis-assigned by position."""
    schema, opts = _schema_and_options(header, dict(group_options(multiline, crlf),
                                                    enforceSchema="false"), malformed)
    df = with_lineage(spark.read.options(**opts).schema(schema).csv(list(files)))
    return _ordered(df, expected)


class _EvolvingBatchWriter:
    """foreachBatch body: read this batch's files (one validated scan when all carry the
    known header, else grouped by header), count rules, overwrite the batch's partition;
    rule counts go to ``self.metrics`` and an optional log table."""

    def __init__(self, target: str, multiline: bool, expected, rules, dataset: str,
                 metrics_path: str | None, clock=None):
        self.clock = clock
        self.target, self.multiline, self.expected = target, multiline, expected
        self.rules, self.dataset, self.metrics_path = rules, dataset, metrics_path
        self.metrics: list[dict] = []
        self.known_header: tuple = ()
        self.known_crlf = False
        self.try_uniform = True   # off for this run once a batch mixes headers

    def __call__(self, files_df: DataFrame, batch_id: int) -> None:
        spark = files_df.sparkSession
        files = sorted(r.path for r in files_df.select("path").distinct().collect())
        if not files:
            return
        header = self.known_header or tuple(self.expected)
        if header and self.try_uniform:
            # Common case: every new file carries the known header -> one scan, headers
            # validated inside it, no per-file jobs.
            try:
                self._write(read_tsv_uniform(spark, files, header, self.multiline,
                                             self.expected, self.known_crlf, malformed=True),
                            batch_id)
                return
            except Exception as e:  # noqa: BLE001 - only a header mismatch falls back
                if not any(m in str(e) for m in HEADER_MISMATCH):
                    raise
        groups = header_groups(spark, files, self.multiline)
        if len(groups) == 1:                             # one header (and line ending):
            self.known_header, self.known_crlf = next(iter(groups))   # follow it
        elif len(groups) > 1:
            self.try_uniform = False                     # mixed headers: group every batch
        df = read_tsv_evolving(spark, files, self.multiline, self.expected, groups,
                               malformed=True)
        if df is not None:
            self._write(df, batch_id)

    def _write(self, df: DataFrame, batch_id: int) -> None:
        rules = [*self.rules, WELL_FORMED]
        self.metrics.extend(write_checked_batch(at_clock(df, self.clock), rules, batch_id, self.target, self.dataset,
                                                self.metrics_path))


# Built-in warn rule of every ingested file set: as many fields as the header has.
WELL_FORMED = Rule("well_formed_record", f"{MALFORMED} IS NULL")

# The stored counts; ``dataset`` and ``batch_id`` are the log's partition columns.
EXPECTATION_LOG_SCHEMA = T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("failed", T.LongType()), T.StructField("passed", T.LongType())])


def write_checked_batch(df: DataFrame, rules: Sequence[Rule], batch_id: int, target: str,
                        dataset: str, metrics_path: str | None) -> list[dict]:
    """EXP-01..03 on one micro-batch: count the rules on the pass that writes the rows,
    overwrite the batch's own partition of ``target`` and of the rule log (a replayed batch
    replaces both), and return the counts (one dict per rule, with ``rows`` and
    ``dropped``). Each dataset has its own log folder, so concurrent streams never share a
    write path; reading the log's root gives ``dataset`` and ``batch_id`` as columns."""
    from pyspark.sql import Observation

    from lakeward.operators.expectations import expect, observed_counts
    from lakeward.sources.tables import keep_schema
    spark = df.sparkSession
    keep_schema(spark, target, df.schema)
    obs = Observation(f"{dataset}_{batch_id}") if rules else None
    if obs is not None:
        df = expect(df, rules, obs)
    (df.withColumn("_batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_batch_id").parquet(target))
    if obs is None:
        return []
    counts = observed_counts(obs, rules)
    if metrics_path:
        names = EXPECTATION_LOG_SCHEMA.names
        (spark.createDataFrame([tuple(c[n] for n in names) for c in counts], EXPECTATION_LOG_SCHEMA)
         .coalesce(1).write.mode("overwrite")
         .parquet(f"{metrics_path}/dataset={dataset}/batch_id={int(batch_id)}"))
    total = obs.get
    return [dict(c, dataset=dataset, batch_id=int(batch_id), rows=int(total.get("rows", 0)),
                 dropped=int(total.get("dropped", 0))) for c in counts]


def ingest_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                  multiline: bool = False, expected: Sequence[str] | None = None,
                  rules=(), glob: str | None = None, max_files_per_trigger: int | None = 1000,
                  available_now: bool = True, dataset: str | None = None,
                  metrics_path: str | None = None, clock=None):
    """SRC-01 + SRC-05 + SNK-01: incremental, header-aware ingest into an append-only
    parquet table. Returns the started ``StreamingQuery``.

    Micro-batches take at most ``max_files_per_trigger`` files (only their paths reach the
    driver), so a backlog is ingested in bounded, individually replayable batches.
    Warn rules (EXP-01) are counted with an ``Observation`` on the same pass that writes
    each batch; the counts go to the batch's partition of ``metrics_path`` (the rule log)
    and are kept on the returned query as ``expectation_metrics``. A record with more or
    fewer fields than its header keeps its line in ``_malformed_record`` and counts as a
    violation of ``well_formed_record``. ``clock`` sets the load time (``at_clock``).

    With ``available_now=False`` a replayed batch writes new files into its partition, which
    a stream that reads ``target`` at the same time would take again: run readers after
    this stream has stopped, as the runner does.
    """
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
         .option("recursiveFileLookup", "true").option("maxFileAge", MAX_FILE_AGE))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    files = r.load(source_dir).select("path")
    writer = _EvolvingBatchWriter(target, multiline, list(expected or []), list(rules),
                                  dataset or target.rstrip("/").split("/")[-1], metrics_path, clock)
    w = files.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    q.expectation_metrics = writer.metrics
    return q


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """Read an ingested table; files of later batches may carry more columns."""
    from lakeward.sources.tables import read_table
    return read_table(spark, target)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a DataFrame as raw TSV in the ingest dialect (all columns as text)."""
    (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
     .write.mode(mode).options(**tsv_options()).csv(path))
