"""Validation checks returning result rows (QA-01..26).

Every check yields rows of one schema::

    check_id, table_name, column_name, status (PASS|FAIL|WARN|INFO), metric, threshold,
    counted, total

``counted`` and ``total`` are the counts behind a metric: the rows it found (violating, named,
complete, surplus, orphaned, kept rows) and those it looked at; NULL where a metric rests on
no count of rows (ages, statistics, schema checks, absent tables).

Checks on one table are *measures* evaluated together in a single aggregate pass
(``measure_table``) — not one job per check. Checks that need a shuffle (duplicates,
orphans) aggregate map-side before the shuffle, so a hot key costs one row per task.
Schema checks read metadata only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASS, FAIL, WARN, INFO = "PASS", "FAIL", "WARN", "INFO"

RESULT_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("metric", T.DoubleType()),
    T.StructField("threshold", T.StringType()),
    T.StructField("counted", T.LongType()),
    T.StructField("total", T.LongType()),
])
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]


@dataclass(frozen=True)
class Measure:
    """An aggregate ``value`` and the test of the resulting metric (None = report only), with
    the counts behind it."""
    check_id: str
    column: str | None
    value: Column
    passes: Callable[[Column], Column] | None = None
    threshold: str = ""
    fail_status: str = FAIL
    null_status: str | None = None   # status when the metric is NULL (default: fail_status)
    counted: Column | None = None
    total: Column | None = None


def _status(m: Measure, metric: Column) -> Column:
    if m.passes is None:
        return F.lit(INFO)
    null_status = m.null_status or m.fail_status
    return (F.when(metric.isNull(), F.lit(null_status))
            .when(m.passes(metric), F.lit(PASS)).otherwise(F.lit(m.fail_status)))


def measure_table(df: DataFrame, table: str, measures: Sequence[Measure]) -> DataFrame:
    """Evaluate all measures of one table in ONE aggregate and return one row each."""
    measures = list(measures)
    none = F.lit(None).cast("long")
    agg = df.agg(*[c for i, m in enumerate(measures) for c in (
        m.value.cast("double").alias(f"_m{i}"),
        (none if m.counted is None else m.counted.cast("long")).alias(f"_c{i}"),
        (none if m.total is None else m.total.cast("long")).alias(f"_t{i}"))])
    rows = [F.struct(F.lit(m.check_id).alias("check_id"), F.lit(table).alias("table_name"),
                     F.lit(m.column).cast("string").alias("column_name"),
                     _status(m, F.col(f"_m{i}")).alias("status"),
                     F.col(f"_m{i}").alias("metric"), F.lit(m.threshold).alias("threshold"),
                     F.col(f"_c{i}").alias("counted"), F.col(f"_t{i}").alias("total"))
            for i, m in enumerate(measures)]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def union_results(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-01 / QA-27: combine result rows of many checks into one DataFrame."""
    frames = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b), frames)


def side_by_side(*frames: DataFrame) -> DataFrame:
    """JN-06 without a cross join: one-row aggregates with disjoint columns become one row
    (union by name with the missing columns NULL, then a single ``max`` per column)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.max(c).alias(c) for f in frames for c in f.columns])


def result_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Result rows computed from metadata (schemas), not data; counts may be left out."""
    width = len(RESULT_COLUMNS)
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], RESULT_SCHEMA)


def _eq0(m: Column) -> Column:
    return m == 0


def _no_rows(check_id: str, column: str, condition: Column) -> Measure:
    """No row may meet ``condition``."""
    found = F.count_if(condition)
    return Measure(check_id, column, found, _eq0, "= 0", counted=found, total=F.count(F.lit(1)))


def _share(found: Column) -> Column:
    """``found`` in per cent of all rows; 0 on an empty table."""
    return F.coalesce(found * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0))


# ---- measures (single-pass, per table) -------------------------------------------------

def not_null(column: str, check_id: str = "QA-02") -> Measure:
    """QA-02/QA-14: NULL keys."""
    return _no_rows(check_id, column, F.col(column).isNull())


def id_format(column: str, pattern: str, check_id: str = "QA-04") -> Measure:
    """QA-04: values not matching ``pattern`` (NULL is not counted, as in the source)."""
    return _no_rows(check_id, column, ~F.col(column).rlike(pattern))


def violations(column: str, violation_sql: str, check_id: str = "QA-05") -> Measure:
    """QA-05/17/18, AGG-02: rows for which ``violation_sql`` holds (a conditional count)."""
    return _no_rows(check_id, column, F.expr(violation_sql))


def allowed_values(column: str, values: Sequence, check_id: str = "QA-07") -> Measure:
    """QA-07/15: values outside the enumeration (NULL not counted)."""
    return _no_rows(check_id, column, ~F.col(column).isin(*values))


def self_reference(column: str, parent: str, check_id: str = "QA-08") -> Measure:
    """QA-08/18: a row pointing at itself."""
    return _no_rows(check_id, f"{column}={parent}", F.col(column) == F.col(parent))


def non_empty(check_id: str = "QA-11") -> Measure:
    """QA-11, AGG-01: the table has rows (a whole-table count)."""
    rows = F.count(F.lit(1))
    return Measure(check_id, None, rows, lambda m: m > 0, "> 0", counted=rows, total=rows)


def named_share(name: str, key: str, min_pct: float, check_id: str = "QA-16") -> Measure:
    """QA-16: % of rows whose name differs from the key (0 on an empty table)."""
    named = F.count_if(F.col(name) != F.col(key))
    return Measure(check_id, name, _share(named), lambda m: m >= min_pct, f">= {min_pct}",
                   counted=named, total=F.count(F.lit(1)))


def completeness(column: str, check_id: str = "QA-23") -> Measure:
    """QA-23: % non-NULL (0 on an empty table); a report."""
    found = F.count(F.col(column))
    return Measure(check_id, column, _share(found), counted=found, total=F.count(F.lit(1)))


def statistic(label: str, value: Column, check_id: str = "QA-24") -> Measure:
    """QA-24/AGG-07: a reported statistic."""
    return Measure(check_id, label, value)


def freshness(column: str, as_of: Column, max_hours: float, check_id: str = "QA-10",
              empty_status: str = FAIL) -> Measure:
    """QA-10/26, AGG-06: hours between the newest stamp (``max``) and ``as_of``; no stamp ->
    ``empty_status``."""
    newest = F.max(F.col(column).cast("timestamp"))
    hours = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(newest)) / F.lit(3.6e9)
    return Measure(check_id, column, hours, lambda m: m < max_hours, f"< {max_hours}",
                   null_status=empty_status)


# ---- checks that shuffle ----------------------------------------------------------------

def key_digest(df: DataFrame, keys: Sequence[str]) -> Column:
    """SHA-256 of a key tuple: each part with its length (NULL apart from any text), so that
    different tuples never read the same."""
    parts = [F.coalesce(F.concat(F.length(df[k].cast("string")).cast("string"), F.lit(":"),
                                 df[k].cast("string")), F.lit("-")) for k in keys]
    return F.sha2(F.concat_ws(";", *parts), 256)


def key_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-04/05 in one shuffle: total rows, distinct keys, surplus rows, duplicate groups.

    ``groupBy`` counts partially per task before the shuffle; NULL keys form a group
    (as ``distinct`` does, unlike ``countDistinct``). Keys with a text column are shuffled as
    their digest (``key_digest``), whatever the length of the text."""
    wide = any(isinstance(f.dataType, T.StringType) for f in df.schema.fields if f.name in keys)
    by = [key_digest(df, keys).alias("_key")] if wide else list(keys)
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
                 F.count(F.lit(1)).alias("distinct_keys"),
                 F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
                 F.count_if(F.col("_n") > 1).alias("duplicate_groups"))


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str], check_id: str = "QA-09"
                   ) -> DataFrame:
    """QA-09/19/25: surplus rows = total - distinct keys."""
    s = key_stats(df, keys)
    return s.select(F.lit(check_id).alias("check_id"), F.lit(table).alias("table_name"),
                    F.lit(",".join(keys)).alias("column_name"),
                    F.when(F.col("surplus_rows") == 0, F.lit(PASS)).otherwise(F.lit(FAIL))
                    .alias("status"), F.col("surplus_rows").cast("double").alias("metric"),
                    F.lit("= 0").alias("threshold"), F.col("surplus_rows").alias("counted"),
                    F.col("total_rows").alias("total"))


def orphan_counts(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                  skip_null: bool = False) -> DataFrame:
    """JN-02..04: child rows whose key has no parent row; one row (orphan_rows, total_rows).

    The child side is first reduced to (key, count) — map-side partial aggregation, so a
    key held by a third of the rows is one row per task — then outer-joined once with the
    parent's distinct keys (the anti-join and the total in one pass). NULL keys are
    orphans unless ``skip_null`` (P6)."""
    c = child.select(F.col(child_col).alias("_k"))
    if skip_null:
        c = c.filter(F.col("_k").isNotNull())
    per_key = c.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(parent_col).alias("_p")).distinct().withColumn("_hit", F.lit(1))
    j = per_key.join(parents, per_key["_k"] == parents["_p"], "left")
    return j.agg(F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0))
                 .cast("long").alias("orphan_rows"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"))


def foreign_key(child: DataFrame, child_table: str, child_col: str, parent: DataFrame,
                parent_table: str, parent_col: str, skip_null: bool = False,
                tolerance_pct: float | None = None, check_id: str = "QA-20") -> DataFrame:
    """QA-08/19/20: orphan count (0 allowed) or orphan % below a tolerance."""
    o = orphan_counts(child, child_col, parent, parent_col, skip_null)
    column = f"{child_col}->{parent_table}.{parent_col}"
    if tolerance_pct is None:
        metric, ok, thr = F.col("orphan_rows").cast("double"), F.col("orphan_rows") == 0, "= 0"
    else:
        metric = F.coalesce(F.col("orphan_rows") * F.lit(100.0)
                            / F.nullif(F.col("total_rows"), F.lit(0)), F.lit(0.0))
        ok, thr = metric < tolerance_pct, f"< {tolerance_pct}"
    return o.select(F.lit(check_id).alias("check_id"), F.lit(child_table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
                    metric.alias("metric"), F.lit(thr).alias("threshold"),
                    F.col("orphan_rows").alias("counted"), F.col("total_rows").alias("total"))


def reconcile(upstream: DataFrame, downstream: DataFrame, table: str,
              max_drop_pct: float | None = None, min_ratio_pct: float | None = None,
              check_id: str = "QA-01") -> DataFrame:
    """QA-01 (drop % <= max; 0 when upstream is empty) or QA-13 (ratio % >= min); ``counted`` and
    ``total`` are the rows downstream and upstream."""
    up = upstream.agg(F.count(F.lit(1)).alias("_up"))
    down = downstream.agg(F.count(F.lit(1)).alias("_down"))
    j = side_by_side(up, down)
    if max_drop_pct is not None:
        metric = F.when(F.col("_up") > 0, (F.col("_up") - F.col("_down")) * F.lit(100.0)
                        / F.col("_up")).otherwise(F.lit(0.0))
        ok, thr = metric <= max_drop_pct, f"<= {max_drop_pct}"
    else:
        metric = F.when(F.col("_up") > 0, F.col("_down") * F.lit(100.0) / F.col("_up")
                        ).otherwise(F.lit(0.0))
        ok, thr = metric >= min_ratio_pct, f">= {min_ratio_pct}"
    return j.select(F.lit(check_id).alias("check_id"), F.lit(table).alias("table_name"),
                    F.lit(None).cast("string").alias("column_name"),
                    F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
                    metric.alias("metric"), F.lit(thr).alias("threshold"),
                    F.col("_down").alias("counted"), F.col("_up").alias("total"))


# ---- schema checks (metadata only) --------------------------------------------------------

def column_types(df: DataFrame, table: str, expected: dict, check_id: str = "QA-03"
                 ) -> list[tuple]:
    """QA-03: exact type match; a missing column is NOT_FOUND (metric 0 = match, 1 = not)."""
    actual = dict(df.dtypes)
    out = []
    for c, t in expected.items():
        a = actual.get(c, "NOT_FOUND")
        ok = a.lower() == t.lower()
        out.append((check_id, table, c, PASS if ok else FAIL, 0.0 if ok else 1.0, f"{t}|{a}"))
    return out


def first_non_null(df: DataFrame, column: str) -> DataFrame:
    """LIM-02: the first non-NULL sample value of a column (``limit(1)``; the scan stops
    early). The array-type check below uses the schema instead of such a sample."""
    return df.filter(F.col(column).isNotNull()).select(column).limit(1)


def array_columns(df: DataFrame, table: str, columns: Sequence[str], check_id: str = "QA-06"
                  ) -> list[tuple]:
    """QA-06: the columns really are arrays (from the schema, not a LIM-02 sample row)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in columns:
        ok = isinstance(fields.get(c), T.ArrayType)
        out.append((check_id, table, c, PASS if ok else FAIL, 0.0 if ok else 1.0, "array"))
    return out


def required_columns(df: DataFrame, table: str, columns: Sequence[str],
                     check_id: str = "QA-12", missing_status: str = FAIL) -> list[tuple]:
    """QA-12: required columns present."""
    missing = [c for c in columns if c not in df.columns]
    return [(check_id, table, ",".join(columns), PASS if not missing else missing_status,
             float(len(missing)), "all present")]
