"""Type-2 slowly changing dimension from a change feed (SCD-01, SCD-03, SCD-04).

Semantics (from the change-application call being modelled):

1. The first row of a key opens a version; ``__START_AT`` is its sequence value.
2. A later row opens a new version only when a *tracked* column changes (NULL-safe);
   otherwise the untracked columns of the open version are refreshed in place, so a
   version carries the values of its latest row.
3. A version's ``__END_AT`` is the next version's ``__START_AT``; the open one has NULL.
4. Out-of-order arrivals land by sequence value (this is a recompute, not a replay).
5. Rows tying on (key, sequence) collapse to the greatest struct of the other columns.
6. ``A -> B -> A`` gives three versions.
7. A change with a NULL sequence value cannot be ordered and is not applied.

Plan: one shuffle of the feed on (key, bucket of the sequence) with windows inside buckets and a
small per-(key, bucket) carry table (``segmented.run_versions``); each version is its
last row, so there is no aggregate over rows and no task ever holds a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.segmented import bucket_for, run_versions

START = "__START_AT"
END = "__END_AT"


# A (key, time slice) holding more rows than this is cut into proportionally many
# sub-slices (see segmented.with_dense_slice_factor).
MAX_BUCKET_ROWS = 1_000_000


def scd2_history(changes: DataFrame, keys: Sequence[str], seq: str, tracked: Sequence[str],
                 bucket_width: int | None = None, tiebreak: Sequence[str] | None = None,
                 start_col: str = START, end_col: str = END,
                 max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """SCD-01: the full type-2 history of ``changes`` (batch or a micro-batch's log).

    A key with many rows is split into slices of about equally many (at most
    ``max_bucket_rows``), see ``segmented.with_equal_depth_bucket``. With ``bucket_width`` they
    are slices of that width instead (seconds of a timestamp, days of a date, else units), of
    which one with more than ``max_bucket_rows`` rows is cut finer.
    """
    keys, cols = list(keys), list(changes.columns)
    if tiebreak is None:   # all other source columns, compared in order (greatest wins)
        tiebreak = [c for c in cols if c not in keys and c != seq]
    if max_bucket_rows and bucket_width is None:
        from lakeward.operators.segmented import BUCKET, with_equal_depth_bucket
        feed = with_equal_depth_bucket(changes, keys, seq, max_bucket_rows, tiebreak)
        out = run_versions(feed, keys, seq, list(tracked), F.col(BUCKET), tiebreak, start_col, end_col)
        return out.select(*cols, start_col, end_col)
    if max_bucket_rows:
        from lakeward.operators.segmented import BUCKET_FACTOR, with_dense_slice_factor
        feed = with_dense_slice_factor(changes, keys, seq, bucket_width, max_bucket_rows)
        bucket = bucket_for(feed, seq, bucket_width, F.col(BUCKET_FACTOR))
        out = run_versions(feed, keys, seq, list(tracked), bucket, tiebreak, start_col, end_col)
        return out.select(*cols, start_col, end_col)
    return run_versions(changes, keys, seq, list(tracked),
                        bucket_for(changes, seq, bucket_width), tiebreak, start_col, end_col)


def current_rows(history: DataFrame, end_col: str = END) -> DataFrame:
    """SCD-04: open versions."""
    return history.filter(F.col(end_col).isNull())


def closed_rows(history: DataFrame, end_col: str = END) -> DataFrame:
    """SCD-04: closed (historical) versions."""
    return history.filter(F.col(end_col).isNotNull())


def split_counts(history: DataFrame, keys: Sequence[str], end_col: str = END) -> DataFrame:
    """SCD-04 / QA-21 in one pass: current, historical, total rows and distinct keys."""
    k = list(keys)
    per_key = history.groupBy(*k).agg(
        F.count_if(F.col(end_col).isNull()).alias("_cur"),
        F.count_if(F.col(end_col).isNotNull()).alias("_hist"))
    return per_key.agg(
        F.coalesce(F.sum("_cur"), F.lit(0)).cast("long").alias("current_rows"),
        F.coalesce(F.sum("_hist"), F.lit(0)).cast("long").alias("historical_rows"),
        F.coalesce(F.sum(F.col("_cur") + F.col("_hist")), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"))


def change_feed(df: DataFrame, columns: dict, stamp: str = "load_dt",
                tag: tuple | None = None) -> DataFrame:
    """SCD-03: change-feed projection ``{new: Column_or_name}`` + sequence stamp + source tag."""
    cols = [(v if not isinstance(v, str) else F.col(v)).alias(k) for k, v in columns.items()]
    cols.append(F.current_timestamp().alias(stamp))
    if tag:
        cols.append(F.lit(tag[1]).alias(tag[0]))
    return df.select(*cols)


def strict_overlaps(history: DataFrame, keys: Sequence[str], start_col: str = START,
                    end_col: str = END, bucket_width: int | None = None,
                    max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """QA-22 strict form: versions whose successor (by start, then end with NULLs first)
    starts before this one ends (an open end is +infinity, so two open versions of a key
    count). One row: ``overlaps``."""
    from lakeward.operators.segmented import BUCKET_FACTOR, next_value, with_dense_slice_factor
    h = history.select(*keys, start_col, end_col)
    if max_bucket_rows:
        h = with_dense_slice_factor(h, keys, start_col, bucket_width, max_bucket_rows)
        b = bucket_for(h, start_col, bucket_width, F.col(BUCKET_FACTOR))
    else:
        b = bucket_for(h, start_col, bucket_width)
    n = next_value(h, keys, start_col, start_col, b, "_next_start", tiebreak=end_col)
    bad = F.col("_next_start").isNotNull() & (
        F.col(end_col).isNull() | (F.col("_next_start") < F.col(end_col)))
    return n.agg(F.count_if(bad).alias("overlaps"))


def reference_overlaps(history: DataFrame, keys: Sequence[str], start_col: str = START,
                       end_col: str = END, bucket_width: int | None = None,
                       max_bucket_rows: int | None = MAX_BUCKET_ROWS) -> DataFrame:
    """QA-22 / JN-05 metric of the modelled check: the count of ordered version pairs of a
    key with ``a.start < b.end AND a.end > b.start AND a.start != b.start`` (open versions
    never match; each closed overlap counts twice). Computed by a sorted sweep, not by
    forming the pairs (but for those with a period of ``start >= end``). One row:
    ``pairs``."""
    from lakeward.operators.segmented import overlap_pairs
    return overlap_pairs(history, keys, start_col, end_col, bucket_width, max_bucket_rows)
