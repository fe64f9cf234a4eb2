"""Star-schema builders: pass-through, exploded, mapped, composite and coded dimensions
(GD-03..09, JN-01, AGG-09/10).

All functions take and return DataFrames and work on streaming input where the
operation allows it (``dropDuplicates`` on a stream keeps per-key state; the key
spaces here — genres, categories, jobs — are small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.cleanse import composite_key, mapped

# A lookup side is broadcast only when its distinct-key count is at most this.
BROADCAST_MAX_ROWS = 1_000_000


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """AGG-09/10: one row per ``key``.

    Streaming: stateful ``dropDuplicates`` (the modelled behaviour; small key spaces).
    Batch: a hash ``distinct`` of the (few) selected columns first — partial aggregation
    shrinks the input map-side without sorting it — then the smallest row per key on that
    tiny result, so the pick is deterministic.
    """
    if df.isStreaming:
        return df.dropDuplicates([key])
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    # A window (not an aggregate) on top keeps Catalyst from removing the hash distinct.
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in others])
    return (df.distinct().withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def renamed(df: DataFrame, columns: dict, tags: dict | None = None,
            stamp: str | None = None) -> DataFrame:
    """GD-03/11/12: select + rename (``{new: old}``) + constant tags + load stamp."""
    cols = [F.col(old).alias(new) for new, old in columns.items()]
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    cols += [F.lit(v).alias(k) for k, v in (tags or {}).items()]
    return df.select(*cols)


def exploded_dimension(df: DataFrame, array_col: str, key: str, name: str,
                       stamp: str | None = None) -> DataFrame:
    """GD-04: explode a list column, drop NULL items, trim, one row per key."""
    items = df.select(F.explode(F.col(array_col)).alias("_item")).filter(F.col("_item").isNotNull())
    cols = [F.trim("_item").alias(key), F.trim("_item").alias(name)]
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    return one_row_per_key(items.select(*cols), key)


def mapped_dimension(df: DataFrame, source: str, key: str, name: str, group: str,
                     mapping, default: str, stamp: str | None = None) -> DataFrame:
    """GD-05: distinct non-NULL values with a group label from a value mapping."""
    src = F.col(source)
    cols = [F.trim(src).alias(key), src.alias(name), mapped(src, mapping, default).alias(group)]
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    return one_row_per_key(df.select(source).filter(src.isNotNull()).select(*cols), key)


def composite_dimension(df: DataFrame, parent: str, child: str, key: str, parent_key: str,
                        child_name: str, child_description: str | None = None,
                        stamp: str | None = None) -> DataFrame:
    """GD-06: rows with a non-NULL child value keyed ``parent_child`` (D10: ambiguous join)."""
    cols = [composite_key(parent, child).alias(key), F.trim(parent).alias(parent_key),
            F.col(child).alias(child_name)]
    if child_description:
        cols.append(F.col(child).alias(child_description))
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    return one_row_per_key(df.select(parent, child).filter(F.col(child).isNotNull())
                           .select(*cols), key)


def dedupe_lookup(lookup: DataFrame, code: str, name: str) -> DataFrame:
    """AGG-10 on a lookup: lower-cased code, the smallest name per code (deterministic)."""
    return (lookup.select(F.lower(F.col(code)).alias("_ref_code"), F.col(name).alias("_ref_name"))
            .groupBy("_ref_code").agg(F.min("_ref_name").alias("_ref_name")))


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only when a count proves it small; otherwise leave the join to the
    planner (sort-merge / AQE). The count runs on the (small) lookup, not the fact side."""
    return F.broadcast(df) if df.count() <= max_rows else df


def coded_dimension(values: DataFrame, source: str, lookup: DataFrame, lookup_code: str,
                    lookup_name: str, key: str, code: str, name: str,
                    stamp: str | None = None, broadcast_max_rows: int = BROADCAST_MAX_ROWS
                    ) -> DataFrame:
    """GD-07/08 + JN-01: distinct codes of ``values.source`` named from a lookup; a code the
    lookup lacks falls back to itself. Matching is case-insensitive.

    The distinct step aggregates map-side, so the fact side never shuffles whole; the
    de-duplicated lookup is broadcast behind a size check. Both sides are unique on the
    join key, so no final de-duplication is needed.
    """
    codes = (values.select(source).filter(F.col(source).isNotNull())
             .select(F.trim(source).alias(key)).distinct()
             .withColumn("_code_lower", F.lower(F.col(key))))
    ref = bounded_broadcast(dedupe_lookup(lookup, lookup_code, lookup_name), broadcast_max_rows)
    cols = [F.col(key), F.col(key).alias(code), F.coalesce("_ref_name", key).alias(name)]
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    return codes.join(ref, F.col("_code_lower") == F.col("_ref_code"), "left").select(*cols)


def alternates(df: DataFrame, parent: str, ordering: str, key: str, columns: list,
               stamp: str | None = None, tags: dict | None = None) -> DataFrame:
    """GD-09: key ``parent_ordering`` then ordered ``(name, Column_or_name)`` payload
    (trimmed foreign keys are passed as ``F.trim(...)``), stamp and constant tags."""
    cols = [composite_key(parent, ordering).alias(key)]
    cols += [(v if not isinstance(v, str) else F.col(v)).alias(k) for k, v in columns]
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    cols += [F.lit(v).alias(k) for k, v in (tags or {}).items()]
    return df.select(*cols)
