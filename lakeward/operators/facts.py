"""Bridge and fact builders (GD-10..13, FN-06, FN-09, FN-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.cleanse import null_safe_key


def bridge(df: DataFrame, parent: str, array_col: str, key: str, parent_alias: str | None = None,
           primary_flag: str | None = "is_primary_genre", stamp: str | None = None) -> DataFrame:
    """GD-10: one row per (parent, list item); NULL/empty lists give no rows; not de-duplicated.

    ``explode`` is a generator inside the scan stage: no shuffle, any list length.
    """
    out = (df.select(F.col(parent), F.explode(F.col(array_col)).alias("_item"))
           .filter(F.col("_item").isNotNull()))
    cols = [F.col(parent).alias(parent_alias or parent), F.trim("_item").alias(key)]
    if primary_flag:
        cols.append(F.lit(False).alias(primary_flag))  # D7: constant in the modelled source
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    return out.select(*cols)


def fact(df: DataFrame, columns: dict, tags: dict | None = None,
         stamp: str | None = None) -> DataFrame:
    """GD-11/12: renamed pass-through with load metadata (``{new: old_or_Column}``)."""
    cols = [(v if not isinstance(v, str) else F.col(v)).alias(k) for k, v in columns.items()]
    if stamp:
        cols.append(F.current_timestamp().alias(stamp))
    cols += [F.lit(v).alias(k) for k, v in (tags or {}).items()]
    return df.select(*cols)


def credits_fact(df: DataFrame, parent: str, member: str, category: str, job: str,
                 ordering: str, payload: dict | None = None, tags: dict | None = None,
                 stamp: str | None = None, category_key: str = "category_key",
                 job_key: str = "job_key") -> DataFrame:
    """GD-13: trimmed category key and the NULL-safe ``category_job`` key (D6, D8)."""
    cols = {parent: F.col(parent), member: F.col(member),
            category_key: F.trim(category), job_key: null_safe_key(category, job),
            ordering: F.col(ordering)}
    for k, v in (payload or {}).items():
        cols[k] = F.col(v)
    return fact(df, cols, tags, stamp)
