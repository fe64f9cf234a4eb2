"""Reusable column expressions for typing and cleansing raw text (PRJ-01..13, FN-01..16).

All are built-in Spark expressions (whole-stage codegen, no Python worker). Input data
is cast with ``try_cast``: under ANSI mode a plain cast of bad text raises (P1, P2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES — digit patterns of the pattern-guarded integer casts.
YEAR_1_TO_4_DIGITS = "^[0-9]{1,4}$"   # person years (427 = a year BC stored positive)
YEAR_4_DIGITS = "^[0-9]{4}$"          # title years
DIGITS = "^[0-9]+$"                   # runtime, season, episode


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """PRJ-02 / FN-01: trim spaces (tabs stay, P4)."""
    return F.trim(_c(c))


def guarded_int(c, pattern: str = DIGITS) -> Column:
    """PRJ-03..05, FN-04, FN-14: integer only when the raw text matches ``pattern`` (``rlike``);
    NULL otherwise.

    ``try_cast`` keeps out-of-range digit strings (``99999999999``) NULL instead of failing.
    """
    c = _c(c)
    return F.when(c.rlike(pattern), c.try_cast("int"))


def to_int(c) -> Column:
    """PRJ-06: unguarded cast to int; bad text gives NULL."""
    return _c(c).try_cast("int")


def to_double(c) -> Column:
    """PRJ-07: unguarded cast to double; bad text gives NULL."""
    return _c(c).try_cast("double")


def flag(c, true_value: str = "1") -> Column:
    """PRJ-08: ``true_value`` -> true; anything else, NULL included, -> false."""
    return F.when(_c(c) == F.lit(true_value), F.lit(True)).otherwise(F.lit(False))


def split_list(c, sep: str = ",") -> Column:
    """PRJ-09: delimited list -> array; NULL or empty -> NULL; elements are not trimmed."""
    c = _c(c)
    return F.when(c.isNotNull() & (c != F.lit("")), F.split(F.trim(c), _regex_literal(sep)))


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


def upper_code(c) -> Column:
    """PRJ-10: ``upper(trim(c))``."""
    return F.upper(F.trim(_c(c)))


def lower_code(c) -> Column:
    """PRJ-11: ``lower(trim(c))``."""
    return F.lower(F.trim(_c(c)))


def strip_brackets(c) -> Column:
    """PRJ-12: drop a leading ``["`` and a trailing ``"]`` only (inner ``","`` stays). Cut by
    position; a ``"]`` that is not the very end is left to the pattern, whose ``$`` also stands
    before a last line break."""
    c = F.trim(_c(c))
    c = F.when(c.startswith('["'), F.substring(c, 3, 2**31 - 1)).otherwise(c)
    return (F.when(c.endswith('"]'), F.left(c, F.length(c) - 2))
            .when(c.contains('"]'), F.regexp_replace(c, r'"\]$', "")).otherwise(c))


def joined(c, sep: str = ",") -> Column:
    """FN-07: array -> text (NULL array -> NULL; NULL elements skipped)."""
    return F.array_join(_c(c), sep)


def count_items(c) -> Column:
    """FN-08: array length; NULL array -> NULL under ANSI (P3)."""
    return F.size(_c(c))


def composite_key(*parts, sep: str = "_") -> Column:
    """FN-09: ``concat`` with a separator; NULL when any part is NULL."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.concat(*cols)


def null_safe_key(*parts, sep: str = "_") -> Column:
    """GD-13 key: like ``composite_key`` but the last part's NULL becomes ``''``."""
    parts = list(parts)
    parts[-1] = F.coalesce(_c(parts[-1]).cast("string"), F.lit(""))
    return composite_key(*parts, sep=sep)


def mapped(c, mapping, default: str) -> Column:
    """FN-12: chained ``when(isin(values), label)`` in order, else ``default``."""
    c = _c(c)
    out = None
    for values, label in mapping:
        out = (F.when(c.isin(*values), F.lit(label)) if out is None
               else out.when(c.isin(*values), F.lit(label)))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def carry_load_time(src: str = "_loaded_at") -> list[Column]:
    """PRJ-13, FN-15: carry the load time forward and stamp the processing time
    (``current_timestamp``)."""
    return [F.col(src).alias("source_loaded_at"), F.current_timestamp().alias("silver_processed_at")]


#: Columns that hold the time of the run that wrote a row (PRJ-13, FN-15).
CLOCK_COLUMNS = ("_loaded_at", "silver_processed_at", "load_dt")


def at_clock(df: DataFrame, clock: Column | str | None) -> DataFrame:
    """``df`` with its clock columns at ``clock`` (an instant; text is read in the session's time
    zone). None keeps the time of the query itself. Every layer of a run takes the same clock,
    so that a run can be repeated, or dated to its delivery, with equal rows."""
    if clock is None:
        return df
    at = F.lit(clock).cast("timestamp") if isinstance(clock, str) else clock.cast("timestamp")
    return df.select(*[at.alias(c) if c in CLOCK_COLUMNS else F.col(f"`{c}`") for c in df.columns])


def typed_null(dtype: str = "string") -> Column:
    """FN-13: a typed NULL literal (``lit(None).cast``)."""
    return F.lit(None).cast(dtype)
