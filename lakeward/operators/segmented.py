"""Ordered per-key scans that do not put a whole key into one task.

A window ``PARTITION BY key ORDER BY seq`` sends every row of a key to one task; with
one key holding a third of the data that task is the job. Here the window runs per
``(key, bucket)`` where ``bucket`` is a contiguous slice of ``seq`` (e.g. one day), and
the only cross-bucket information — "the last row of the previous bucket" and "how many
events happened before this bucket" — is carried by a per-``(key, bucket)`` table that
has one row per bucket, not per event. That table is small (key count × buckets) and is
joined back on ``(key, bucket)``, which is already the partitioning of the big side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


# A dense (key, slice) is cut into at most this many sub-slices; bucket ids stay ordered
# as slice * SUB_SLICES + sub-slice.
SUB_SLICES = 1 << 20


def _units(df: DataFrame, seq: str, width: int | None) -> tuple[Column, int]:
    """The sequence as an ordered number (microseconds for timestamps) and the slice width
    in the same unit."""
    dtype = dict(df.dtypes)[seq]
    if dtype in ("timestamp", "timestamp_ntz"):   # NTZ -> instant keeps the order
        return F.unix_micros(F.col(seq).cast("timestamp")), int(width or DAY_SECONDS) * 1_000_000
    if dtype == "date":
        return F.unix_date(F.col(seq)).cast("long"), int(width or 1)
    return F.col(seq), int(width or 1_000_000)


def slice_of(df: DataFrame, seq: str, width: int | None = None) -> Column:
    """Contiguous slice id of ``seq`` (``width`` seconds for timestamps, days for dates,
    units otherwise)."""
    u, w = _units(df, seq, width)
    return F.floor(u / F.lit(w)).cast("long")


def bucket_for(df: DataFrame, seq: str, width: int | None = None,
               factor: Column | None = None) -> Column:
    """Bucket id, non-decreasing in ``seq`` within a key. Without ``factor`` it is the
    slice id; with ``factor`` (>= 1, constant per key and slice) each slice is cut into
    ``factor`` equal sub-slices: ``slice * SUB_SLICES + sub``."""
    u, w = _units(df, seq, width)
    base = F.floor(u / F.lit(w)).cast("long")
    if factor is None:
        return base
    offset = u - base * F.lit(w)
    sub = F.floor(offset * factor.cast("long") / F.lit(w)).cast("long")
    return base * F.lit(SUB_SLICES) + F.least(sub, F.lit(SUB_SLICES - 1))


def number_bucket(seq: str, width: int) -> Column:
    """Contiguous slice id of a numeric column (``width`` wide)."""
    return F.floor(F.col(seq) / F.lit(width)).cast("long")


BUCKET_FACTOR = "_bucket_factor"
BROADCAST_MAX_DENSE = 2_000_000


def with_dense_slice_factor(df: DataFrame, keys: Sequence[str], seq: str,
                            width: int | None, max_rows: int) -> DataFrame:
    """Add ``_bucket_factor``: ceil(rows / ``max_rows``) for (key, slice) pairs holding
    more than ``max_rows`` rows, 1 elsewhere — so a hot key is cut finer exactly where its
    rows crowd, and its sparse slices stay whole (its carry table stays ~rows/max_rows
    plus its slice count).

    The dense-pair table has at most total_rows / ``max_rows`` rows by construction; it
    is broadcast only after a count confirms the bound, joined NULL-safely, and skipped
    entirely when empty (the common case).
    """
    keys = list(keys)
    d = df.withColumn("_slice", slice_of(df, seq, width))
    dense = (d.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_cnt"))
             .filter(F.col("_cnt") > max_rows)
             .select(*keys, "_slice", F.least(F.ceil(F.col("_cnt") / F.lit(max_rows)),
                                              F.lit(SUB_SLICES)).cast("long")
                     .alias(BUCKET_FACTOR)))
    n_dense = dense.count()
    if n_dense == 0:
        return df.withColumn(BUCKET_FACTOR, F.lit(1).cast("long"))
    if n_dense <= BROADCAST_MAX_DENSE:
        dense = F.broadcast(dense)
    out = _null_safe_join(d, dense, [*keys, "_slice"], "left")
    return (out.withColumn(BUCKET_FACTOR, F.coalesce(F.col(BUCKET_FACTOR), F.lit(1).cast("long")))
            .drop("_slice"))


# Cuts of one key, at most (its quantiles are taken at this many places).
MAX_CUTS = 1024
# Cuts are looked up in two steps of about this many comparisons.
CUT_STEP = 32
# Rows that are worth a slice of their own, whatever the number of tasks.
MIN_SLICE_ROWS = 1000
BROADCAST_MAX_CUTS = 2_000_000
BUCKET = "_depth_bucket"


def with_equal_depth_bucket(df: DataFrame, keys: Sequence[str], seq: str, max_rows: int,
                            tiebreak: Sequence[str]) -> DataFrame:
    """Add ``_depth_bucket``: contiguous slices of ``seq`` per key that hold about equally many
    rows, whatever the unit or the spread of the sequence.

    A slice has about total / (2 * shuffle partitions) rows, ``max_rows`` at most; keys below
    that (the common case, told by one aggregate) are one slice. The cuts of a larger key come
    from a quantile sketch of its rows (partial sketches per task). There are fewer cuts than
    rows / slice rows in all, so the table of cuts is broadcast once its size is checked.

    No cut can split an instant. One that fills two or more slices shows as a repeated quantile;
    its rows are reduced to the one that the tie rule keeps (the greatest ``tiebreak``) by a
    partial aggregate inside the tasks, before they meet. Rows without a sequence are dropped.
    """
    keys = list(keys)
    units, _ = _units(df, seq, None)
    df = df.filter(F.col(seq).isNotNull())
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    seen = counts.agg(F.sum("_cnt").alias("total"), F.max("_cnt").alias("most")).head()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    depth = min(max_rows, max(MIN_SLICE_ROWS, (seen["total"] or 0) // (2 * tasks)))
    if (seen["most"] or 0) <= depth:
        return df.withColumn(BUCKET, F.when(F.col(seq).isNull(), -1).otherwise(0).cast("long"))

    from lakeward.session import stored
    large = stored(counts.filter(F.col("_cnt") > depth), "large-keys")
    places = [F.lit(i / MAX_CUTS) for i in range(1, MAX_CUTS)]
    sketch = (_null_safe_join(df.select(*keys, units.alias("_u")), F.broadcast(large)
                              if large.count() <= BROADCAST_MAX_CUTS else large, keys)
              .groupBy(*keys).agg(F.percentile_approx("_u", F.array(*places), 20 * MAX_CUTS).alias("_q"),
                                  F.max("_cnt").alias("_cnt")))
    cuts = sketch.withColumn("_p", F.expr(f"cast(least({MAX_CUTS}, ceil(_cnt / {depth})) as int)"))
    cuts = cuts.withColumn("_raw", F.expr(f"transform(sequence(1, _p - 1), i -> _q[int(i * {MAX_CUTS} div _p) - 1])"))
    cuts = cuts.withColumn("_cuts", F.array_distinct("_raw"))
    cuts = cuts.withColumn("_full", F.expr("filter(_cuts, c -> size(filter(_raw, r -> r = c)) > 1)"))
    cuts = stored(cuts.select(*keys, "_cuts", "_full", F.expr(
        f"transform(sequence(0, (size(_cuts) - 1) div {CUT_STEP}), i -> _cuts[i * {CUT_STEP}])").alias("_coarse")), "cuts")
    n_cuts = cuts.agg(F.sum(F.size("_cuts"))).head()[0] or 0

    cols = list(df.columns)
    out = _null_safe_join(df.withColumn("_u", units), F.broadcast(cuts) if n_cuts <= BROADCAST_MAX_CUTS else cuts,
                          keys, "left")
    # Cuts at or below the row's sequence: those of the coarse steps, then those in the last step.
    step = F.expr("size(filter(_coarse, c -> c <= _u)) - 1")
    inside = F.expr(f"size(filter(slice(_cuts, _step * {CUT_STEP} + 1, {CUT_STEP}), c -> c <= _u))")
    out = out.withColumn("_step", step).withColumn(
        BUCKET, F.when(F.col("_cuts").isNull() | (F.col("_step") < 0), 0)
        .otherwise(F.col("_step") * CUT_STEP + inside).cast("long"))
    full = F.coalesce(F.expr("array_contains(_full, _u)"), F.lit(False))
    rest = out.filter(~full).select(*cols, BUCKET)
    if cuts.filter(F.size("_full") > 0).isEmpty():
        return rest
    others = [c for c in cols if c not in keys and c != seq]
    tied = (out.filter(full).groupBy(*keys, seq, BUCKET)
            .agg(F.max_by(F.struct(*others), F.struct(*tiebreak)).alias("_row")))
    return rest.unionByName(tied.select(*[F.col(f"_row.{c}").alias(c) if c in others else F.col(c) for c in cols], BUCKET))


def null_safe_differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
                    ) -> DataFrame:
    """Equi-join where NULL keys match NULL keys (still a hash / sort-merge join)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on],
                     *[c for c in right.columns if c not in on])
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in on]
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])


def run_versions(df: DataFrame, keys: Sequence[str], seq: str, tracked: Sequence[str],
                 bucket: Column, tiebreak: Sequence[str] | None = None,
                 start_col: str = "__START_AT", end_col: str = "__END_AT") -> DataFrame:
    """One row per run of unchanged ``tracked`` values per key, in ``seq`` order.

    A run opens at the first row of a key and wherever a tracked value differs
    NULL-safely from the previous row. The result row is the run's *last* row (so
    untracked columns carry their latest values) plus ``start_col`` (sequence value of
    the run's first row) and ``end_col`` (that of the next run's first row, NULL for the
    open run). Rows tying on ``(keys, seq)`` collapse first to the greatest
    ``tiebreak`` columns compared in order (default: all other columns; NULL lowest, as
    in struct ordering) — deterministic. The tie order is a sort key of the window, not
    a materialized column, so the shuffle carries each value once. A row with a NULL
    sequence value cannot be placed in order and is not applied.

    Plan: the rows shuffle once on ``(keys, bucket)``; windows run inside a bucket; a
    per-bucket summary (one row per key and bucket) carries "previous bucket's last
    tracked values", "version start in effect" and "next bucket's first row" across
    bucket edges and is joined back on ``(keys, bucket)``. No aggregate over rows and
    no per-key window over rows.
    """
    keys = list(keys)
    cols = list(df.columns)
    others = [c for c in cols if c not in keys and c != seq]
    tb = list(tiebreak) if tiebreak is not None else others

    d = (df.filter(F.col(seq).isNotNull())
         .withColumn("_b", F.coalesce(bucket, F.lit(-(2 ** 63)).cast("long"))))
    w = Window.partitionBy(*keys, "_b").orderBy(
        F.col(seq), *[F.col(c).desc_nulls_last() for c in tb])
    # Tie collapse: the first row per (keys, seq) in (seq, tiebreak desc) order wins.
    d = (d.withColumn("_prev_seq", F.lag(seq).over(w))
         .filter(F.col("_prev_seq").isNull() | (F.col("_prev_seq") != F.col(seq)))
         .drop("_prev_seq"))
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(seq))
    d = (d.withColumn("_t", F.struct(*[F.col(c) for c in tracked]))
         .withColumn("_rn", F.row_number().over(w))
         .withColumn("_inner_change",
                     F.when(F.col("_rn") > 1,
                            null_safe_differs(F.col("_t"), F.lag("_t").over(w)).cast("int"))
                     .otherwise(F.lit(0))))
    d = (d.withColumn("_has_next", F.lead(F.lit(1)).over(w).isNotNull())
         .withColumn("_lead_seq", F.lead(seq).over(w))
         .withColumn("_lead_change", F.lead("_inner_change").over(w))
         .withColumn("_inner_start",
                     F.max(F.when(F.col("_inner_change") == 1, F.col(seq))).over(
                         w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))

    # Per (key, bucket): first/last tracked values, first sequence, last inner run start.
    per_bucket = d.groupBy(*keys, "_b").agg(
        F.min_by("_t", F.col(seq)).alias("_first_t"),
        F.max_by("_t", F.col(seq)).alias("_last_t"),
        F.min(seq).alias("_first_seq"),
        F.max(F.when(F.col("_inner_change") == 1, F.col(seq))).alias("_last_inner_start"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    per_bucket = (per_bucket
                  .withColumn("_carry_last", F.lag("_last_t").over(wb))
                  .withColumn("_is_first_bucket", F.lag(F.lit(1)).over(wb).isNull()))
    per_bucket = per_bucket.withColumn(
        "_first_change",
        F.when(F.col("_is_first_bucket"), F.lit(1))
        .otherwise(null_safe_differs(F.col("_first_t"), F.col("_carry_last")).cast("int")))
    per_bucket = per_bucket.withColumn(
        "_bucket_start", F.coalesce(F.col("_last_inner_start"),
                                    F.when(F.col("_first_change") == 1, F.col("_first_seq"))))
    per_bucket = (per_bucket
                  .withColumn("_carry_start", F.last("_bucket_start", ignorenulls=True).over(
                      wb.rowsBetween(Window.unboundedPreceding, -1)))
                  .withColumn("_next_first_seq", F.lead("_first_seq").over(wb))
                  .withColumn("_next_first_change", F.lead("_first_change").over(wb))
                  .withColumn("_has_next_bucket", F.lead(F.lit(1)).over(wb).isNotNull())
                  .select(*keys, "_b", "_first_seq", "_first_change", "_carry_start",
                          "_next_first_seq", "_next_first_change", "_has_next_bucket"))

    d = _null_safe_join(d, per_bucket, [*keys, "_b"])
    start = F.coalesce(F.col("_inner_start"),
                       F.when(F.col("_first_change") == 1, F.col("_first_seq")),
                       F.col("_carry_start"))
    is_last = F.when(F.col("_has_next"), F.col("_lead_change") == 1).otherwise(
        ~F.col("_has_next_bucket") | (F.col("_next_first_change") == 1))
    end = F.when(F.col("_has_next"), F.when(F.col("_lead_change") == 1, F.col("_lead_seq"))
                 ).otherwise(F.when(F.col("_next_first_change") == 1, F.col("_next_first_seq")))
    return (d.filter(is_last)
            .select(*[F.col(c) for c in cols], start.alias(start_col), end.alias(end_col)))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence, values: dict,
                 bucket: Column) -> DataFrame:
    """Inclusive running sums ``{out: value}`` per key in ``order``, skew-safe.

    ``bucket`` must be non-decreasing in ``order`` (a contiguous slice of it). The
    in-bucket part is a window over ``(keys, bucket)``; the sum of earlier buckets comes
    from a per-``(key, bucket)`` total table (one row per bucket) joined back.
    """
    keys = list(keys)
    names = list(values)
    d = df.withColumn("_b", F.coalesce(bucket, F.lit(-(2 ** 63)).cast("long")))
    for i, n in enumerate(names):
        d = d.withColumn(f"_v{i}", values[n])
    w = (Window.partitionBy(*keys, "_b").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for i, _ in enumerate(names):
        d = d.withColumn(f"_l{i}", F.sum(f"_v{i}").over(w))
    totals = d.groupBy(*keys, "_b").agg(*[F.sum(f"_v{i}").alias(f"_t{i}")
                                          for i, _ in enumerate(names)])
    wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_b", *[F.coalesce(F.sum(f"_t{i}").over(wb), F.lit(0))
                                          .alias(f"_c{i}") for i, _ in enumerate(names)])
    d = _null_safe_join(d, totals, [*keys, "_b"])
    for i, n in enumerate(names):
        d = d.withColumn(n, F.col(f"_c{i}") + F.col(f"_l{i}"))
    return d.drop("_b", *[f"_{p}{i}" for i, _ in enumerate(names) for p in "vlc"])


def next_value(df: DataFrame, keys: Sequence[str], order: str, value: str, bucket: Column,
               out: str = "_next", tiebreak: str | None = None) -> DataFrame:
    """``lead(value)`` per key in ``(order, tiebreak)`` order (ascending, NULLs first),
    skew-safe: the last row of a bucket takes the first value of the key's next
    non-empty bucket (from a one-row-per-bucket table)."""
    keys = list(keys)
    tb = tiebreak or value
    d = df.withColumn("_b", F.coalesce(bucket, F.lit(-(2 ** 63)).cast("long")))
    w = Window.partitionBy(*keys, "_b").orderBy(F.col(order).asc_nulls_first(),
                                                 F.col(tb).asc_nulls_first())
    d = (d.withColumn("_in_next", F.lead(value).over(w))
         .withColumn("_has_next", F.lead(F.lit(1)).over(w).isNotNull()))
    firsts = d.groupBy(*keys, "_b").agg(
        F.min_by(F.col(value), F.struct(F.col(order), F.col(tb))).alias("_first"))
    wb = Window.partitionBy(*keys).orderBy("_b")
    firsts = firsts.select(*keys, "_b", F.lead("_first").over(wb).alias("_carry_next"))
    d = _null_safe_join(d, firsts, [*keys, "_b"])
    return (d.withColumn(out, F.when(F.col("_has_next"), F.col("_in_next"))
                         .otherwise(F.col("_carry_next")))
            .drop("_b", "_in_next", "_has_next", "_carry_next"))


def overlap_pairs(periods: DataFrame, keys: Sequence[str], start: str, end: str,
                  width: int | None = None, max_bucket_rows: int | None = None) -> DataFrame:
    """Count ordered pairs (a, b) of one key with ``a.start < b.end``, ``a.end > b.start``
    and ``a.start != b.start`` — the self-join metric — without forming pairs.

    Rows with a NULL key or bound never match (as in the join). Of a key's n * n pairs, those
    that miss a bound are #(b.end <= a.start) twice (once from either side), counted by one
    sorted sweep of its starts and ends (``running_sums``, bucketed by position slices of
    ``width``, dense slices cut finer when ``max_bucket_rows`` is set); pairs that miss both were
    taken off twice, so #(b.end <= a.start and a.end <= b.start) comes back. That needs a period
    of ``start >= end`` and is a dominance count (``dominated``). Pairs of equal starts meet both
    bounds if both have ``start < end``; their number is a square per start. One row: ``pairs``.
    """
    keys = list(keys)
    rows = periods.select(*keys, start, end)
    for c in (*keys, start, end):
        rows = rows.filter(F.col(c).isNotNull())

    def whole(c):
        return F.col(c).cast("decimal(38,0)")

    per_start = rows.groupBy(*keys, start).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(start) < F.col(end)).alias("_m"))
    per_key = per_start.groupBy(*keys).agg(
        F.sum("_n").alias("_n"), F.sum((whole("_m") * whole("_m")).cast("decimal(38,0)")).alias("_same"))
    squares = per_key.agg(F.sum((whole("_n") * whole("_n") - F.col("_same")).cast("decimal(38,0)")).alias("pairs"))

    # Two sweep points a period; at one position ends come before starts.
    points = F.array(F.struct(F.col(end).alias("_pos"), F.lit(1).cast("long").alias("_end")),
                     F.struct(F.col(start).alias("_pos"), F.lit(0).cast("long").alias("_end")))
    sweep = rows.select(*keys, F.explode(points).alias("_p")).select(*keys, "_p.*")
    sweep, b = _sliced(sweep, keys, "_pos", width, max_bucket_rows)
    sweep = running_sums(sweep, keys, [F.col("_pos"), F.col("_end").desc()], {"_ended": F.col("_end")}, b)
    missed = sweep.filter(F.col("_end") == 0).agg(
        (F.sum(whole("_ended")) * -2).cast("decimal(38,0)").alias("pairs"))
    out = squares.unionByName(missed)

    alike = rows.groupBy(*keys, start, end).agg(F.count(F.lit(1)).alias("_n"))
    odd = F.col(start) >= F.col(end)
    some = rows.filter(odd).select(*keys).distinct()
    n_keys = some.count()
    if n_keys:
        # Broadcast when few, so that no key's periods are dealt to one task to learn this.
        some = F.broadcast(some) if n_keys <= BROADCAST_MAX_DENSE else some
        mine = alike.join(some, keys, "left_semi")
        point = F.struct(F.col(end).alias("_x"), F.col(start).alias("_y"), F.lit(0).alias("_asks"),
                         (F.col("_n") * F.when(odd, 1).otherwise(2)).alias("_w"))
        query = F.struct(F.col(start).alias("_x"), F.col(end).alias("_y"), F.lit(1).alias("_asks"),
                         F.col("_n").alias("_w"))
        both = mine.select(*keys, F.explode(F.when(odd, F.array(point, query)).otherwise(F.array(point))).alias("_p"))
        out = out.unionByName(dominated(both.select(*keys, "_p.*"), keys, width, max_bucket_rows))
    return out.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("pairs"))


def _sliced(df: DataFrame, keys: Sequence[str], pos: str, width: int | None,
            max_bucket_rows: int | None) -> tuple[DataFrame, Column]:
    """``df`` and its bucket by slices of ``pos`` (dense ones cut finer, if bounded)."""
    if not max_bucket_rows:
        return df, bucket_for(df, pos, width)
    df = with_dense_slice_factor(df, keys, pos, width, max_bucket_rows)
    return df, bucket_for(df, pos, width, F.col(BUCKET_FACTOR))


# Digits of a rank, per level of the dominance count.
RADIX = 8


def dominated(rows: DataFrame, keys: Sequence[str], width: int | None = None,
              max_bucket_rows: int | None = None) -> DataFrame:
    """Two-dimensional dominance count: over queries (``_asks`` = 1) and points (0) of one key,
    the sum of query weight times point weight (``_w``) where the point has ``_x`` at most and
    ``_y`` at least the query's. One row: ``pairs``.

    Rows get their rank by ``_x`` and by ``_y`` within the key (two bucketed sweeps). A point
    is before a query by ``_x`` if, at the highest digit (base ``RADIX``) in which their ranks
    differ, its digit is smaller; so every row goes once per digit to the group of rows that
    share the digits above, and in each group one sweep by falling ``_y`` rank keeps a running
    weight per digit, of which a query takes the smaller ones. Rows times digits are shuffled,
    no pair is formed, and a group is cut into buckets of about as many rows as the
    largest key's / (2 * shuffle partitions), ``max_bucket_rows`` at most.
    """
    from lakeward.session import stored
    keys = list(keys)
    one = F.lit(1).cast("long")
    by_x, b = _sliced(rows, keys, "_x", width, max_bucket_rows)
    # At equal positions a point counts for the query: first by _x, last by _y.
    by_x = stored(running_sums(by_x, keys, [F.col("_x"), F.col("_asks")], {"_rx": one}, b)
                  .select(*keys, "_y", "_asks", "_w", "_rx"), "ranks")
    by_y, b = _sliced(by_x, keys, "_y", width, max_bucket_rows)
    ranked = stored(running_sums(by_y, keys, [F.col("_y"), F.col("_asks").desc()], {"_ry": one}, b)
                    .select(*keys, "_asks", "_w", "_rx", "_ry"), "ranks")
    largest = ranked.agg(F.max("_rx")).head()[0] or 0
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = min(max_bucket_rows or 1_000_000, max(MIN_SLICE_ROWS, largest // (2 * tasks)))
    levels, steps = 0, []
    while levels == 0 or RADIX ** levels <= largest:
        below, above = RADIX ** levels, RADIX ** (levels + 1)
        # A group's rows lie about largest / above ranks apart by _y.
        steps.append(F.struct(F.lit(levels).alias("_level"),
                              F.expr(f"_rx div {above}").alias("_group"),
                              (F.expr(f"_rx div {below}") % RADIX).cast("int").alias("_digit"),
                              (-F.expr(f"_ry div {size * max(1, -(-largest // above))}")).alias("_slot")))
        levels += 1
    every = ranked.select(*keys, "_asks", "_w", "_ry", F.explode(F.array(*steps)).alias("_s")).select(
        *keys, "_asks", "_w", "_ry", "_s.*")
    every = every.filter(F.when(F.col("_asks") == 1, F.col("_digit") > 0).otherwise(F.col("_digit") < RADIX - 1))
    held = {f"_d{d}": F.when((F.col("_asks") == 0) & (F.col("_digit") == d), F.col("_w")).otherwise(F.lit(0).cast("long"))
            for d in range(RADIX - 1)}
    swept = running_sums(every, [*keys, "_level", "_group"], [F.col("_ry").desc()], held, F.col("_slot"))
    less = F.lit(0).cast("decimal(38,0)")
    for d in range(RADIX - 1):
        less = less + F.when(F.col("_digit") > d, F.col(f"_d{d}")).otherwise(F.lit(0)).cast("decimal(20,0)")
    met = (less.cast("decimal(19,0)") * F.col("_w").cast("decimal(19,0)")).cast("decimal(38,0)")
    return swept.filter(F.col("_asks") == 1).agg(F.sum(met).cast("decimal(38,0)").alias("pairs"))
