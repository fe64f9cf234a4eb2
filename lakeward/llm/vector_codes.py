"""Vector codes by product quantization, trained by active-entry Lloyd rounds (operator 13).

Components become integers floor(SCALE * x); a vector is cut into ``PARTS`` equal parts, and each
part position has a codebook that starts as that part of the ``ENTRIES`` smallest kept vec_ids.
A round assigns every part to its nearest entry and moves each entry to the floor of its parts'
mean; after the last round parts are assigned once more.

Active entries: every row stores its parts' entries and exact distances. After an update only some
entries have moved. A part whose own entry stayed keeps its stored distance and is compared with
the moved entries alone, taking one that is nearer, or as near with a lower index; a part whose
entry moved rescans the whole codebook. Both give the entry that a full scan would.

Rows with their state are a table written anew each round (components as narrow as the table's
largest allows); no row is shuffled. Each task reduces its rows to one sum per (part, entry), of
which at most PARTS * ENTRIES per task meet; codebooks (PARTS * ENTRIES entries) are the only
thing the driver holds.

Defined results: rows whose vector is null or has a null or non-finite component are dropped;
fewer kept rows than ENTRIES give as many entries; a null vec_id comes after all others and rows
of one vec_id by their components; repeated rows count each; a vector shorter than the longest,
or a length that PARTS does not divide, is filled with zeros at its end; a component whose
distances would not fit a long counts as the largest that does; entries that no part uses stay;
an empty table gives an empty result. Extra columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import save, ship

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Rows of a batch worked on at a time.
STEP = 4096
LARGEST = 2**63 - 1
_STATE = "vec_id long, label long, x binary, code binary, far binary"
_FIELDS = ["vec_id", "label", "x", "code", "far"]


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding (array of doubles) of rows that are kept."""
    x = vectors["embedding"].cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    good = x.isNotNull() & ~F.coalesce(F.exists(x, odd), F.lit(False))
    return vectors.where(good).select(vectors["vec_id"].cast("long").alias("vec_id"),
                                      vectors["label"].cast("long").alias("label"), x.alias("embedding"))


def shape(rows: DataFrame) -> tuple[int, int]:
    """Components of a vector (a multiple of PARTS) and the largest absolute integer component."""
    x = F.col("embedding")
    big = F.greatest(F.abs(F.floor(F.array_max(x) * SCALE).cast("double")), F.abs(F.floor(F.array_min(x) * SCALE).cast("double")))
    got = rows.select(F.size(x).alias("n"), F.when(F.size(x) > 0, big).alias("big")).agg(
        F.max("n").alias("n"), F.max("big").alias("big")).head()
    width = -(-(got["n"] or 0) // PARTS)
    limit = int((2**63 // max(4 * width, 1)) ** 0.5) - 1
    return width * PARTS, int(min(got["big"] or 0, limit))


def width_of(limit: int) -> type:
    """The narrowest type of integer components."""
    return next(t for t in (np.int8, np.int16, np.int32, np.int64) if limit <= np.iinfo(t).max)


def integers(vectors: list, size: int, limit: int) -> np.ndarray:
    """Integer components (rows x size) of lists of finite numbers."""
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * SCALE), -limit, limit).astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray, exact: bool) -> np.ndarray:
    """Squared distances (rows x entries), as integers. Products of floats are exact below 2^53
    (``exact``); beyond, entries are taken one by one."""
    if exact:
        x, entries = x.astype(np.float64), entries.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]).astype(np.int64)
    out = np.empty((len(x), len(entries)), np.int64)
    for k, e in enumerate(entries):
        gap = x - e
        out[:, k] = (gap * gap).sum(1)
    return out


def assign(x: np.ndarray, codebook: np.ndarray, code: np.ndarray | None, far: np.ndarray | None, moved: np.ndarray,
           exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Entry and distance of one part of rows, given the last ones (None at first) and which
    entries moved since."""
    if code is None:
        code, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        rescan = np.ones(len(x), bool)
    else:
        code, far, rescan = code.copy(), far.copy(), moved[code]
    if rescan.any():
        d = distances(x[rescan], codebook, exact)
        best = d.argmin(1)  # the first of equal ones
        code[rescan], far[rescan] = best, d[np.arange(len(d)), best]
    active = np.flatnonzero(moved)
    stayed = np.flatnonzero(~rescan)
    if len(active) and len(stayed):
        d = distances(x[stayed], codebook[active], exact)
        first = d.argmin(1)
        near, entry = d[np.arange(len(d)), first], active[first]
        better = (near < far[stayed]) | ((near == far[stayed]) & (entry < code[stayed]))
        code[stayed[better]], far[stayed[better]] = entry[better], near[better]
    return code, far


def _read(batch, size: int, kind: type):
    """Components, entries and distances of a batch of state rows."""
    n = batch.num_rows
    joined = lambda i, t: np.frombuffer(b"".join(batch.column(i).to_pylist()), t)
    return (joined(2, kind).reshape(n, size).astype(np.int64), joined(3, np.uint16).reshape(n, PARTS).astype(np.int64),
            joined(4, np.int64).reshape(n, PARTS))


def _write(vec_id, label, x, code, far) -> pa.RecordBatch:
    held = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
    return pa.RecordBatch.from_arrays([vec_id, label, x, held(code.astype(np.uint16)), held(far)], _FIELDS)


def _steps(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            yield batch.slice(at, STEP)


class Training:
    """Codebooks (PARTS arrays of entries x components) and which entries moved last, as every
    task gets them."""

    def __init__(self, books: list[np.ndarray], size: int, limit: int):
        self.books, self.size, self.limit, self.kind = books, size, limit, width_of(limit)
        self.exact = size // PARTS * 4 * limit * limit < 2**53
        self.moved = [np.ones(len(b), bool) for b in books]

    def scan(self, x, code=None, far=None):
        n = self.size // PARTS
        got = [assign(x[:, p * n:(p + 1) * n], self.books[p], None if code is None else code[:, p],
                      None if far is None else far[:, p], self.moved[p], self.exact) for p in range(PARTS)]
        return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)

    def first(self, rows: DataFrame) -> DataFrame:
        """State rows of kept rows, with their first assignment."""
        def work(batches):
            for batch in _steps(batches):
                x = integers(batch.column(2).to_pylist(), self.size, self.limit)
                own = pa.array([r.tobytes() for r in x.astype(self.kind)], pa.binary())
                yield _write(batch.column(0), batch.column(1), own, *self.scan(x))
        return rows.select("vec_id", "label", "embedding").mapInArrow(work, _STATE)

    def again(self, state: DataFrame) -> DataFrame:
        """State rows after codebooks have moved."""
        def work(batches):
            for batch in _steps(batches):
                x, code, far = _read(batch, self.size, self.kind)
                yield _write(batch.column(0), batch.column(1), batch.column(2), *self.scan(x, code, far))
        return state.select(*_FIELDS).mapInArrow(work, _STATE)

    def sums(self, state: DataFrame) -> DataFrame:
        """part, entry, n, total (array): one row for each entry in use."""
        parts, entries, size, kind = PARTS, len(self.books[0]), self.size, self.kind
        n = size // parts

        def work(batches):
            total, count = np.zeros((parts, entries, n), np.int64), np.zeros((parts, entries), np.int64)
            for batch in _steps(batches):
                x, code, _ = _read(batch, size, kind)
                for p in range(parts):
                    order = np.argsort(code[:, p], kind="stable")
                    used, at = np.unique(code[order, p], return_index=True)
                    count[p] += np.bincount(code[:, p], minlength=entries)
                    if n:
                        total[p, used] += np.add.reduceat(x[order, p * n:(p + 1) * n], at, axis=0)
            p, e = np.nonzero(count)
            if len(p):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]),
                     pa.array([total[i, j].tolist() for i, j in zip(p, e)], pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

        some = state.select(*_FIELDS).mapInArrow(work, "part int, entry int, n long, total array<long>")
        sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(n)]
        return some.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums)

    def move(self, state: DataFrame) -> None:
        """Codebooks after one update (at most PARTS * ENTRIES rows come to the driver)."""
        new, n = [b.copy() for b in self.books], self.size // PARTS
        for r in self.sums(state).collect():
            new[r["part"]][r["entry"]] = [int(r[f"t{i}"]) // r["n"] for i in range(n)]
        self.moved = [(a != b).any(1) for a, b in zip(self.books, new)]
        self.books = new


def train(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[Training | None, DataFrame | None]:
    """The trained codebooks and the table of state rows of ``rows`` (of ``kept``)."""
    size, limit = shape(rows)
    # Copies of one row alike in all take a place each; ``entries`` rows come to the driver.
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.col("embedding").asc()).limit(entries).collect()
    if not start:
        return None, None
    x = integers([r["embedding"] for r in start], size, limit)
    n = size // PARTS
    training = Training([x[:, p * n:(p + 1) * n] for p in range(PARTS)], size, limit)
    state = save(training.first(rows), "codes")
    for _ in range(rounds):
        training.move(state)
        state = save(training.again(state), "codes")
    return training, state


def codebook_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code (hex), error, label_error, codebooks_sha256."""
    training, state = train(save(kept(vectors), "vectors"))
    if training is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")

    def work(batches):
        for batch in batches:
            far = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.int64).reshape(-1, PARTS)
            codes = [np.frombuffer(c, np.uint16).astype(np.uint8).tobytes().hex() for c in batch.column(3).to_pylist()]
            total = [min(sum(r), LARGEST) for r in far.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes), pa.array(total, pa.int64())],
                                             ["vec_id", "label", "code", "error"])

    rows = save(state.select(*_FIELDS).mapInArrow(work, "vec_id long, label long, code string, error long"), "coded")
    labels = save(rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")).select(
        F.col("label").alias("_label"), F.least("total", F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error")), "labels")
    return rows.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(training.books)).alias("codebooks_sha256"))


def op13_vector_codes(spark, sf_dir):
    """Query: codes of all embeddings."""
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int = ROUNDS) -> str:
    """DuckDB SQL for op13: every round scans all entries."""
    width = "(len(x) // 4)"
    steps = ["""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS no, vec_id, label,
         list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)""", f"""
cut AS MATERIALIZED (
  SELECT no, vec_id, label, p, x[{width} * p + 1 : {width} * (p + 1)] AS x FROM kept, range(4) t(p))""", """
book0 AS MATERIALIZED (SELECT p, no - 1 AS e, x AS c FROM cut WHERE no <= 256)"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT no, p, min({{'d': list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c), 'e': e}}) AS b
  FROM cut JOIN book{r} USING (p) GROUP BY no, p)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(v) / count(*)) AS m
    FROM (SELECT cut.p, b.e AS e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM cut JOIN near{r} USING (no, p))
    GROUP BY p, e, i) GROUP BY p, e)""")
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (p, e))""")
    return "WITH " + ",".join(steps) + f""",
coded AS (
  SELECT k.vec_id, k.label, string_agg(lower(printf('%02x', b.e)), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error
  FROM near{rounds} JOIN kept k USING (no) GROUP BY no, k.vec_id, k.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda v: v::BIGINT), ','), ',' ORDER BY p, e)) FROM book{rounds})
       AS codebooks_sha256
FROM coded"""


SQL = _sql()

ship(__name__)
