"""Helpers shared by the operators of this package.

* ``ship`` sends a module's functions to Python workers by value, so that tasks need no
  copy of the package on the executors' import path.
* ``save`` cuts lineage with a table written in the shared work folder; within
  ``shuffles_removed`` its shuffle files go as soon as the table is written.
* ``sorted_groups`` walks Arrow batches that are sorted by key and yields one key's rows at
  a time (a group is only held as long as it is worked on).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.session import fresh_dir

#: Characters of [\x20\x09-\x0D], the white space of every contract of this package.
BLANKS = " \t\n\x0b\x0c\r"

#: Spark's setting that removes a query's shuffle files when the query ends.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(name: str) -> None:
    """Pickle the functions of module ``name`` by value for the workers."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared work folder and read it back."""
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.saved_at = path
    return table


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run in here remove their shuffle files when they end; otherwise these stay
    until the driver's garbage collector finds them, however many there are by then. For queries
    that run once: another run would have to shuffle again."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``save`` that nothing reads any more: what was made of them must be
    saved by now, since a lost executor's tasks read their input again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame) -> Column:
    """The text, with a null as the empty string."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def doc_id_of(docs: DataFrame) -> Column:
    return docs["doc_id"].cast("long")


def text_key(text: Column) -> Column:
    """16 bytes that tell texts apart (MD5 of the whole text)."""
    return F.unhex(F.md5(text.cast("binary")))


def repeat_rows(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``docs``, each row as often as ``copies`` (doc_id, sha, rows, copies) says: ``copies``
    in all for the ``rows`` rows alike in doc_id and text key; rows not named there go.
    All columns of ``docs`` come back, whatever their names."""
    told = copies.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"),
                         F.col("rows").alias("_rows"), F.col("copies").cast("int").alias("_copies"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                         doc_id_of(docs).alias("doc_id"), text_key(text_of(docs)).alias("sha"))
    met = packed.join(told.where("_copies > 0"),
                      F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")))
    one = met.where("_rows = 1").select("row", "_copies")
    many = met.where("_rows > 1").groupBy("_id", "_sha").agg(
        F.first("row").alias("row"), F.first("_copies").alias("_copies")).select("row", "_copies")
    every = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return one.unionByName(many).select("row", every).select("row.*")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by the keys into the session's number of shuffle partitions, sorted by them.
    The number is given, so that adaptive execution does not merge small partitions whose
    work is large."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of each key from batches sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_pylist() for i in range(keys)]
        names = list(zip(*cols)) if keys > 1 else cols[0]
        start = 0
        for i, key in enumerate(names):
            if held or i > start:
                if key != last:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield pa.Table.from_batches(held)
                    held, start = [], i
            last = key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


ship(__name__)
