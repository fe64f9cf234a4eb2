"""Every operator of the library applied to the driver's tables, with an equivalent
DuckDB SQL string for each (the correctness oracle).

Each query reads whole driver tables (``{sf_dir}/{table}.parquet``), so its work grows
with the data. Where a check would be vacuous on clean driver data, faults are injected
by the same formula on both sides (for example a NULL whenever ``key % 10 = 0``). Clock
columns (load stamps) are left out or fixed; doubles are compared as exact values of
the same IEEE operations, decimals as decimals.

Keys follow SURVEY §7.3; docstrings name the operator IDs each query exercises.
"""

from __future__ import annotations

import re
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import cleanse as C
from lakeward.operators import audit as A
from lakeward.operators import checks as K
from lakeward.operators import dims as D
from lakeward.operators import facts as FA
from lakeward.operators.expectations import expect, rule_metrics
from lakeward.operators.scd2 import (closed_rows, current_rows, reference_overlaps, scd2_history,
                                     split_counts, strict_overlaps)
from lakeward.plans import model_queries as M
from lakeward.session import fresh_dir
from lakeward.sources import tables as TB
from lakeward.sources import tsv as S
from lakeward.specs import DROP, WARN, Rule
from lakeward.streaming.runner import load_tables
from lakeward.streaming.scd2_stream import Scd2Writer, read_dimension

# FIXED VALUES used by the oracle comparisons (both sides use the same literals).
AS_OF = "2024-01-31 00:00:00"
CHECK_TS = "2024-02-01 00:00:00"
LOOKUP_ROWS = [("EN", "English"), ("de", "German"), ("fr", "French"), ("FR", "Francais"),
               ("it", "Italian")]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------------------
# Sources: raw TSV ingest, schema evolution, lineage (SRC-01..06, SNK-01, STR-02)
# ---------------------------------------------------------------------------------------

def _orders_raw(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(k % 5 == 0, F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"')))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


ORDERS_RAW_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                      "o_orderpriority"]


@query("ingest_tsv", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderkey % 5 = 0 THEN '"' || o_orderstatus || '"' ELSE o_orderstatus END AS o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def q_ingest_tsv(spark, sf):
    """SRC-01..04, SRC-06, SNK-01, STR-02: orders written as raw TSV (``\\N`` NULLs, literal
    quotes) and ingested incrementally back into an append-only table."""
    root = fresh_dir(spark, "ingest_tsv")
    S.write_tsv(_orders_raw(_t(spark, sf, "orders")), f"{root}/raw/orders")
    S.ingest_stream(spark, f"{root}/raw/orders", f"{root}/bronze/orders",
                    f"{root}/_checkpoints/orders", expected=ORDERS_RAW_COLUMNS,
                    glob="part-*").awaitTermination()
    return S.read_ingested(spark, f"{root}/bronze/orders").select(*ORDERS_RAW_COLUMNS)


@query("ingest_lone_cr", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, replace(o_orderpriority, '-', chr(13)) AS o_orderpriority,
       chr(13) || o_orderstatus AS o_orderstatus
FROM orders""")
def q_ingest_lone_cr(spark, sf):
    """SRC-03: raw files whose fields hold a lone carriage return, ingested as a multi-line set:
    it ends no record. Files stay splittable."""
    root, columns = fresh_dir(spark, "ingest_lone_cr"), ["o_orderkey", "o_orderpriority", "o_orderstatus"]
    rows = _t(spark, sf, "orders").select(
        (F.col("o_orderkey") % 4).alias("file"), F.lit(1).alias("line"),
        F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.replace("o_orderpriority", F.lit("-"), F.lit("\r")),
                    F.concat(F.lit("\r"), "o_orderstatus")).alias("value"))
    heads = spark.range(4).select(F.col("id").alias("file"), F.lit(0).alias("line"), F.lit("\t".join(columns)).alias("value"))
    (rows.unionByName(heads).repartition("file").sortWithinPartitions("file", "line")
     .select("file", "value").write.partitionBy("file").text(f"{root}/raw/orders"))
    S.ingest_stream(spark, f"{root}/raw/orders", f"{root}/bronze/orders", f"{root}/_checkpoints/orders",
                    multiline=True, expected=columns, glob="part-*").awaitTermination()
    return S.read_ingested(spark, f"{root}/bronze/orders").select(*columns)


CUSTOMER_A = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_B = ["c_mktsegment", "c_name", "c_custkey", "c_acctbal", "c_nationkey", "c_phone"]


def _evolving_customer(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer")
    txt = c.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
                   F.col("c_nationkey").cast("string").alias("c_nationkey"),
                   F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
                   "c_mktsegment",
                   F.concat(F.lit("phone-"), F.col("c_custkey")).alias("c_phone"),
                   (F.col("c_custkey") % 2).alias("_shape"))
    root = fresh_dir(spark, "schema_evolution")
    S.write_tsv(txt.filter("_shape = 0").select(*CUSTOMER_A), f"{root}/raw/customer/shape_a")
    S.write_tsv(txt.filter("_shape = 1").select(*CUSTOMER_B), f"{root}/raw/customer/shape_b")
    S.ingest_stream(spark, f"{root}/raw/customer", f"{root}/bronze/customer",
                    f"{root}/_checkpoints/customer", expected=CUSTOMER_A,
                    glob="part-*").awaitTermination()
    return S.read_ingested(spark, f"{root}/bronze/customer")


@query("schema_evolution", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 2 = 1 THEN 'phone-' || CAST(c_custkey AS VARCHAR) END AS c_phone
FROM customer""")
def q_schema_evolution(spark, sf):
    """SRC-05: two file shapes (reordered header + a new column) mapped by column name."""
    return _evolving_customer(spark, sf).select(*CUSTOMER_A, "c_phone")


@query("lineage_files", """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'shape_a' ELSE 'shape_b' END AS source_folder,
       count(*) AS row_count
FROM customer GROUP BY 1""")
def q_lineage_files(spark, sf):
    """SRC-06: rows per source folder from the ``_source_file`` lineage column."""
    b = _evolving_customer(spark, sf)
    return (b.groupBy(F.regexp_extract(S.SOURCE_FILE, r"/(shape_[a-z]+)/[^/]+$", 1)
                      .alias("source_folder"))
            .agg(F.count(F.lit(1)).alias("row_count")))


# ---------------------------------------------------------------------------------------
# Projections (PRJ-*, FN-*)
# ---------------------------------------------------------------------------------------

_GUARD_TEXT_SQL = """CASE event_id % 6
           WHEN 0 THEN regexp_extract(props, '[0-9]+')
           WHEN 1 THEN CAST(event_id AS VARCHAR)
           WHEN 2 THEN regexp_extract(props, '[0-9]+') || '99999999999'
           WHEN 3 THEN '-' || regexp_extract(props, '[0-9]+')
           WHEN 4 THEN regexp_extract(props, '[0-9]+') || 'x'
           ELSE lpad(regexp_extract(props, '[0-9]+'), 4, '0') END"""


@query("guarded_int", f"""
WITH t AS (SELECT event_id, {_GUARD_TEXT_SQL} AS raw FROM events)
SELECT event_id, raw,
       CASE WHEN regexp_matches(raw, '^[0-9]{{1,4}}$') THEN TRY_CAST(raw AS INTEGER) END AS year_1_4,
       CASE WHEN regexp_matches(raw, '^[0-9]{{4}}$') THEN TRY_CAST(raw AS INTEGER) END AS year_4,
       CASE WHEN regexp_matches(raw, '^[0-9]+$') THEN TRY_CAST(raw AS INTEGER) END AS any_digits
FROM t""")
def q_guarded_int(spark, sf):
    """PRJ-03..05: pattern-guarded integer casts (incl. beyond-int digit strings)."""
    e = _t(spark, sf, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1)
    m = F.col("event_id") % 6
    raw = (F.when(m == 0, k).when(m == 1, F.col("event_id").cast("string"))
           .when(m == 2, F.concat(k, F.lit("99999999999"))).when(m == 3, F.concat(F.lit("-"), k))
           .when(m == 4, F.concat(k, F.lit("x"))).otherwise(F.lpad(k, 4, "0")))
    t = e.select("event_id", raw.alias("raw"))
    return t.select("event_id", "raw",
                    C.guarded_int("raw", C.YEAR_1_TO_4_DIGITS).alias("year_1_4"),
                    C.guarded_int("raw", C.YEAR_4_DIGITS).alias("year_4"),
                    C.guarded_int("raw", C.DIGITS).alias("any_digits"))


@query("try_casts", """
WITH t AS (
  SELECT o_orderkey,
         CASE o_orderkey % 10 WHEN 0 THEN 'abc' WHEN 1 THEN '5.7' WHEN 2 THEN NULL
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS rating_text,
         CASE o_orderkey % 10 WHEN 1 THEN '5.7' WHEN 3 THEN '99999999999' WHEN 4 THEN 'x'
              ELSE CAST(o_custkey AS VARCHAR) END AS votes_text
  FROM orders)
SELECT o_orderkey, TRY_CAST(rating_text AS DOUBLE) AS average_rating,
       CASE WHEN regexp_matches(votes_text, '^[+-]?[0-9]+$') THEN TRY_CAST(votes_text AS INTEGER) END AS num_votes
FROM t""")
def q_try_casts(spark, sf):
    """PRJ-06/07: unguarded casts of bad text give NULL (``try_cast``)."""
    o = _t(spark, sf, "orders")
    m = F.col("o_orderkey") % 10
    rating = (F.when(m == 0, F.lit("abc")).when(m == 1, F.lit("5.7")).when(m == 2, F.lit(None))
              .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    votes = (F.when(m == 1, F.lit("5.7")).when(m == 3, F.lit("99999999999")).when(m == 4, F.lit("x"))
             .otherwise(F.col("o_custkey").cast("string")))
    return o.select("o_orderkey", C.to_double(rating).alias("average_rating"),
                    C.to_int(votes).alias("num_votes"))


@query("bool_flag", """
SELECT l_orderkey, l_linenumber, flag_text, COALESCE(flag_text = 'R', false) AS is_returned
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN NULL ELSE l_returnflag END AS flag_text
      FROM lineitem)""")
def q_bool_flag(spark, sf):
    """PRJ-08: ``'R'`` -> true; anything else including NULL -> false."""
    li = _t(spark, sf, "lineitem")
    ft = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 9 == 0, F.lit(None)) \
          .otherwise(F.col("l_returnflag"))
    return li.select("l_orderkey", "l_linenumber", ft.alias("flag_text")) \
             .withColumn("is_returned", C.flag("flag_text", "R"))


@query("split_list", """
WITH t AS (
  SELECT p_partkey,
         CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' '
              WHEN 3 THEN replace(p_name, ' ', ',') || ','
              ELSE replace(p_name, ' ', ',') END AS list_text
  FROM part),
a AS (SELECT p_partkey,
             CASE WHEN list_text IS NOT NULL AND list_text <> '' THEN string_split(trim(list_text), ',') END AS items
      FROM t)
SELECT p_partkey, CAST(len(items) AS BIGINT) AS item_count, array_to_string(items, '|') AS joined
FROM a""")
def q_split_list(spark, sf):
    """PRJ-09, FN-05/07/08: comma list -> array (NULL/empty -> NULL, ' ' -> [''])."""
    p = _t(spark, sf, "part")
    m = F.col("p_partkey") % 10
    commas = F.regexp_replace("p_name", " ", ",")
    lt = (F.when(m == 0, F.lit(None)).when(m == 1, F.lit("")).when(m == 2, F.lit(" "))
          .when(m == 3, F.concat(commas, F.lit(","))).otherwise(commas))
    a = p.select("p_partkey", C.split_list(lt).alias("items"))
    return a.select("p_partkey", C.count_items("items").cast("long").alias("item_count"),
                    C.joined("items", "|").alias("joined"))


@query("code_case", """
SELECT doc_id, upper(trim('  ' || lang || ' ')) AS region_code,
       lower(trim(' ' || upper(source) || '  ')) AS language_code,
       trim('   ' || source) AS source_text
FROM documents""")
def q_code_case(spark, sf):
    """PRJ-02/10/11, FN-01/02: trimmed upper/lower-case codes."""
    d = _t(spark, sf, "documents")
    return d.select("doc_id",
                    C.upper_code(F.concat(F.lit("  "), "lang", F.lit(" "))).alias("region_code"),
                    C.lower_code(F.concat(F.lit(" "), F.upper("source"), F.lit("  ")))
                    .alias("language_code"),
                    C.text(F.concat(F.lit("   "), "source")).alias("source_text"))


@query("strip_brackets", """
WITH t AS (
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN '["' || event_type || '"]'
              WHEN 1 THEN '["' || event_type || '","' || props || '"]'
              WHEN 2 THEN props ELSE ' ["x"] ' END AS raw
  FROM events)
SELECT event_id, regexp_replace(regexp_replace(trim(raw), '^\\["', ''), '"\\]$', '') AS characters
FROM t""")
def q_strip_brackets(spark, sf):
    """PRJ-12, FN-03: strip a leading ``["`` and a trailing ``"]`` only."""
    e = _t(spark, sf, "events")
    m = F.col("event_id") % 4
    raw = (F.when(m == 0, F.concat(F.lit('["'), "event_type", F.lit('"]')))
           .when(m == 1, F.concat(F.lit('["'), "event_type", F.lit('","'), "props", F.lit('"]')))
           .when(m == 2, F.col("props")).otherwise(F.lit(' ["x"] ')))
    return e.select("event_id", C.strip_brackets(raw).alias("characters"))


# ---------------------------------------------------------------------------------------
# Expectations (EXP-01..03, FLT-01..08)
# ---------------------------------------------------------------------------------------

CUSTOMER_WARN = [Rule("valid_balance", "c_acctbal > 0", WARN),
                 Rule("valid_name", "c_name IS NOT NULL AND c_name LIKE 'Customer#%'", WARN)]


@query("expect_warn", "SELECT * FROM customer")
def q_expect_warn(spark, sf):
    """EXP-01: warn rules count violations and keep every row."""
    return expect(_t(spark, sf, "customer"), CUSTOMER_WARN, observation="customer_warn")


ORDER_RULES = [
    Rule("valid_customer", "o_custkey IS NOT NULL", DROP),
    Rule("valid_price", "o_totalprice >= 1000.0", DROP),
    Rule("valid_status", "o_orderstatus IN ('O', 'F')", DROP),
    Rule("valid_priority", "o_orderpriority RLIKE '^[0-9]-'", DROP),
    Rule("price_below_cap", "o_totalprice < 400000.0", WARN),
]

_ORDERS_INJECTED_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders"""


def _orders_injected(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey",
                    F.when(k % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
                    "o_orderstatus",
                    F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice"))
                    .alias("o_totalprice"),
                    "o_orderdate",
                    F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
                    .alias("o_orderpriority"))


_ORDERS_KEEP_SQL = """COALESCE(o_custkey IS NOT NULL, false) AND COALESCE(o_totalprice >= 1000.0, false)
  AND COALESCE(o_orderstatus IN ('O', 'F'), false) AND COALESCE(regexp_matches(o_orderpriority, '^[0-9]-'), false)"""


@query("expect_drop", f"""
SELECT * FROM ({_ORDERS_INJECTED_SQL}) t
WHERE {_ORDERS_KEEP_SQL}""")
def q_expect_drop(spark, sf):
    """EXP-02/03, FLT-01..05: stacked drop rules, NULL predicate = violation, a row failing
    several rules is dropped once; metrics observed on the same pass."""
    return expect(_orders_injected(spark, sf), ORDER_RULES, observation="orders_rules")


def _metric_sql(rule: str, action: str, pred: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{action}' AS action, "
            f"count(*) FILTER (WHERE COALESCE({pred}, false)) AS passed, "
            f"count(*) FILTER (WHERE NOT COALESCE({pred}, false)) AS failed FROM t")


@query("expect_metrics", f"""
WITH t AS ({_ORDERS_INJECTED_SQL})
{_metric_sql('valid_customer', 'drop', 'o_custkey IS NOT NULL')}
UNION ALL {_metric_sql('valid_price', 'drop', 'o_totalprice >= 1000.0')}
UNION ALL {_metric_sql('valid_status', 'drop', "o_orderstatus IN ('O', 'F')")}
UNION ALL {_metric_sql('valid_priority', 'drop', "regexp_matches(o_orderpriority, '^[0-9]-')")}
UNION ALL {_metric_sql('price_below_cap', 'warn', 'o_totalprice < 400000.0')}""")
def q_expect_metrics(spark, sf):
    """EXP-01..03: per-rule passed/failed counts in one aggregate pass."""
    return rule_metrics(_orders_injected(spark, sf), ORDER_RULES)


LINEITEM_FILTERS = [
    Rule("flag_in_list", "l_returnflag IN ('R', 'A')"),
    Rule("quantity_between", "l_quantity BETWEEN 10 AND 40"),
    Rule("status_prefix", "l_linestatus LIKE 'O%'"),
    Rule("key_length", "LENGTH(CAST(l_orderkey AS STRING)) BETWEEN 2 AND 4"),
    Rule("flag_status_regex", "concat(l_returnflag, l_linestatus) RLIKE '^[AR][OF]$'"),
    Rule("tax_below_discount", "l_tax < l_discount"),
    Rule("ship_not_null", "l_shipdate IS NOT NULL"),
]


@query("enum_range_rules", f"""
WITH t AS (SELECT * FROM lineitem)
{_metric_sql('flag_in_list', 'warn', "l_returnflag IN ('R', 'A')")}
UNION ALL {_metric_sql('quantity_between', 'warn', 'l_quantity BETWEEN 10 AND 40')}
UNION ALL {_metric_sql('status_prefix', 'warn', "l_linestatus LIKE 'O%'")}
UNION ALL {_metric_sql('key_length', 'warn', 'length(CAST(l_orderkey AS VARCHAR)) BETWEEN 2 AND 4')}
UNION ALL {_metric_sql('flag_status_regex', 'warn', "regexp_matches(l_returnflag || l_linestatus, '^[AR][OF]$')")}
UNION ALL {_metric_sql('tax_below_discount', 'warn', 'l_tax < l_discount')}
UNION ALL {_metric_sql('ship_not_null', 'warn', 'l_shipdate IS NOT NULL')}""")
def q_enum_range_rules(spark, sf):
    """FLT-01..08: membership, range, prefix, length, regex and cross-column predicates."""
    return rule_metrics(_t(spark, sf, "lineitem"), LINEITEM_FILTERS)


# ---------------------------------------------------------------------------------------
# Dimensions, bridge, facts (GD-03..13, JN-01, AGG-09/10)
# ---------------------------------------------------------------------------------------

@query("dim_pass_through", """
SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand, p_type AS part_type,
       p_size AS size, p_retailprice AS retail_price, 'part' AS source_file
FROM part""")
def q_dim_pass_through(spark, sf):
    """GD-03: renamed pass-through with a source tag."""
    return D.renamed(_t(spark, sf, "part"), {
        "part_key": "p_partkey", "part_name": "p_name", "brand": "p_brand",
        "part_type": "p_type", "size": "p_size", "retail_price": "p_retailprice"},
        {"source_file": "part"})


@query("fact_pass_through", """
SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS total_price,
       o_orderpriority AS priority, 'orders' AS source_file, 'dlt_pipeline' AS loaded_by
FROM orders""")
def q_fact_pass_through(spark, sf):
    """GD-11/12: fact pass-through with load metadata."""
    return FA.fact(_t(spark, sf, "orders"), {
        "order_key": "o_orderkey", "customer_key": "o_custkey", "total_price": "o_totalprice",
        "priority": "o_orderpriority"}, {"source_file": "orders", "loaded_by": "dlt_pipeline"})


_WORDS_SQL = """SELECT p_partkey, unnest(string_split(trim(p_name), ' ')) AS w
  FROM part WHERE p_name IS NOT NULL AND p_name <> ''"""


def _part_words(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    return p.select("p_partkey", C.split_list("p_name", " ").alias("words"))


@query("dim_exploded", f"""
SELECT DISTINCT trim(w) AS genre_key, trim(w) AS genre_name
FROM ({_WORDS_SQL}) t WHERE w IS NOT NULL""")
def q_dim_exploded(spark, sf):
    """GD-04, FN-06: exploded, trimmed, de-duplicated list items."""
    return D.exploded_dimension(_part_words(spark, sf), "words", "genre_key", "genre_name")


@query("bridge_exploded", f"""
SELECT p_partkey, trim(w) AS genre_key, false AS is_primary_genre
FROM ({_WORDS_SQL}) t WHERE w IS NOT NULL""")
def q_bridge_exploded(spark, sf):
    """GD-10: one row per (parent, item), not de-duplicated."""
    return FA.bridge(_part_words(spark, sf), "p_partkey", "words", "genre_key")


EVENT_GROUPS = [(["view", "click"], "browse"), (["purchase"], "commerce"), (["signup"], "account")]


@query("dim_mapped", """
SELECT DISTINCT trim(event_type) AS category_key, event_type AS category_name,
       CASE WHEN event_type IN ('view', 'click') THEN 'browse'
            WHEN event_type IN ('purchase') THEN 'commerce'
            WHEN event_type IN ('signup') THEN 'account' ELSE 'other' END AS department
FROM events WHERE event_type IS NOT NULL""")
def q_dim_mapped(spark, sf):
    """GD-05, FN-12: distinct values with a mapped group label."""
    return D.mapped_dimension(_t(spark, sf, "events"), "event_type", "category_key",
                              "category_name", "department", EVENT_GROUPS, "other")


@query("dim_composite", """
SELECT DISTINCT l_returnflag || '_' || status AS job_key, trim(l_returnflag) AS category_key,
       status AS job_name, status AS job_description
FROM (SELECT l_returnflag, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_linestatus END AS status
      FROM lineitem) t
WHERE status IS NOT NULL""")
def q_dim_composite(spark, sf):
    """GD-06, FN-09: non-NULL child values keyed ``parent_child``."""
    li = _t(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_orderkey") % 5 == 0, F.lit(None))
        .otherwise(F.col("l_linestatus")).alias("status"))
    return D.composite_dimension(li, "l_returnflag", "status", "job_key", "category_key",
                                 "job_name", "job_description")


def _lookup_sql() -> str:
    vals = ", ".join(f"('{c}', '{n}')" for c, n in LOOKUP_ROWS)
    return f"(VALUES {vals}) AS l(code, name)"


def _coded(spark, sf) -> DataFrame:
    root = fresh_dir(spark, "lookup")
    (spark.createDataFrame(LOOKUP_ROWS, "code string, name string")
     .write.option("header", "true").csv(f"{root}/languages"))
    lookup = TB.read_lookup_csv(spark, f"{root}/languages", ["code", "name"])
    docs = _t(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 3 == 0, F.upper("lang")).otherwise(F.col("lang")).alias("lang"))
    return D.coded_dimension(docs, "lang", lookup, "code", "name", "region_key", "region_code",
                             "region_name")


_CODED_SQL = f"""
WITH codes AS (SELECT DISTINCT trim(CASE WHEN doc_id % 3 = 0 THEN upper(lang) ELSE lang END) AS region_key
               FROM documents WHERE lang IS NOT NULL),
ref AS (SELECT lower(code) AS ref_code, min(name) AS ref_name FROM {_lookup_sql()} GROUP BY 1)
SELECT region_key, region_key AS region_code, COALESCE(ref_name, region_key) AS region_name
FROM codes LEFT JOIN ref ON lower(region_key) = ref_code"""


@query("dim_coded", _CODED_SQL)
def q_dim_coded(spark, sf):
    """GD-07/08, JN-01, SRC-10, AGG-10: codes named from a CSV lookup (case-insensitive,
    duplicate codes -> smallest name, missing code -> itself)."""
    return _coded(spark, sf)


@query("alt_key", """
SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS alternate_key,
       conv_id, trim(role) AS role_key, text AS localized_text, turn AS ordering
FROM conversations""")
def q_alt_key(spark, sf):
    """GD-09: ``parent_ordering`` key, trimmed foreign key, whole texts carried."""
    return D.alternates(_t(spark, sf, "conversations"), "conv_id", "turn", "alternate_key",
                        [("conv_id", "conv_id"), ("role_key", F.trim("role")),
                         ("localized_text", "text"), ("ordering", "turn")])


@query("fact_null_safe_key", """
SELECT l_orderkey, l_partkey, trim(l_returnflag) AS category_key,
       l_returnflag || '_' || COALESCE(status, '') AS job_key, l_linenumber
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linestatus END AS status
      FROM lineitem) t""")
def q_fact_null_safe_key(spark, sf):
    """GD-13, FN-11: NULL-safe composite key ``category_`` for a NULL job."""
    li = _t(spark, sf, "lineitem").withColumn(
        "status", F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(F.col("l_linestatus")))
    return FA.credits_fact(li, "l_orderkey", "l_partkey", "l_returnflag", "status", "l_linenumber")


# ---------------------------------------------------------------------------------------
# Type-2 dimension (SCD-01..04, QA-21/22, JN-05)
# ---------------------------------------------------------------------------------------

_SCD_SQL = """
WITH s AS (SELECT user_id, ts, event_type, event_id, value, props,
                  LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev_t,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM events),
f AS (SELECT *, CASE WHEN rn = 1 OR prev_t IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS chg FROM s),
v AS (SELECT *, SUM(chg) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS ver FROM f),
l AS (SELECT *, MIN(ts) OVER (PARTITION BY user_id, ver) AS start_at,
             ROW_NUMBER() OVER (PARTITION BY user_id, ver ORDER BY ts DESC) AS rdesc FROM v)
SELECT user_id, ts, event_type, event_id, value, props, start_at AS "__START_AT",
       LEAD(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS "__END_AT"
FROM l WHERE rdesc = 1"""

SCD_COLUMNS = ["user_id", "ts", "event_type", "event_id", "value", "props"]


def _scd(spark, sf) -> DataFrame:
    ev = _t(spark, sf, "events").select(*SCD_COLUMNS)
    return scd2_history(ev, ["user_id"], "ts", ["event_type"])


@query("scd2_history", _SCD_SQL)
def q_scd2_history(spark, sf):
    """SCD-01: type-2 history of events keyed by user, sequenced by ts, tracking event_type."""
    return _scd(spark, sf)


@query("scd2_current", f'SELECT * FROM ({_SCD_SQL}) h WHERE "__END_AT" IS NULL')
def q_scd2_current(spark, sf):
    """SCD-04: open versions of the flagship history."""
    return current_rows(_scd(spark, sf))


@query("scd2_closed", f'SELECT * FROM ({_SCD_SQL}) h WHERE "__END_AT" IS NOT NULL')
def q_scd2_closed(spark, sf):
    """SCD-04: closed versions of the flagship history."""
    return closed_rows(_scd(spark, sf))


@query("scd2_stream", _SCD_SQL)
def q_scd2_stream(spark, sf):
    """SCD-02, STR-06: the same history maintained from a stream fed out of order
    (three file sets written in the order 2, 0, 1 of ``event_id % 3``)."""
    root = fresh_dir(spark, "scd2_stream")
    ev = _t(spark, sf, "events").select(*SCD_COLUMNS)
    for part in (2, 0, 1):
        ev.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/feed")
    n_files = len(S.list_files(spark, f"{root}/feed", "*.parquet"))
    src = (spark.readStream.schema(ev.schema)
           .option("maxFilesPerTrigger", max(1, -(-n_files // 3))).parquet(f"{root}/feed"))
    q = (src.writeStream
         .foreachBatch(Scd2Writer(f"{root}/dim", f"{root}/log", ["user_id"], "ts",
                                  ["event_type"], key_buckets=16))
         .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return read_dimension(spark, f"{root}/dim").select(*SCD_COLUMNS, "__START_AT", "__END_AT")


@query("scd2_split", f"""
WITH h AS ({_SCD_SQL})
SELECT count(*) FILTER (WHERE "__END_AT" IS NULL) AS current_rows,
       count(*) FILTER (WHERE "__END_AT" IS NOT NULL) AS historical_rows,
       count(*) AS total_rows, count(DISTINCT user_id) AS distinct_keys
FROM h""")
def q_scd2_split(spark, sf):
    """SCD-04, QA-21: current / historical / total rows and keys in one pass."""
    return split_counts(_scd(spark, sf), ["user_id"])


_PERIODS_SQL = """
SELECT o_custkey AS k, o_orderdate AS s,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL
            ELSE o_orderdate + to_days(CAST((o_orderkey % 5 + 1) * 30 AS INTEGER)) END AS e
FROM orders"""


@query("scd2_overlap", f"""
WITH p AS ({_PERIODS_SQL}),
ref AS (SELECT count(*) AS pairs FROM p a JOIN p b
        ON a.k = b.k AND a.s < b.e AND a.e > b.s AND a.s <> b.s),
nx AS (SELECT e, LEAD(s) OVER (PARTITION BY k ORDER BY s, e NULLS FIRST) AS ns FROM p),
strict AS (SELECT count(*) FILTER (WHERE ns IS NOT NULL AND (e IS NULL OR ns < e)) AS overlaps FROM nx)
SELECT ref.pairs AS reference_pairs, strict.overlaps AS strict_overlaps FROM ref, strict""")
def q_scd2_overlap(spark, sf):
    """QA-22, JN-05: overlapping periods per key — the self-join pair metric computed by a
    sweep (no pairs formed) and the strict successor check (open ends count)."""
    o = _t(spark, sf, "orders")
    periods = o.select(
        F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("s"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit(None))
        .otherwise(F.timestamp_add("DAY", ((F.col("o_orderkey") % 5 + 1) * 30).cast("int"),
                                   F.col("o_orderdate"))).alias("e"))
    ref = reference_overlaps(periods, ["k"], "s", "e", 30 * 86400)
    strict = strict_overlaps(periods, ["k"], "s", "e", 30 * 86400)
    return K.side_by_side(ref, strict).select(F.col("pairs").alias("reference_pairs"),
                                              F.col("overlaps").alias("strict_overlaps"))


_ODD_PERIODS_SQL = """
SELECT CASE WHEN o_custkey % 5 < 2 THEN 0 ELSE o_custkey % 200 END AS k, o_orderkey AS s,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 < 2 THEN o_orderkey - (o_orderkey % 7) * 40
            ELSE o_orderkey + (o_orderkey % 13) * 30 END AS e
FROM orders"""


@query("overlap_odd_periods", f"""
WITH p AS ({_ODD_PERIODS_SQL})
SELECT count(*) AS pairs FROM p a JOIN p b ON a.k = b.k AND a.s < b.e AND a.e > b.s AND a.s <> b.s""")
def q_overlap_odd_periods(spark, sf):
    """QA-22, JN-05: the self-join pair metric where two fifths of the periods end at or before
    their start and one key holds two fifths of all rows."""
    key, c = F.col("o_orderkey"), F.col("o_custkey")
    periods = _t(spark, sf, "orders").select(
        F.when(c % 5 < 2, 0).otherwise(c % 200).alias("k"), key.alias("s"),
        F.when(key % 11 == 0, F.lit(None)).when(key % 5 < 2, key - (key % 7) * 40)
        .otherwise(key + (key % 13) * 30).alias("e"))
    return reference_overlaps(periods, ["k"], "s", "e", 10_000)


# ---------------------------------------------------------------------------------------
# Validation checks (QA-01..26)
# ---------------------------------------------------------------------------------------

def check_query(name: str, sql: str):
    """Registers a query of check rows without the counts behind them, which ``check_counts``
    and the reports compare."""
    def deco(fn):
        @wraps(fn)
        def run(spark, sf):
            return fn(spark, sf).drop("counted", "total")
        query(name, sql)(run)
        return fn
    return deco


def _check_sql(check_id, table, column, metric_sql, pass_sql, threshold, fail="FAIL",
               null_status=None, from_sql=None):
    col = "NULL" if column is None else f"'{column}'"
    ns = null_status or fail
    status = (f"CASE WHEN ({metric_sql}) IS NULL THEN '{ns}' WHEN {pass_sql} THEN 'PASS' "
              f"ELSE '{fail}' END") if pass_sql else "'INFO'"
    return (f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, "
            f"CAST({col} AS VARCHAR) AS column_name, {status} AS status, "
            f"CAST({metric_sql} AS DOUBLE) AS metric, '{threshold}' AS threshold"
            + (f" FROM {from_sql}" if from_sql else ""))


def _count_check(check_id, table, column, cond_sql, from_sql):
    m = f"(SELECT count(*) FILTER (WHERE {cond_sql}) FROM {from_sql})"
    return _check_sql(check_id, table, column, m, f"{m} = 0", "= 0")


@check_query("row_reconcile", f"""
WITH up AS (SELECT count(*) AS n FROM ({_ORDERS_INJECTED_SQL}) t),
down AS (SELECT count(*) AS n FROM ({_ORDERS_INJECTED_SQL}) t WHERE {_ORDERS_KEEP_SQL}),
m AS (SELECT CASE WHEN up.n > 0 THEN CAST(up.n - down.n AS DOUBLE) * 100.0 / CAST(up.n AS DOUBLE) ELSE 0.0 END AS drop_pct,
             CASE WHEN up.n > 0 THEN CAST(down.n AS DOUBLE) * 100.0 / CAST(up.n AS DOUBLE) ELSE 0.0 END AS ratio_pct
      FROM up, down)
SELECT 'QA-01' AS check_id, 'orders' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       CASE WHEN drop_pct <= 5.0 THEN 'PASS' ELSE 'FAIL' END AS status, drop_pct AS metric, '<= 5.0' AS threshold FROM m
UNION ALL
SELECT 'QA-13', 'orders', NULL, CASE WHEN ratio_pct >= 99.0 THEN 'PASS' ELSE 'FAIL' END, ratio_pct, '>= 99.0' FROM m""")
def q_row_reconcile(spark, sf):
    """QA-01 (drop % <= 5) and QA-13 (ratio % >= 99) before/after the drop rules."""
    up = _orders_injected(spark, sf)
    down = expect(up, ORDER_RULES)
    return K.union_results([K.reconcile(up, down, "orders", max_drop_pct=5.0, check_id="QA-01"),
                            K.reconcile(up, down, "orders", min_ratio_pct=99.0, check_id="QA-13")])


_LINEITEM_NULLS_SQL = """
SELECT CASE WHEN l_linenumber = 1 AND l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
       l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem"""


def _lineitem_nulls(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select(
        F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 50 == 0), F.lit(None))
        .otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit(None)).otherwise(F.col("l_partkey"))
        .alias("l_partkey"),
        "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")


@check_query("key_nulls", "\nUNION ALL ".join(
    _count_check("QA-02", "lineitem", c, f"{c} IS NULL", f"({_LINEITEM_NULLS_SQL}) t")
    for c in ("l_orderkey", "l_partkey", "l_suppkey")))
def q_key_nulls(spark, sf):
    """QA-02/14: NULL keys, all columns of a table in one aggregate."""
    return K.measure_table(_lineitem_nulls(spark, sf), "lineitem",
                           [K.not_null(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")])


_TYPE_EXPECT = {"orders": {"o_orderkey": "bigint", "o_totalprice": "double",
                           "o_orderdate": "timestamp", "o_orderpriority": "string",
                           "o_missing": "int"},
                "lineitem": {"l_linenumber": "int", "l_quantity": "double"}}


def _types_sql() -> str:
    actual = {"orders": {"o_orderkey": "bigint", "o_totalprice": "double",
                         "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
              "lineitem": {"l_linenumber": "int", "l_quantity": "double"}}
    rows = []
    for t, cols in _TYPE_EXPECT.items():
        for c, e in cols.items():
            a = actual[t].get(c, "NOT_FOUND")
            ok = a == e
            rows.append(f"('QA-03', '{t}', '{c}', '{'PASS' if ok else 'FAIL'}', "
                        f"{0.0 if ok else 1.0}, '{e}|{a}')")
    rows.append("('QA-06', 'part', 'words', 'PASS', 0.0, 'array')")
    rows.append("('QA-06', 'part', 'p_name', 'FAIL', 1.0, 'array')")
    rows.append("('QA-12', 'orders', 'o_orderkey,o_custkey', 'PASS', 0.0, 'all present')")
    rows.append("('QA-12', 'orders', '__START_AT,__END_AT', 'WARN', 2.0, 'all present')")
    return ("SELECT check_id, table_name, column_name, status, CAST(metric AS DOUBLE) AS metric, "
            "threshold FROM (VALUES " + ", ".join(rows) +
            ") AS v(check_id, table_name, column_name, status, metric, threshold)")


@check_query("column_types", _types_sql())
def q_column_types(spark, sf):
    """QA-03 (exact types, NOT_FOUND), QA-06 (array columns), QA-12 (required columns;
    missing -> WARN) — read from schemas only."""
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    words = _part_words(spark, sf).join(_t(spark, sf, "part").select("p_partkey", "p_name"),
                                        "p_partkey")
    rows = (K.column_types(o, "orders", _TYPE_EXPECT["orders"])
            + K.column_types(li, "lineitem", _TYPE_EXPECT["lineitem"])
            + K.array_columns(words, "part", ["words", "p_name"])
            + K.required_columns(o, "orders", ["o_orderkey", "o_custkey"])
            + K.required_columns(o, "orders", ["__START_AT", "__END_AT"], missing_status=K.WARN))
    return K.result_rows(spark, rows)


@query("first_sample", """
SELECT DISTINCT 'o_orderpriority' AS column_name, 'array<string>' AS data_type, string_split(o_orderpriority, '-')[2] AS second
FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'o_orderstatus', 'string', NULL WHERE false""")
def q_first_sample(spark, sf):
    """LIM-02, QA-06: the first value that is not NULL, told to be an array by its type; a column
    without values has no sample. All values are alike here, so any sample is the same."""
    orders = _t(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.split("o_orderpriority", "-")).alias("o_orderpriority"),
        F.when(F.col("o_orderkey") < 0, F.array("o_orderstatus")).alias("o_orderstatus"))
    return K.union_results([
        K.first_non_null(orders, c).select(F.lit(c).alias("column_name"), F.typeof(c).alias("data_type"),
                                           F.get(c, F.lit(1)).alias("second")) for c in orders.columns])


_SCHEMA_EXPECT = [("orders", "o_orderkey", "bigint"), ("orders", "o_totalprice", "double"),
                  ("orders", "o_custkey", "string"), ("lineitem", "l_linenumber", "int"),
                  ("lineitem", "l_shipmode", "string"), ("documents", "text", "string"),
                  ("part", "p_size", "int"), ("labels", "doc_id", "bigint")]


@check_query("schema_checks", f"""
WITH e(table_name, column_name, want) AS (VALUES {', '.join(map(str, _SCHEMA_EXPECT))}),
a AS (SELECT DISTINCT table_name, column_name,
             CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
                            WHEN 'DOUBLE' THEN 'double' ELSE lower(data_type) END AS got
      FROM information_schema.columns),
j AS (SELECT e.*, coalesce(got, 'NOT_FOUND') AS got FROM e LEFT JOIN a USING (table_name, column_name)),
v AS (SELECT count(*) AS n FROM information_schema.columns
      WHERE table_name = 'embeddings' AND column_name = 'embedding' AND data_type LIKE '%[]')
SELECT 'QA-03' AS check_id, table_name, column_name, CASE WHEN want = got THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN want = got THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS metric, want || '|' || got AS threshold FROM j
UNION ALL SELECT 'QA-06', 'embeddings', 'embedding', CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END,
       CASE WHEN n > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END, 'array' FROM v
UNION ALL SELECT 'QA-12', 'labels', 'quality,toxic', CASE WHEN count(*) = 2 THEN 'PASS' ELSE 'FAIL' END,
       CAST(2 - count(*) AS DOUBLE), 'all present' FROM (SELECT DISTINCT column_name FROM information_schema.columns
       WHERE table_name = 'labels' AND column_name IN ('quality', 'toxic')) c""")
def q_schema_checks(spark, sf):
    """QA-03, QA-06, QA-12 on the stored tables' own schemas (the oracle asks DuckDB's)."""
    rows = [r for t, c, want in _SCHEMA_EXPECT for r in K.column_types(_t(spark, sf, t), t, {c: want})]
    rows += K.array_columns(_t(spark, sf, "embeddings"), "embeddings", ["embedding"])
    rows += K.required_columns(_t(spark, sf, "labels"), "labels", ["quality", "toxic"])
    return K.result_rows(spark, rows)


_CUSTOMER_NAMES_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'Cust-' || CAST(c_custkey AS VARCHAR)
                       WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS c_name
FROM customer"""


@check_query("id_format", "\nUNION ALL ".join([
    _count_check("QA-04", "customer", "c_name",
                 "NOT regexp_matches(c_name, '^Customer#[0-9]+$')", f"({_CUSTOMER_NAMES_SQL}) t"),
    _count_check("QA-04", "orders", "o_orderpriority",
                 "NOT regexp_matches(o_orderpriority, '^[0-9]-[A-Z ]+$')", "orders")]))
def q_id_format(spark, sf):
    """QA-04: id/format patterns (NULL values are not counted as invalid)."""
    c = _t(spark, sf, "customer")
    c = c.select("c_custkey", F.when(F.col("c_custkey") % 13 == 0,
                                     F.concat(F.lit("Cust-"), F.col("c_custkey").cast("string")))
                 .when(F.col("c_custkey") % 17 == 0, F.lit(None)).otherwise(F.col("c_name"))
                 .alias("c_name"))
    return K.union_results([
        K.measure_table(c, "customer", [K.id_format("c_name", "^Customer#[0-9]+$")]),
        K.measure_table(_t(spark, sf, "orders"), "orders",
                        [K.id_format("o_orderpriority", "^[0-9]-[A-Z ]+$")])])


_RANGES = {
    "customer": [("c_acctbal", "c_acctbal IS NOT NULL AND c_acctbal <= 0")],
    "lineitem": [("l_quantity", "l_quantity < 1 OR l_quantity > 50"),
                 ("l_discount", "l_discount < 0 OR l_discount > 0.1"),
                 ("l_tax", "l_tax IS NOT NULL AND (l_tax < 0 OR l_tax > 0.08)"),
                 ("l_linenumber", "l_linenumber <= 0")],
}


@check_query("range_checks", "\nUNION ALL ".join(
    _count_check("QA-05", t, c, cond, t) for t, items in _RANGES.items() for c, cond in items))
def q_range_checks(spark, sf):
    """QA-05/17: range rules, one aggregate pass per table."""
    return K.union_results([
        K.measure_table(_t(spark, sf, t), t, [K.violations(c, cond) for c, cond in items])
        for t, items in _RANGES.items()])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


@check_query("enum_check", _count_check(
    "QA-07", "orders", "o_orderpriority",
    "NOT (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))", "orders"))
def q_enum_check(spark, sf):
    """QA-07/15: values outside an enumeration."""
    return K.measure_table(_t(spark, sf, "orders"), "orders",
                           [K.allowed_values("o_orderpriority", PRIORITIES)])


@query("distribution", """
SELECT l_suppkey, count(*) AS row_count FROM lineitem
GROUP BY l_suppkey ORDER BY row_count DESC, l_suppkey LIMIT 15""")
def q_distribution(spark, sf):
    """AGG-08, SRT-01, LIM-01: value distribution, top 15 by count (key breaks ties)."""
    from lakeward.plans.reports import distribution
    return distribution(_t(spark, sf, "lineitem"), "l_suppkey").withColumnRenamed("count", "row_count")


def _fk_sql(check_id, table, child_col, child_from, parent_table, parent_col, parent_from,
            skip_null=False, tolerance=None):
    where = f"WHERE {child_col} IS NOT NULL" if skip_null else ""
    base = (f"(SELECT count(*) AS total, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent_from} p "
            f"WHERE p.{parent_col} = c.{child_col})) AS orphans FROM {child_from} c {where}) x")
    column = f"{child_col}->{parent_table}.{parent_col}"
    if tolerance is None:
        return _check_sql(check_id, table, column, "orphans", "orphans = 0", "= 0", from_sql=base)
    m = ("COALESCE(CAST(orphans AS DOUBLE) * 100.0 / CAST(NULLIF(total, 0) AS DOUBLE), 0.0)")
    return _check_sql(check_id, table, column, m, f"{m} < {tolerance}", f"< {tolerance}",
                      from_sql=base)


@check_query("self_reference", "\nUNION ALL ".join([
    _count_check("QA-08", "lineitem", "l_partkey=l_suppkey", "l_partkey = l_suppkey", "lineitem"),
    _fk_sql("QA-08", "lineitem", "l_orderkey", "lineitem", "orders", "o_orderkey", "orders")]))
def q_self_reference(spark, sf):
    """QA-08/18: self-references and orphan parents."""
    li = _t(spark, sf, "lineitem")
    return K.union_results([
        K.measure_table(li, "lineitem", [K.self_reference("l_partkey", "l_suppkey")]),
        K.foreign_key(li, "lineitem", "l_orderkey", _t(spark, sf, "orders"), "orders",
                      "o_orderkey", check_id="QA-08")])


_FKS = [
    # child table, child col, child source sql, parent table, parent col, skip_null
    ("documents", "doc_id", "documents", "labels", "doc_id", False),
    ("orders", "o_custkey", "orders", "customer", "c_custkey", False),
    ("lineitem", "l_suppkey", "lineitem", "supplier", "s_suppkey", False),
    ("labels", "doc_id", "labels", "documents", "doc_id", False),
    ("lineitem", "l_partkey", None, "part", "p_partkey", True),
    ("lineitem", "l_orderkey", None, "orders", "o_orderkey", False),
]


@check_query("fk_orphans", "\nUNION ALL ".join(
    _fk_sql("QA-20", t, c, src or f"({_LINEITEM_NULLS_SQL})", pt, pc, pt, skip)
    for t, c, src, pt, pc, skip in _FKS))
def q_fk_orphans(spark, sf):
    """QA-19/20, JN-02..04: orphan counts per relation (NULL keys skipped where declared,
    otherwise counted as orphans); fact keys are pre-aggregated before the anti-join."""
    out = []
    for t, c, src, pt, pc, skip in _FKS:
        child = _t(spark, sf, t) if src else _lineitem_nulls(spark, sf)
        out.append(K.foreign_key(child, t, c, _t(spark, sf, pt), pt, pc, skip_null=skip))
    return K.union_results(out)


@check_query("fk_orphan_pct", "\nUNION ALL ".join([
    _fk_sql("QA-20", "documents", "doc_id", "documents", "labels", "doc_id", "labels",
            tolerance=1.0),
    _fk_sql("QA-20", "orders", "o_custkey", "orders", "customer", "c_custkey", "customer",
            tolerance=1.0)]))
def q_fk_orphan_pct(spark, sf):
    """QA-20 tolerance form: orphan % below 1."""
    return K.union_results([
        K.foreign_key(_t(spark, sf, "documents"), "documents", "doc_id", _t(spark, sf, "labels"),
                      "labels", "doc_id", tolerance_pct=1.0),
        K.foreign_key(_t(spark, sf, "orders"), "orders", "o_custkey", _t(spark, sf, "customer"),
                      "customer", "c_custkey", tolerance_pct=1.0)])


_DUP_KEYS = [("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]),
             ("documents", ["text"])]


def _dup_sql(table, keys):
    k = ", ".join(keys)
    m = f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {table}) d) FROM {table})"
    return _check_sql("QA-09", table, ",".join(keys), m, f"{m} = 0", "= 0")


@check_query("dup_surplus", "\nUNION ALL ".join(_dup_sql(t, k) for t, k in _DUP_KEYS))
def q_dup_surplus(spark, sf):
    """QA-09/19/25, AGG-05: surplus rows = total - distinct keys (NULL keys form a group);
    whole texts as a key for the documents table."""
    return K.union_results([K.duplicate_keys(_t(spark, sf, t), t, k) for t, k in _DUP_KEYS])


@query("dup_groups", """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
       CAST(sum(n - 1) AS BIGINT) AS surplus_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g""")
def q_dup_groups(spark, sf):
    """AGG-04/05: total, distinct keys, surplus rows and duplicate groups in one shuffle."""
    return K.key_stats(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_FRESH = [("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate")]


def _fresh_sql(table, col):
    m = (f"(SELECT (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max({col}))) / 3.6e9 FROM {table})")
    return _check_sql("QA-10", table, col, m, f"{m} < 24.0", "< 24.0")


@check_query("freshness", "\nUNION ALL ".join(_fresh_sql(t, c) for t, c in _FRESH))
def q_freshness(spark, sf):
    """QA-10/26: age in hours of the newest stamp against a fixed as-of time."""
    as_of = F.to_timestamp(F.lit(AS_OF))
    return K.union_results([K.measure_table(_t(spark, sf, t), t, [K.freshness(c, as_of, 24.0)])
                            for t, c in _FRESH])


ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@check_query("non_empty", "\nUNION ALL ".join(
    _check_sql("QA-11", t, None, f"(SELECT count(*) FROM {t})", f"(SELECT count(*) FROM {t}) > 0",
               "> 0") for t in ALL_TABLES))
def q_non_empty(spark, sf):
    """QA-11: every table has rows."""
    return K.union_results([K.measure_table(_t(spark, sf, t), t, [K.non_empty()])
                            for t in ALL_TABLES])


@check_query("lookup_coverage", _check_sql(
    "QA-16", "dim_coded", "region_name",
    "COALESCE(CAST(count(*) FILTER (WHERE region_name <> region_key) AS DOUBLE) * 100.0 / "
    "CAST(NULLIF(count(*), 0) AS DOUBLE), 0.0)",
    "COALESCE(CAST(count(*) FILTER (WHERE region_name <> region_key) AS DOUBLE) * 100.0 / "
    "CAST(NULLIF(count(*), 0) AS DOUBLE), 0.0) >= 80.0", ">= 80.0",
    from_sql=f"({_CODED_SQL}) c"))
def q_lookup_coverage(spark, sf):
    """QA-16: share of codes resolved to a name."""
    return K.measure_table(_coded(spark, sf), "dim_coded",
                           [K.named_share("region_name", "region_key", 80.0)])


@check_query("completeness", "\nUNION ALL ".join(
    _check_sql("QA-23", "orders", c,
               f"COALESCE(CAST(count({c}) AS DOUBLE) * 100.0 / CAST(NULLIF(count(*), 0) AS DOUBLE), 0.0)",
               None, "", from_sql=f"({_ORDERS_INJECTED_SQL}) t")
    for c in ("o_custkey", "o_totalprice", "o_orderpriority")))
def q_completeness(spark, sf):
    """QA-23: % complete per column (a report)."""
    return K.measure_table(_orders_injected(spark, sf), "orders",
                           [K.completeness(c) for c in ("o_custkey", "o_totalprice",
                                                        "o_orderpriority")])


@query("stats", """
SELECT CAST(sum(p) AS DECIMAL(38,2)) AS total_price, CAST(sum(p) AS DOUBLE) / count(*) AS avg_price,
       min(p) AS min_price, max(p) AS max_price,
       CAST(CAST(sum(v) AS BIGINT) AS DOUBLE) / count(*) AS avg_votes, CAST(sum(v) AS BIGINT) AS total_votes
FROM (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS p, CAST(o_custkey % 1000 AS INTEGER) AS v FROM orders) t""")
def q_stats(spark, sf):
    """QA-24, AGG-07: summary statistics (sums exact as decimals)."""
    o = _t(spark, sf, "orders").select(F.col("o_totalprice").cast("decimal(18,2)").alias("p"),
                                       (F.col("o_custkey") % 1000).cast("int").alias("v"))
    n = F.count(F.lit(1))
    return o.agg(F.sum("p").cast("decimal(38,2)").alias("total_price"),
                 (F.sum("p").cast("double") / n).alias("avg_price"),
                 F.min("p").alias("min_price"), F.max("p").alias("max_price"),
                 (F.sum("v").cast("long").cast("double") / n).alias("avg_votes"),
                 F.sum("v").cast("long").alias("total_votes"))


_STATISTICS = [("avg_size", "avg(p_size)"), ("min_price", "min(p_retailprice)"),
               ("max_price", "max(p_retailprice)"), ("total_size", "sum(p_size)")]


@check_query("statistics", "\nUNION ALL ".join(
    f"SELECT 'QA-24' AS check_id, 'part' AS table_name, '{label}' AS column_name, 'INFO' AS status, "
    f"CAST({value} AS DOUBLE) AS metric, '' AS threshold FROM part" for label, value in _STATISTICS))
def q_statistics(spark, sf):
    """QA-24, AGG-07: reported statistics as result rows, one aggregate for all."""
    return K.measure_table(_t(spark, sf, "part"), "part",
                           [K.statistic(label, F.expr(value)) for label, value in _STATISTICS])


def _counts_sql(check_id, table, column, counted, total, from_sql, metric="counted", ok="counted = 0",
                threshold="= 0"):
    return (f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, CAST({column} AS VARCHAR) AS column_name, "
            f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, CAST({metric} AS DOUBLE) AS metric, "
            f"'{threshold}' AS threshold, CAST(counted AS BIGINT) AS counted, CAST(total AS BIGINT) AS total "
            f"FROM (SELECT {counted} AS counted, {total} AS total FROM {from_sql}) q")


_SHARE_SQL = "CAST(counted AS DOUBLE) * 100.0 / CAST(total AS DOUBLE)"
_KEPT_COUNT_SQL = f"(SELECT count(*) FROM ({_ORDERS_INJECTED_SQL}) k WHERE {_ORDERS_KEEP_SQL})"


@query("check_counts", "\nUNION ALL ".join(
    [_counts_sql("QA-02", "lineitem", f"'{c}'", f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)",
                 f"({_LINEITEM_NULLS_SQL}) t") for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    + [_counts_sql("QA-01", "orders", "NULL", _KEPT_COUNT_SQL, "count(*)", f"({_ORDERS_INJECTED_SQL}) t",
                   "CAST(total - counted AS DOUBLE) * 100.0 / CAST(total AS DOUBLE)",
                   "CAST(total - counted AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) <= 5.0", "<= 5.0"),
       _counts_sql("QA-13", "orders", "NULL", _KEPT_COUNT_SQL, "count(*)", f"({_ORDERS_INJECTED_SQL}) t",
                   _SHARE_SQL, f"{_SHARE_SQL} >= 99.0", ">= 99.0"),
       _counts_sql("QA-16", "dim_coded", "'region_name'", "count(*) FILTER (WHERE region_name <> region_key)", "count(*)",
                   f"({_CODED_SQL}) t", _SHARE_SQL, f"{_SHARE_SQL} >= 80.0", ">= 80.0"),
       _counts_sql("QA-23", "orders", "'o_custkey'", "count(o_custkey)", "count(*)", f"({_ORDERS_INJECTED_SQL}) t",
                   _SHARE_SQL, "true", "").replace("CASE WHEN true THEN 'PASS' ELSE 'FAIL' END", "'INFO'"),
       _counts_sql("QA-11", "events", "NULL", "count(*)", "count(*)", "events t", ok="counted > 0", threshold="> 0"),
       _counts_sql("QA-09", "documents", "'text'",
                   "count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents) d)", "count(*)", "documents t"),
       _counts_sql("QA-20", "lineitem", "'l_partkey->part.p_partkey'",
                   "count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey))", "count(*)",
                   f"({_LINEITEM_NULLS_SQL}) t WHERE l_partkey IS NOT NULL"),
       _counts_sql("QA-20", "lineitem", "'l_orderkey->orders.o_orderkey'",
                   "count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))", "count(*)",
                   f"({_LINEITEM_NULLS_SQL}) t", _SHARE_SQL, f"{_SHARE_SQL} < 1.0", "< 1.0")]))
def q_check_counts(spark, sf):
    """QA-27: check rows of every kind with both counts behind each metric, on tables with
    injected NULL keys and dropped rows."""
    lines, up = _lineitem_nulls(spark, sf), _orders_injected(spark, sf)
    down = expect(up, ORDER_RULES)
    return K.union_results([
        K.measure_table(lines, "lineitem", [K.not_null(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")]),
        K.reconcile(up, down, "orders", max_drop_pct=5.0, check_id="QA-01"),
        K.reconcile(up, down, "orders", min_ratio_pct=99.0, check_id="QA-13"),
        K.measure_table(_coded(spark, sf), "dim_coded", [K.named_share("region_name", "region_key", 80.0)]),
        K.measure_table(up, "orders", [K.completeness("o_custkey")]),
        K.measure_table(_t(spark, sf, "events"), "events", [K.non_empty()]),
        K.duplicate_keys(_t(spark, sf, "documents"), "documents", ["text"]),
        K.foreign_key(lines, "lineitem", "l_partkey", _t(spark, sf, "part"), "part", "p_partkey", skip_null=True),
        K.foreign_key(lines, "lineitem", "l_orderkey", _t(spark, sf, "orders"), "orders", "o_orderkey",
                      tolerance_pct=1.0)])


# ---------------------------------------------------------------------------------------
# Audit tables (QL-1..7, SET-01, JN-06)
# ---------------------------------------------------------------------------------------

_AUDITS = [("orders", "o_orderdate", ("o_orderkey",),
            ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority")),
           ("lineitem", "l_shipdate", ("l_orderkey", "l_linenumber"),
            ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate")),
           ("events", "ts", ("event_id",),
            ("event_id", "ts", "user_id", "event_type", "value"))]


def _audit_sql(name, stamp, expected, cols):
    new = [c for c in cols if c not in expected]
    return (f"SELECT '{name}' AS table_name, '{name}.tsv.gz' AS file_name, 'SUCCESS' AS status, "
            f"CAST(NULL AS VARCHAR) AS error_message, count(*) AS rows_loaded, "
            f"max({stamp}) AS load_timestamp, '{','.join(cols)}' AS columns_detected, "
            f"'{','.join(new)}' AS new_columns_added, {str(bool(new)).lower()} AS schema_drift_detected "
            f"FROM {name}")


_AUDIT_COLS = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"],
               "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                            "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                            "l_linestatus", "l_shipdate"],
               "events": ["event_id", "ts", "user_id", "event_type", "value", "props"]}


@query("load_audit", "\nUNION ALL ".join(
    _audit_sql(n, s, e, _AUDIT_COLS[n]) for n, s, _, e in _AUDITS))
def q_load_audit(spark, sf):
    """QL-1/2/7, SET-01: one audit row per table; drift = unexpected columns (events.props)."""
    return A.load_audit([(_t(spark, sf, n), A.AuditTarget(n, k, e, f"{n}.tsv.gz", stamp=s))
                         for n, s, k, e in _AUDITS])


@query("row_count_history", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT day, SUM(n) OVER (ORDER BY day) AS row_count FROM d)
SELECT 'events' AS table_name, CAST(row_count AS BIGINT) AS row_count,
       CAST(day AS TIMESTAMP) AS recorded_at,
       CAST(row_count - COALESCE(LAG(row_count) OVER (ORDER BY day), row_count) AS BIGINT) AS delta_from_previous
FROM c""")
def q_row_count_history(spark, sf):
    """QL-3: one snapshot per event day (cumulative rows) and the delta to the previous."""
    from pyspark.sql import Window
    per_day = (_t(spark, sf, "events").groupBy(F.to_date("ts").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("table_name").orderBy("recorded_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    snaps = per_day.select(F.lit("events").alias("table_name"),
                           F.col("day").cast("timestamp").alias("recorded_at"), "n")
    snaps = snaps.select("table_name", F.sum("n").over(w).cast("long").alias("row_count"),
                         "recorded_at")
    return A.with_deltas(snaps)


_DQ_TARGETS = [("lineitem", ("l_orderkey", "l_linenumber")), ("orders", ("o_orderkey",))]


def _dq_sql(name, keys, src, cols):
    nulls = " || ',' || ".join(f"'{c}:' || CAST(count(*) FILTER (WHERE {c} IS NULL) AS VARCHAR)"
                               for c in cols)
    k = ", ".join(keys)
    return (f"SELECT '{name}' AS table_name, s.total_rows, s.null_counts, d.duplicate_count, "
            f"'{','.join(keys)}' AS primary_key_columns, TIMESTAMP '{CHECK_TS}' AS check_timestamp, "
            f"CASE WHEN d.duplicate_count > 0 THEN 80.0 ELSE 100.0 END::DOUBLE AS quality_score, "
            f"CASE WHEN d.duplicate_count > 0 THEN 'DUPLICATE_PK|' || CAST(d.duplicate_count AS VARCHAR) "
            f"ELSE '' END AS issues_found "
            f"FROM (SELECT count(*) AS total_rows, {nulls} AS null_counts FROM {src}) s, "
            f"(SELECT count(*) FILTER (WHERE n > 1) AS duplicate_count FROM "
            f"(SELECT count(*) AS n FROM {src} GROUP BY {k}) g) d")


@query("data_quality", "\nUNION ALL ".join([
    _dq_sql("lineitem", ["l_orderkey", "l_linenumber"], f"({_LINEITEM_NULLS_SQL}) t",
            _AUDIT_COLS["lineitem"]),
    _dq_sql("orders", ["o_orderkey"], f"({_ORDERS_INJECTED_SQL}) t", _AUDIT_COLS["orders"])]))
def q_data_quality(spark, sf):
    """QL-4..6, AGG-03/04, JN-06: totals, NULL-count text, duplicate groups, score, issues."""
    ts = F.to_timestamp(F.lit(CHECK_TS))
    return A.data_quality([
        (_lineitem_nulls(spark, sf), A.AuditTarget("lineitem", ("l_orderkey", "l_linenumber"), ())),
        (_orders_injected(spark, sf), A.AuditTarget("orders", ("o_orderkey",), ()))], ts)


# ---------------------------------------------------------------------------------------
# Streaming (STR-01..05, AGG-09)
# ---------------------------------------------------------------------------------------

@query("stream_dedupe", f"""
SELECT DISTINCT trim(w) AS genre_key, trim(w) AS genre_name
FROM ({_WORDS_SQL}) t WHERE w IS NOT NULL""")
def q_stream_dedupe(spark, sf):
    """STR-03/04, AGG-09: streaming explode to one row per key over three micro-batches (the
    table is written as three files first, whatever its own layout)."""
    root = fresh_dir(spark, "stream_dedupe")
    _t(spark, sf, "part").select("p_partkey", "p_name").repartition(3).write.parquet(f"{root}/part")
    src = TB.stream_table(spark, f"{root}/part", max_files_per_trigger=1)

    def build(batch):
        words = batch.select("p_partkey", C.split_list("p_name", " ").alias("words"))
        return D.exploded_dimension(words, "words", "genre_key", "genre_name")

    TB.new_keys_stream(src, build, "genre_key", f"{root}/dim", f"{root}/_checkpoint").awaitTermination()
    return TB.read_table(spark, f"{root}/dim").drop(*TB.STORAGE_COLUMNS)


@query("key_store_growth", """
SELECT l_partkey || '-' || l_suppkey AS supply_key, l_partkey, l_suppkey,
       CAST(min(l_orderkey % 3) AS INTEGER) AS first_batch
FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL GROUP BY ALL""")
def q_key_store_growth(spark, sf):
    """STR-03, AGG-09: a dimension with about as many keys as its source has parts and suppliers
    grows over three batches that share keys; each key keeps the batch that brought it."""
    root = fresh_dir(spark, "key_store_growth")
    rows = (_t(spark, sf, "lineitem").where("l_partkey IS NOT NULL AND l_suppkey IS NOT NULL")
            .select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("supply_key"), "l_partkey", "l_suppkey",
                    (F.col("l_orderkey") % 3).cast("int").alias("first_batch")))
    for b in range(3):
        rows.where(F.col("first_batch") == b).write.mode("append").parquet(f"{root}/batches")
        TB.new_keys_stream(TB.stream_table(spark, f"{root}/batches"), lambda batch: batch.distinct(),
                           "supply_key", f"{root}/dim", f"{root}/_checkpoint").awaitTermination()
    return TB.read_table(spark, f"{root}/dim").drop(*TB.STORAGE_COLUMNS)


@query("stream_dedupe_stateful", f"""
SELECT DISTINCT trim(w) AS genre_key, trim(w) AS genre_name
FROM ({_WORDS_SQL}) t WHERE w IS NOT NULL""")
def q_stream_dedupe_stateful(spark, sf):
    """STR-03/04, AGG-09: the same with Spark's stateful ``dropDuplicates`` (no watermark)."""
    root = fresh_dir(spark, "stream_dedupe_stateful")
    _t(spark, sf, "part").select("p_partkey", "p_name").repartition(3).write.parquet(f"{root}/part")
    src = TB.stream_table(spark, f"{root}/part", max_files_per_trigger=1)
    words = src.select("p_partkey", C.split_list("p_name", " ").alias("words"))
    dim = D.exploded_dimension(words, "words", "genre_key", "genre_name")
    TB.append_stream(dim, f"{root}/dim", f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/dim")


_CHAIN_SQL = """
WITH raw AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
         value, props FROM events),
silver AS (
  SELECT CAST(event_id AS INTEGER) AS event_id, ts, user_id, lower(trim(event_type)) AS event_type,
         value, CASE WHEN regexp_matches(regexp_extract(props, '[0-9]+'), '^[0-9]+$')
                     THEN TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) END AS k
  FROM raw WHERE event_type IS NOT NULL)
SELECT event_id, ts, user_id, event_type, value, k, 'silver_events' AS source_file,
       'dlt_pipeline' AS loaded_by
FROM silver"""


@query("stream_chain", _CHAIN_SQL)
def q_stream_chain(spark, sf):
    """STR-01/02/05, SRC-07, SNK-01: raw TSV -> bronze (incremental ingest) -> silver (typed,
    drop rule) -> gold fact, each a streaming table with its own checkpoint, run in order."""
    root = fresh_dir(spark, "stream_chain")
    ev = _t(spark, sf, "events")
    raw = ev.select(F.col("event_id").cast("string").alias("event_id"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                    F.col("user_id").cast("string").alias("user_id"),
                    F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("event_type"))
                    .alias("event_type"),
                    F.col("value").cast("string").alias("value"), "props")
    S.write_tsv(raw, f"{root}/raw/events")
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    S.ingest_stream(spark, f"{root}/raw/events", f"{root}/bronze/events",
                    f"{root}/_checkpoints/bronze_events", expected=cols,
                    glob="part-*").awaitTermination()
    bronze = TB.stream_table(spark, f"{root}/bronze/events")
    silver = expect(bronze.select(
        C.to_int("event_id").alias("event_id"),
        F.to_timestamp_ntz("ts").alias("ts"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        C.lower_code("event_type").alias("event_type"),
        C.to_double("value").alias("value"),
        C.guarded_int(F.regexp_extract("props", "([0-9]+)", 1), C.DIGITS).alias("k")),
        [Rule("valid_event_type", "event_type IS NOT NULL", DROP)], observation="silver_events")
    TB.append_stream(silver, f"{root}/silver/events", f"{root}/_checkpoints/silver_events"
                     ).awaitTermination()
    gold_src = TB.stream_table(spark, f"{root}/silver/events")
    gold = FA.fact(gold_src, {c: c for c in ["event_id", "ts", "user_id", "event_type", "value",
                                             "k"]},
                   {"source_file": "silver_events", "loaded_by": "dlt_pipeline"})
    TB.append_stream(gold, f"{root}/gold/events", f"{root}/_checkpoints/gold_events"
                     ).awaitTermination()
    return spark.read.parquet(f"{root}/gold/events")


# ---------------------------------------------------------------------------------------
# Tie rule at scale and the report runner (SCD-01 rule 5, QA-27)
# ---------------------------------------------------------------------------------------

_SCD_TIES_SQL = """
WITH src AS (SELECT user_id, date_trunc('hour', ts) AS seq, event_type, event_id, value FROM events),
t AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, seq
                                                ORDER BY event_type DESC, event_id DESC, value DESC) AS rt
                     FROM src) x WHERE rt = 1),
s AS (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY seq) AS prev_t,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY seq) AS rn FROM t),
f AS (SELECT *, CASE WHEN rn = 1 OR prev_t IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS chg FROM s),
v AS (SELECT *, SUM(chg) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS ver FROM f),
l AS (SELECT *, MIN(seq) OVER (PARTITION BY user_id, ver) AS start_at,
             ROW_NUMBER() OVER (PARTITION BY user_id, ver ORDER BY seq DESC) AS rdesc FROM v)
SELECT user_id, seq, event_type, event_id, value, start_at AS "__START_AT",
       LEAD(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS "__END_AT"
FROM l WHERE rdesc = 1"""


@query("scd2_ties", _SCD_TIES_SQL)
def q_scd2_ties(spark, sf):
    """SCD-01 rule 5: the sequence truncated to the hour makes many (key, seq) ties; each
    collapses to the greatest (event_type, event_id, value) before versions are cut."""
    ev = _t(spark, sf, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("seq"), "event_type",
        "event_id", "value")
    return scd2_history(ev, ["user_id"], "seq", ["event_type"])


_REPORT_PARTS = ["key_nulls", "id_format", "range_checks", "enum_check", "dup_surplus",
                 "fk_orphans", "freshness"]


@query("qa_report", "\nUNION ALL ".join(f"SELECT * FROM ({ORACLE[p]}) r{i}"
                                        for i, p in enumerate(_REPORT_PARTS)))
def q_qa_report(spark, sf):
    """QA-27: one result DataFrame for a suite of checks over several tables (NULL keys,
    formats, ranges, enumeration, duplicates, orphans, freshness)."""
    return K.union_results([QUERIES[p](spark, sf) for p in _REPORT_PARTS])


_SCD_HOT_SQL = """
WITH src AS (SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts, event_type,
                    event_id, value, props FROM events),
t AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, ts
                     ORDER BY event_type DESC, event_id DESC, value DESC, props DESC) AS rt FROM src) x
      WHERE rt = 1),
s AS (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev_t,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM t),
f AS (SELECT *, CASE WHEN rn = 1 OR prev_t IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS chg FROM s),
v AS (SELECT *, SUM(chg) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS ver FROM f),
l AS (SELECT *, MIN(ts) OVER (PARTITION BY user_id, ver) AS start_at,
             ROW_NUMBER() OVER (PARTITION BY user_id, ver ORDER BY ts DESC) AS rdesc FROM v)
SELECT user_id, ts, event_type, event_id, value, props, start_at AS "__START_AT",
       LEAD(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS "__END_AT"
FROM l WHERE rdesc = 1"""


@query("scd2_hot_key", _SCD_HOT_SQL)
def q_scd2_hot_key(spark, sf):
    """SCD-01 under skew: every user with ``user_id % 3 = 0`` is folded into key 0, so one
    key holds about a third of all events; the (key, day) buckets spread it over tasks."""
    ev = _t(spark, sf, "events").select(
        F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
        .alias("user_id"), *SCD_COLUMNS[1:])
    return scd2_history(ev, ["user_id"], "ts", ["event_type"])


_HOT_INSTANT = """CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
       CASE WHEN event_id % 3 = 1 THEN 1700000000000000 ELSE {micros} END AS seq, event_type, event_id, value"""

_SCD_INSTANT_SQL = _SCD_TIES_SQL.replace(
    "user_id, date_trunc('hour', ts) AS seq, event_type, event_id, value",
    _HOT_INSTANT.format(micros="epoch_us(ts)"))


@query("scd2_hot_instant", _SCD_INSTANT_SQL)
def q_scd2_hot_instant(spark, sf):
    """SCD-01 by a sequence of whole numbers (epoch microseconds): one key holds a third of all
    events, and one instant of each key a third of its rows; slices come from a quantile sketch,
    the rows of full instants meet reduced to one."""
    ev = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).selectExpr(
        *[e.strip() for e in re.split(r",(?![^(]*\))", _HOT_INSTANT.format(micros="unix_micros(ts)"))])
    return scd2_history(ev, ["user_id"], "seq", ["event_type"], max_bucket_rows=1000)


# ---------------------------------------------------------------------------------------
# The whole layered model on raw files derived from the driver tables (STR-01..06)
# ---------------------------------------------------------------------------------------

_CATEGORY_SQL = """CASE l_returnflag WHEN 'R' THEN 'Actor' WHEN 'A' THEN ' director' ELSE 'self' END"""

_MODEL_SQL = f"""
WITH raw AS (
  SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'xx' ELSE 'tt' END || printf('%07d', l_partkey) AS tconst,
         CAST(l_linenumber AS VARCHAR) AS ordering,
         printf('nm%07d', l_suppkey) AS nconst,
         {_CATEGORY_SQL} AS category,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'line ' || l_linestatus END AS job,
         '["Role ' || CAST(l_linenumber AS VARCHAR) || '"]' AS characters
  FROM lineitem),
silver AS (
  SELECT trim(tconst) AS tconst,
         CASE WHEN regexp_matches(ordering, '^[+-]?[0-9]+$') THEN TRY_CAST(ordering AS INTEGER) END AS ordering,
         trim(nconst) AS nconst, lower(trim(category)) AS category, trim(job) AS job,
         regexp_replace(regexp_replace(trim(characters), '^\\["', ''), '"\\]$', '') AS characters
  FROM raw)
SELECT tconst, nconst, trim(category) AS category_key, category || '_' || COALESCE(job, '') AS job_key,
       ordering, characters, 'silver_title_principals' AS source_file, 'dlt_pipeline' AS loaded_by
FROM silver
WHERE COALESCE(tconst IS NOT NULL AND tconst LIKE 'tt%', false)
  AND COALESCE(nconst IS NOT NULL AND nconst LIKE 'nm%', false)
  AND COALESCE(ordering IS NOT NULL AND ordering > 0, false)"""


@query("layered_model", _MODEL_SQL)
def q_layered_model(spark, sf):
    """STR-01..06: the credits fact (GD-13) of the model run (``model_queries``), without its
    load stamp; the other tables are queries of their own."""
    return M.comparable(load_tables(spark, M.model_run(spark, sf), ["gold_fact_title_credits"])
                        ["gold_fact_title_credits"])


QUERIES.update(M.QUERIES)
ORACLE.update(M.ORACLE)
