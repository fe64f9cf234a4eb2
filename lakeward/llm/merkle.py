"""Merkle manifest of a dataset, verified by a recursive query (operator 11).

Leaves: the SHA-256 of doc_id, source, lang, n_chars and text, each as UTF-8 byte count, ``:``
and value, or ``-`` if null. Every language is a tree of its leaves by doc_id; two consecutive
nodes (at the end of a level maybe one) become the SHA-256 of their hex digests. The trees'
roots, by language, are the leaves of the root tree.

Places in the trees: rows are range-sorted by (lang, doc_id, leaf) and counted by partition;
the counts give each partition's first place, so that a language with most of all rows is
numbered by all tasks.

Stored levels: every ``stride``-th level of a tree is stored as node rows. A node row names its
parent, the node ``stride`` levels up, and holds its path: the siblings met on the way, null
where a node has none. A page of 2^stride nodes is hashed in one group, so that a level takes a
shuffle of its nodes only, and each is 2^stride times smaller than the last. A top node's parent
is its tree's place in the root tree. ``stride=1`` stores all levels.

Climb: a recursive query starts with the leaf rows and joins the node rows again and again; each
step appends the path's siblings and folds them into the hash, which starts as that of the row as
found now (the tampered one). Rows that reached the root carry the proof and the folded root.

Defined results: a null lang is a tree of its own, before all others; a null doc_id comes before
all others, is ``-`` in the leaf and never tampered with; rows of one doc_id are ordered by leaf,
so that repeated rows are leaves beside each other, in any order; a null text differs from an
empty one; a tree of one leaf is that leaf and a table of one language has its subroot as root
(an empty proof is the SHA-256 of nothing); an empty table gives an empty result. Extra columns
do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import doc_id_of, documents, save

STRIDE = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Number of the root tree and of the place above it; the languages' trees count from 0.
ROOT_TREE, ABOVE = -1, -2
#: Node rows above the leaves that the climb may broadcast (a row is about 300 bytes).
BROADCAST_NODES = 100_000

_H = "unhex(sha2(cast({} as binary), 256))"
_HEX = "lower(hex({}))"


def leaf_hash(values: dict[str, Column]) -> Column:
    """Leaf digest (binary) of columns by name."""
    def said(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.unhex(F.sha2(F.concat(*[said(values[f]) for f in FIELDS]).cast("binary"), 256))


def tampered(docs: DataFrame) -> Column:
    """The leaf digest of a row with 1 added to n_chars where 7 divides the CRC-32 of its doc_id."""
    values = {f: docs[f] for f in FIELDS} | {"doc_id": doc_id_of(docs)}
    more = values | {"n_chars": docs["n_chars"].cast("decimal(20,0)") + 1}
    hit = F.crc32(values["doc_id"].cast("string").cast("binary")) % 7 == 0
    return F.when(hit, leaf_hash(more)).otherwise(leaf_hash(values))


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` range-sorted by ``by`` and ``order`` with _part and _row, as a table, and for each
    (by, _part) its _n rows, its first _row and _base, the rows of ``by`` in earlier partitions.
    The second has a row per partition and one more per change of ``by``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in by + order]
    placed = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = save(placed.select("*", F.spark_partition_id().alias("_part"),
                                F.monotonically_increasing_id().alias("_row")), name)
    runs = placed.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))


@dataclass
class Manifest:
    """Tables of a built manifest. ``leaves``: doc_id, digest, probe, subtree and a node row's
    columns. ``nodes``: node rows above the leaves: tree, stage, idx, path and the parent's up_tree,
    up_stage, up_idx. ``subroots``: tree, lang, subroot. ``root``: the digest in hex (None if the
    table is empty). ``n_nodes``: rows of ``nodes``."""
    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None
    n_nodes: int


def _pages(level: DataFrame, stride: int) -> DataFrame:
    """Pages of a level's nodes (tree, idx, digest, n of the tree's nodes, doc_id, probe) with
    ``levels``, the digests of the page's nodes and of all levels up to its top."""
    width = 1 << stride
    pages = (level.where("n > 1").groupBy("tree", F.expr(f"idx div {width}").alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct("idx", "digest", "doc_id", "probe"))).alias("own"),
                  F.max("n").alias("n")))
    one = _H.format("concat(" + _HEX.format("element_at(d, -1)[2 * i]") + ", coalesce("
                    + _HEX.format("get(element_at(d, -1), 2 * i + 1)") + ", ''))")
    up = f"transform(sequence(0, (size(element_at(d, -1)) - 1) div 2), i -> {one})"
    height = f"if(n > {width}, {stride}, length(bin(n - 1)))"
    pages = pages.withColumn("height", F.expr(height))
    return pages.withColumn("levels", F.expr(
        f"aggregate(sequence(1, height), array(own.digest), (d, k) -> concat(d, array({up})))"))


def _grow(level: DataFrame, largest: int, top: tuple[int, Column], stride: int, name: str):
    """Node rows by stage and the trees' roots (tree, digest), from the first level up. ``top`` is
    the parent (tree, place) of a tree's root; trees have at most ``largest`` nodes."""
    width, stages, roots = 1 << stride, [], level.where("n = 1").select("tree", "digest")
    stage = 0
    while largest > 1:
        pages = save(_pages(level, stride), f"{name}-pages")
        last = F.col("n") <= width
        path = "transform(sequence(0, height - 1), k -> get(levels[k], cast(shiftright(_p, k) ^ 1 as int)))"
        stages.append(pages.select("tree", "page", "n", "height", "levels", F.posexplode("own").alias("_p", "_own")).select(
            "tree", F.lit(stage).alias("stage"), F.col("_own.idx").alias("idx"), F.col("_own.digest").alias("digest"),
            F.col("_own.doc_id").alias("doc_id"), F.col("_own.probe").alias("probe"), F.expr(path).alias("path"),
            F.when(last, F.lit(top[0])).otherwise(F.col("tree")).cast("long").alias("up_tree"),
            F.when(last, F.lit(0)).otherwise(F.lit(stage + 1)).alias("up_stage"),
            F.when(last, top[1]).otherwise(F.col("page")).cast("long").alias("up_idx")))
        level = pages.select("tree", F.col("page").alias("idx"), F.element_at(F.element_at("levels", -1), 1).alias("digest"),
                             F.expr(f"(n + {width - 1}) div {width}").alias("n"),
                             F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("probe"))
        roots = roots.unionByName(level.where("n = 1").select("tree", "digest"))
        largest, stage = -(-largest // width), stage + 1
    return stages, roots


def build(docs: DataFrame, probe: Column | None = None, stride: int = STRIDE) -> Manifest:
    """The manifest of ``docs``. ``probe`` is the leaf digest to verify (the row's own if None)."""
    own = leaf_hash({f: docs[f] for f in FIELDS} | {"doc_id": doc_id_of(docs)})
    rows = save(docs.select(doc_id_of(docs).alias("doc_id"), docs["lang"].cast("string").alias("lang"),
                            own.alias("digest"), (own if probe is None else probe).alias("probe")), "merkle-rows")
    placed, runs = numbered(rows, ["lang"], ["doc_id", "digest"], "merkle-leaves")
    runs = save(runs, "merkle-runs")
    langs, lang_runs = numbered(runs.groupBy("lang").agg(F.sum("_n").alias("n")), [], ["lang"], "merkle-langs")
    langs = save(langs.join(lang_runs.drop("_n"), "_part").select(
        "lang", "n", (F.col("_base") + F.col("_row") - F.col("_first")).alias("tree")), "merkle-trees")
    size = langs.agg(F.max("n").alias("largest"), F.count(F.lit(1)).alias("trees")).head()
    trees, largest = size["trees"], size["largest"] or 0
    named = langs.select(F.col("lang").alias("_lang"), "tree", "n")
    runs = runs.join(named, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        F.col("_lang"), F.col("_part").alias("_of"), "_first", "_base", "tree", "n")
    leaves = placed.join(runs, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("_part") == F.col("_of"))).select(
        "tree", (F.col("_base") + F.col("_row") - F.col("_first")).alias("idx"), "digest", "n", "doc_id", "probe")

    # A language's root has its place in the root tree, if there is one.
    above = (ABOVE, F.lit(0))
    top = (ROOT_TREE, F.col("tree")) if trees > 1 else above
    stages, roots = _grow(leaves, largest, top, stride, "merkle")
    alone = leaves.where("n = 1").select(
        "tree", F.lit(0).alias("stage"), "idx", "digest", "doc_id", "probe", F.expr("array(cast(null as binary))").alias("path"),
        F.lit(top[0]).cast("long").alias("up_tree"), F.lit(0).alias("up_stage"), top[1].cast("long").alias("up_idx"))
    alone = alone.withColumn("path", F.slice("path", 1, 0))
    first = alone.unionByName(stages[0]) if stages else alone
    first = save(first.withColumnRenamed("tree", "subtree"), "merkle-leaf-nodes")
    roots = save(roots, "merkle-roots")
    second, root = _grow(roots.select(F.lit(ROOT_TREE).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
                                      F.lit(trees).alias("n"), F.lit(None).cast("long").alias("doc_id"),
                                      F.lit(None).cast("binary").alias("probe")),
                         trees, above, stride, "merkle-root")
    nodes = leaves.limit(0).select("tree", F.lit(0).alias("stage"), "idx", F.expr("array(digest)").alias("path"),
                                   F.col("tree").alias("up_tree"), F.lit(0).alias("up_stage"), F.col("idx").alias("up_idx"))
    for part in stages[1:] + second:
        nodes = nodes.unionByName(part.select(*nodes.columns))
    nodes = save(nodes, "merkle-nodes")
    digest = root.head() if trees else None
    named = langs.withColumnRenamed("tree", "_tree")
    subroots = roots.join(named, F.col("tree") == F.col("_tree")).select("tree", "lang", F.lower(F.hex("digest")).alias("subroot"))
    return Manifest(first, nodes, subroots, bytes(digest["digest"]).hex() if digest else None, nodes.count())


def climb(manifest: Manifest) -> DataFrame:
    """doc_id, subtree, leaf, proof (the siblings met, in order) and folded (the hash at the root,
    from the probe): one row per leaf. Digests are binary."""
    step = _H.format(f"CASE WHEN x IS NULL THEN {_HEX.format('s.h')} WHEN s.i % 2 = 1 THEN "
                     f"concat({_HEX.format('x')}, {_HEX.format('s.h')}) ELSE concat({_HEX.format('s.h')}, {_HEX.format('x')}) END")
    fold = f"aggregate({{path}}, named_struct('h', {{start}}, 'i', {{idx}}), (s, x) -> named_struct('h', {step}, 'i', s.i div 2), s -> s.h)"
    met = "aggregate({path}, cast('' as binary), (a, x) -> concat(a, coalesce(x, cast('' as binary))))"
    hint = "/*+ BROADCAST(n) */" if manifest.n_nodes <= BROADCAST_NODES else ""
    spark = manifest.leaves.sparkSession
    # LIMIT ALL: the session's bound on a recursion's rows does not hold.
    return spark.sql(f"""
        WITH RECURSIVE climb (doc_id, subtree, leaf, tree, stage, idx, proof, folded) AS (
          SELECT doc_id, subtree, digest, up_tree, up_stage, up_idx, {met.format(path='path')},
                 {fold.format(path='path', start='probe', idx='idx')}
          FROM {{leaves}}
          UNION ALL
          SELECT {hint} c.doc_id, c.subtree, c.leaf, n.up_tree, n.up_stage, n.up_idx,
                 concat(c.proof, {met.format(path='n.path')}), {fold.format(path='n.path', start='c.folded', idx='n.idx')}
          FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.stage = n.stage AND c.idx = n.idx)
        SELECT doc_id, subtree, leaf, proof, folded FROM climb WHERE tree = {ABOVE} LIMIT ALL""",
                     leaves=manifest.leaves, nodes=manifest.nodes)


def verify(docs: DataFrame, probe: Column | None = None, stride: int = STRIDE) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    manifest = build(docs, probe, stride)
    text = lambda c: F.lower(F.hex(c))
    got = save(climb(manifest).select(
        "doc_id", "subtree", "leaf", F.unhex(F.sha2(text("proof").cast("binary"), 256)).alias("proof"), "folded"), "merkle-climb")
    root = F.lit(manifest.root).cast("string")
    return got.join(manifest.subroots, F.col("subtree") == F.col("tree")).select(
        "doc_id", text("leaf").alias("leaf"), "subroot", root.alias("root"), text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"), (text("folded") == root).alias("verified"))


def op11_merkle_manifest(spark, sf_dir):
    """Query: proofs of all documents, some of which are tampered with."""
    docs = documents(spark, sf_dir)
    return verify(docs, tampered(docs))


#: CRC-32 of a string in SQL: one step per byte and bit (-1 stands for a bit's turn).
_CRC = ("xor(list_reduce(flatten(list_prepend([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda ch: "
        "[ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) "
        "WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT)")


def _said(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"


SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, {_CRC.format("doc_id::VARCHAR")} % 7 = 0 AS hit FROM documents),
l AS (
  SELECT doc_id, lang, sha256({" || ".join(_said(f) for f in FIELDS)}) AS leaf,
         sha256({" || ".join(_said("(n_chars + CASE WHEN hit THEN 1 ELSE 0 END)" if f == "n_chars" else f) for f in FIELDS)}) AS probe
  FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
tree AS (
  SELECT lang, 0 AS level, idx, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, max(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lang, idx // 2),
subroots AS (
  SELECT lang, max(level) AS level, arg_max(h, level) AS h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM tree GROUP BY lang),
roots AS (
  SELECT 0 AS level, place AS idx, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT max(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 1) // 2
  FROM roots WHERE n > 1 GROUP BY idx // 2),
nodes AS (
  SELECT lang, FALSE AS over, level, idx, h FROM tree UNION ALL SELECT NULL, TRUE, level, idx, h FROM roots),
climb AS (
  SELECT row_number() OVER () AS no, l.doc_id, l.lang, l.leaf, FALSE AS over, 0 AS level, l.idx, l.probe AS h, '' AS proof,
         s.level AS top, s.place
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT c.no, c.doc_id, c.lang, c.leaf, c.over OR c.level = c.top,
         CASE WHEN NOT c.over AND c.level = c.top THEN 0 ELSE c.level + 1 END,
         CASE WHEN NOT c.over AND c.level = c.top THEN c.place ELSE c.idx // 2 END,
         CASE WHEN NOT c.over AND c.level = c.top THEN c.h WHEN c.idx % 2 = 1 THEN sha256(s.h || c.h)
              ELSE sha256(c.h || coalesce(s.h, '')) END,
         CASE WHEN NOT c.over AND c.level = c.top THEN c.proof ELSE c.proof || coalesce(s.h, '') END, c.top, c.place
  FROM climb c LEFT JOIN nodes s ON s.over = c.over AND (c.over OR s.lang IS NOT DISTINCT FROM c.lang)
    AND s.level = c.level AND s.idx = xor(c.idx, 1)
  WHERE NOT c.over OR c.level < (SELECT max(level) FROM roots)),
root AS (SELECT arg_max(h, level) AS root, max(level) AS level FROM roots)
SELECT c.doc_id, c.leaf, s.h AS subroot, r.root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = r.root AS verified
FROM climb c JOIN root r ON c.over AND c.level = r.level JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang
"""
