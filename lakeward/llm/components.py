"""Connected components of a link table, by contraction.

Each round hooks every vertex to its smallest neighbour, follows these hooks to their ends
(pointer doubling), and replaces the ends of every link by what they hooked to. Links that
fall on one vertex are gone; the rest go into the next round, until none is left. Minima are
partial aggregates, so a vertex with very many links sends one row per task; joins have the
small side written first, so that skewed partitions of the other side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import save


def _doubled(parents: DataFrame) -> DataFrame:
    """Follow the hooks (node, to) to their ends."""
    while True:
        far = parents.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
        step = save(parents.join(far, F.col("to") == F.col("_n"), "left").select(
            "node", F.coalesce("_t", "to").alias("to"),
            (F.coalesce("_t", "to") != F.col("to")).alias("moved")), "hooks")
        parents = step.select("node", "to")
        if step.where("moved").isEmpty():
            return parents


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every vertex of ``links`` (a, b: long); the label is the same for
    all vertices of a component. Null ends and loops are no links."""
    links = save(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("to")), "hooks")
        hooks = _doubled(hooks)
        if labels is None:
            labels = hooks.select("node", F.col("to").alias("label"))
        else:
            onward = hooks.select(F.col("node").alias("_label"), "to")
            labels = save(labels.join(onward, F.col("label") == F.col("_label"), "left").select(
                "node", F.coalesce("to", "label").alias("label")), "labels")
        one = hooks.select(F.col("node").alias("a"), F.col("to").alias("_a"))
        two = hooks.select(F.col("node").alias("b"), F.col("to").alias("_b"))
        links = save(links.join(one, "a").join(two, "b").where("_a <> _b")
                     .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
                     .distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
