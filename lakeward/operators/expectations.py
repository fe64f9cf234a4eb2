"""Data-quality expectations: warn rules count, drop rules remove (EXP-01..03, FLT-*).

A rule is a SQL predicate over the projected row. A predicate that evaluates to NULL
is a violation for both kinds (``NULL_PASSES`` switches that in one place). Violations
are counted on the projected row *before* any drop rule is applied, and a row that
fails several drop rules is dropped once.

Counting never costs a second scan: ``observe`` attaches the counters to the same
pass that writes the table (batch: an ``Observation``; streaming: named metrics in
the query progress). ``rule_metrics`` is the stand-alone single-aggregate form.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeward.specs import DROP, WARN, Rule

NULL_PASSES = False


def passes(rule: Rule) -> Column:
    """True when the row satisfies the rule (NULL resolved by ``NULL_PASSES``). Rules are SQL
    predicates (FN-16: IS NULL, IN, LIKE, LENGTH, BETWEEN, RLIKE)."""
    return F.coalesce(F.expr(rule.predicate), F.lit(NULL_PASSES))


def violates(rule: Rule) -> Column:
    return ~passes(rule)


def metric_exprs(rules: Sequence[Rule]) -> list[Column]:
    """``rows``, ``failed_<rule name>`` per rule and ``dropped`` (rows failing any drop rule)."""
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError(f"rule names must be unique: {names}")
    out = [F.count(F.lit(1)).alias("rows")]
    out += [F.count_if(violates(r)).alias(f"failed_{r.name}") for r in rules]
    drops = [r for r in rules if r.action == DROP]
    if drops:
        out.append(F.count_if(~keep_condition(drops)).alias("dropped"))
    return out


def keep_condition(rules: Sequence[Rule]) -> Column:
    drops = [passes(r) for r in rules if r.action == DROP]
    return reduce(lambda a, b: a & b, drops) if drops else F.lit(True)


def expect(df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None
           ) -> DataFrame:
    """EXP-01/02/03: count every rule's violations, then drop rows failing a drop rule.

    ``observation`` may be an ``Observation`` (batch) or a name (streaming metrics).
    """
    rules = list(rules)
    if not rules:
        return df
    if observation is not None:
        df = df.observe(observation, *metric_exprs(rules))
    if any(r.action == DROP for r in rules):
        df = df.filter(keep_condition(rules))
    return df


def expect_warn(df: DataFrame, rules: Sequence[Rule], observation=None) -> DataFrame:
    """EXP-01: warn-only; all rows are kept."""
    return expect(df, [Rule(r.name, r.predicate, WARN) for r in rules], observation)


def observed_counts(obs: Observation, rules: Sequence[Rule]) -> list[dict]:
    """Read an ``Observation`` (after an action) into one dict per rule."""
    m = obs.get
    rows = m.get("rows", 0)
    return [{"rule": r.name, "action": r.action, "failed": int(m.get(f"failed_{r.name}", 0)),
             "passed": int(rows) - int(m.get(f"failed_{r.name}", 0))}
            for r in rules]


def rule_metrics(df: DataFrame, rules: Sequence[Rule], dataset: str | None = None) -> DataFrame:
    """One aggregate pass -> one row per rule: (dataset, rule, action, passed, failed)."""
    rules = list(rules)
    agg = df.agg(*metric_exprs(rules))
    entries = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                        (F.col("rows") - F.col(f"`failed_{r.name}`")).alias("passed"),
                        F.col(f"`failed_{r.name}`").alias("failed"))
               for r in rules]
    out = agg.select(F.explode(F.array(*entries)).alias("m")).select("m.*")
    if dataset is not None:
        out = out.select(F.lit(dataset).alias("dataset"), "*")
    return out
