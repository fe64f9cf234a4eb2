"""EXP-01..03, FLT-01..08: warn counts, drop removes, NULL predicate is a violation, one
drop per row."""
from pyspark.sql import Observation

from lakeward.operators.expectations import expect, observed_counts, rule_metrics
from lakeward.specs import DROP, WARN, Rule

RULES = [Rule("valid_id", "id IS NOT NULL AND id LIKE 'nm%'", DROP),
         Rule("valid_len", "LENGTH(id) BETWEEN 9 AND 12", DROP),
         Rule("positive", "n IS NULL OR n > 0", WARN),
         Rule("rating", "r >= 1.0 AND r <= 10.0", DROP)]


def frame(spark):
    return spark.createDataFrame([
        ("nm0000001", 5, 1.0), ("xx0000001", 5, 2.0), (None, 5, 3.0), ("nm00001", 0, 4.0),
        ("nm0000002", 0, None), ("nm0000003", None, 10.0), ("xx00001", -1, 11.0)],
        "id string, n int, r double")


def test_drop_and_warn(spark):
    obs = Observation("m")
    kept = expect(frame(spark), RULES, obs)
    assert sorted(r.id for r in kept.collect()) == ["nm0000001", "nm0000003"]
    counts = {c["rule"]: c["failed"] for c in observed_counts(obs, RULES)}
    # violations are counted on every projected row, before any drop
    assert counts == {"valid_id": 3, "valid_len": 3, "positive": 3, "rating": 2}
    assert obs.get["dropped"] == 5  # a row failing several drop rules is dropped once


def test_rule_metrics_single_pass(spark):
    m = {r.rule: (r.passed, r.failed) for r in rule_metrics(frame(spark), RULES).collect()}
    assert m["valid_id"] == (4, 3) and m["rating"] == (5, 2)


def test_warn_keeps_everything(spark):
    from lakeward.operators.expectations import expect_warn
    assert expect_warn(frame(spark), RULES).count() == 7
