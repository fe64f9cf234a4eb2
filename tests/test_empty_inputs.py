"""Every aggregate-style operator returns well-defined rows on empty input."""
from pyspark.sql import functions as F

from lakeward.operators import checks as K
from lakeward.operators.audit import AuditTarget, load_audit
from lakeward.operators.scd2 import reference_overlaps, scd2_history, split_counts, strict_overlaps


def test_empty_inputs(spark):
    ev = spark.createDataFrame([], "k string, seq timestamp, t string, u int")
    h = scd2_history(ev, ["k"], "seq", ["t"])
    assert h.count() == 0
    s = split_counts(h, ["k"]).collect()[0]
    assert (s.current_rows, s.historical_rows, s.total_rows, s.distinct_keys) == (0, 0, 0, 0)
    assert reference_overlaps(h, ["k"]).collect()[0].pairs == 0
    assert strict_overlaps(h, ["k"]).collect()[0].overlaps == 0
    m = {r.check_id: r for r in K.measure_table(ev, "t", [
        K.non_empty(), K.named_share("t", "k", 80.0), K.completeness("t", "QA-23"),
        K.freshness("seq", F.current_timestamp(), 24.0, empty_status=K.WARN)]).collect()}
    assert m["QA-11"].status == "FAIL" and m["QA-16"].status == "FAIL"
    assert m["QA-23"].metric == 0.0 and m["QA-10"].status == "WARN"
    assert K.duplicate_keys(ev, "t", ["k"]).collect()[0].metric == 0.0
    fk = K.foreign_key(ev, "t", "k", ev, "p", "k").collect()[0]
    assert fk.status == "PASS" and fk.metric == 0.0
    r = K.reconcile(ev, ev, "t", max_drop_pct=5.0).collect()[0]
    assert r.metric == 0.0 and r.status == "PASS"
    a = load_audit([(ev, AuditTarget("bronze_t", ("k",), ("k",), stamp="seq"))]).collect()[0]
    assert a.rows_loaded == 0 and a.load_timestamp is None and a.new_columns_added == "seq,t,u"
