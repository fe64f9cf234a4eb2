import re

from pyspark.sql import functions as F

from lakeward.llm import mixing as M
from conftest_llm import ODD, docs, many  # noqa: F401


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Targets by resharing until no source is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: 2.0 * sizes[s] for s in over}


def rows_of():
    out = ODD + many(6, 200)
    out += [(1000 + i, "word " * (i % 7), s) for i, s in enumerate(["ü", "Z", "a", None, "tiny"] * 30)]
    return out + [(2000, "only " * 5, "one"), (2001, "", "nothing")]


def test_targets_and_words_taken(docs):
    rows = rows_of()
    sizes = {}
    for r in rows:
        s = r[2] if len(r) > 2 else "s"
        sizes[s] = sizes.get(s, 0) + size(r[1])
    want = plain_targets(sizes)
    got = M.queue(M.sizes_of(docs(rows))).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.size <= 2 * r.size and 0 <= r.first + r.second <= 2 * r.size
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.first + r.second
    for s, words in taken.items():
        assert abs(words - want[s]) <= 0.5
    assert abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1e-6


def test_query_rows_agree_in_reruns_and_are_sorted(docs):
    rows = rows_of()
    one, two = (M.mix(docs(rows).repartition(n)).collect() for n in (1, 7))
    assert sorted(map(str, one)) == sorted(map(str, two))
    places = [r.position for r in one if r.position is not None]
    assert places == sorted(places)
    total = sum(r.taken for r in one)
    assert all(0 <= p <= total for p in places)
    assert all((r.position is None) == (r.taken == 0) for r in one)


def test_inverting_the_schedule(spark):
    """The demand at the time found equals the queued words."""
    t = spark.range(101).select((F.col("id") * 10.0).alias("q"))
    for c in M.SLOPES:
        for r in t.select("q", M._time(F.col("q"), F.lit(1000.0), F.lit(c)).alias("t")).collect():
            assert abs(1000 * ((1 - c) * r.t + c * r.t * r.t) - r.q) < 1e-6


def test_mixed_documents_come_as_often_as_taken(docs):
    rows = rows_of()
    table = docs(rows).withColumn("copies", F.lit(1)).withColumn("rows", F.lit(2)).withColumn("row", F.lit("r"))
    got = M.mixed_documents(table)
    assert got.columns == table.columns
    want = M.queue(M.sizes_of(docs(rows))).selectExpr(
        "doc_id", "int(size > 0 and 2 * first >= size) + int(size > 0 and 2 * second >= size) as n").collect()
    n = {}
    for r in want:
        n[r.doc_id] = n.get(r.doc_id, 0) + r.n
    found = {}
    for r in got.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {k: v for k, v in n.items() if v} and 2 in n.values() and 0 in n.values()


def test_mixed_documents_come_in_training_order(docs):
    """Each pass stands where the curriculum puts it; repeated rows keep a time each."""
    rows = [(i, f"word {i} " + "x " * (i % 9), f"s{i % 3}") for i in range(300)] + [(400, "a b c", "s0")] * 3
    want = []
    for r in M.queue(M.sizes_of(docs(rows))).collect():
        for taken, ahead in ((r.first, r.before), (r.second, r.before + r.source_size)):
            if 2 * taken >= r.size:
                x, c = min(1.0, ahead / r.target), r.slope
                time = 2 * x / ((1 - c) + ((1 - c) ** 2 + 4 * c * x) ** 0.5)
                want.append((round(time, 9), r.doc_id, r.source))
    want.sort()
    for n in (1, 5):
        got = M.mixed_documents(docs(rows).repartition(n)).collect()
        assert [(r.doc_id, r.source) for r in got] == [w[1:] for w in want]
    # s0 comes later, s2 earlier in training (in words; s1 evenly).
    half = sum(size(r.text) for r in got) / 2
    words, early = 0, {"s0": 0, "s1": 0, "s2": 0}
    for r in got:
        words += size(r.text)
        if words <= half:
            early[r.source] += size(r.text)
    share = {s: early[s] / sum(size(r.text) for r in got if r.source == s) for s in early}
    assert share["s0"] < 0.47 < 0.5 < share["s2"]


def test_rows_of_other_sources_are_mixed_as_their_own(docs):
    """Alike in doc_id and text, unlike in source: each comes as often as its own source takes it."""
    rows = [(1, "a b c d", s) for s in ("p", "q", "r", None)]
    table = docs(rows)
    want = {r.source: int(2 * r.first >= r.size) + int(2 * r.second >= r.size) for r in M.queue(M.sizes_of(table)).collect()}
    got = [r.source for r in M.mixed_documents(table).collect()]
    assert {s: got.count(s) for s in want} == want


def test_no_source_in_one_bucket(docs):
    rows = [(i, "a b", "hot") for i in range(2000)]
    assert M.queue(M.sizes_of(docs(rows))).select("bucket").distinct().count() >= 2000 // M.BUCKET


def test_main_path_is_native(docs):
    plan = M.mix(docs(many(1, 20)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty(docs):
    assert M.mix(docs([])).collect() == [] and M.mixed_documents(docs([])).collect() == []
