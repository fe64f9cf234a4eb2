import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from lakeward.llm import quality as Q
from conftest_llm import ODD, docs, many  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)}
    measures = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated))
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    letters = upper + lower + sum(ord(c) > 127 for c in text)
    other = (10 * measures[2] > 3 * len(words) or 2 * measures[3] > len(lines) or 10 * upper > 6 * (upper + lower)
             or measures[1] > 40 * len(words) or 3 * letters < measures[1]
             or 2 * sum(a == b for a, b in zip(words, words[1:])) > len(words))
    return (*measures, failed, not failed and not other)


JUNK = [(900, "A! B! " * 30), (901, "x\ny\nx\nx\n" * 20 + "\n  \n"), (902, "$$$ ### " * 40), (903, "WORDS LOUD " * 3 + many(9, 1)[0][1].upper() * 2),
        (904, "a b c d e f g h i j " * 4), (905, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21"), (906, "é" * 3000), (907, " ".join(f"word{i // 6}" for i in range(60)))]


def test_measures_and_verdict_match_brute_force_in_any_order(docs):
    rows = ODD + many(4) + JUNK
    want = sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    for order in (None, list(Q.default_rules()), list(reversed(Q.default_rules()))):
        got = sorted((tuple(r) for r in Q.judge(docs(rows), order).collect()), key=str)
        assert got == want
    assert {r[-1] for r in want} == {True, False}


def test_sql_says_the_same(docs):
    rows = ODD + many(4) + JUNK
    con = duckdb.connect()
    con.register("documents", docs(rows).toPandas().astype({"doc_id": "Int64"}))
    got = sorted(con.execute(Q.SQL).fetchall(), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)


def test_a_text_stops_at_its_first_failure():
    tried = []
    rules = {n: (lambda t, n=n: tried.append(n) or n == "b") for n in "abc"}
    assert Q.first_failure(Q.Text(b""), ["a", "b", "c"], rules) == "b" and tried == ["a", "b"]


def test_order_prefers_cheap_rules_that_reject(docs):
    import time
    rules = {"slow": lambda t: time.sleep(0.002) or True, "idle": lambda t: False, "quick": lambda t: True}
    assert Q.cascade_order(docs(many(5)), rules) == ["quick", "slow", "idle"]


def test_keep_good_keeps_all_columns(docs):
    rows = ODD + many(4) + JUNK
    table = docs(rows).withColumn("kept", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = Q.keep_good(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if brute(r[1])[-1])


def test_empty(docs):
    assert Q.judge(docs([])).collect() == [] and Q.keep_good(docs([])).collect() == []


def test_clean_texts_of_other_scripts_are_kept(docs):
    cyrillic = " ".join(f"слово{chr(0x430 + i)} и ещё{chr(0x430 + i)}" for i in range(20)) + " NASA"
    greek = " ".join(f"λόγος{chr(0x3b1 + i)}" for i in range(24)) + " NASA"
    arabic = " ".join(f"كلمة{chr(0x628 + i)}" for i in range(22)) + " NATO"
    hindi = " ".join(f"शब्द{chr(0x915 + i)}" for i in range(24)) + " UNESCO"
    chinese = " ".join("".join(chr(0x4e00 + 61 * i + 7 * k) for k in range(50)) + "。" for i in range(24)) + " NASA"
    japanese = " ".join("".join(chr(0x3041 + (i * k + k) % 80) for k in range(55)) + "。" for i in range(24))
    thai = " ".join("".join(chr(0xe01 + (i * k + k) % 40) for k in range(60)) for i in range(24))
    rows = [(i, t) for i, t in enumerate((cyrillic, greek, arabic, hindi, chinese, japanese, thai))]
    assert {r.doc_id for r in Q.judge(docs(rows)).collect() if r.kept} == set(range(7))
    assert Q.keep_good(docs(rows)).count() == 7
    loud = [(1, " ".join(f"{w}{chr(65 + i)}" for i, w in enumerate(["LOUD"] * 24))), (2, " ".join(f"{i:050x}" for i in range(24)) + " x y z")]
    assert not any(r.kept for r in Q.judge(docs(loud)).collect())
