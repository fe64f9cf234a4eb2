import hashlib
import random
import re

from lakeward.llm import personal_data as D
from conftest_llm import ODD, docs, many  # noqa: F401

CONTRACT = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in text.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    spans = [(k, m.start(), m.end()) for k, p in CONTRACT for m in re.finditer(p, text or "") if good(k, m[0])]
    n = tuple(sum(s[0] == k for s in spans) for k, _ in CONTRACT)
    return (*n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())


CASES = ["a@b.c", "x a.b+c@d-e.f.g, y@z y@z..w @a.b a@b.c_d@e.f a@b@c.d %@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.255 1.2.3",
         "4111 1111 1111 1111 and 4111-1111-1111-1112 411111111111111 1 2 3", "+1 (974) 555-3436 +12 +1234567890123456 ++1 234 567 89",
         "é日\U0001f600 a@b.co \U0001f600 10.0.0.1 +49 (30) 123-456", "4111111111111111" * 3, "a" * 20000 + "@", "1" * 3000 + ".",
         "1 2 " * 5000, "a@b.c " * 1500, "5@5.5.5.5.5", "1.1.1.1" * 4, "GB82 WEST 1234 5698 7654 32 iban", "DE89370400440532013000",
         "DE89370400440532013001 xDE89370400440532013000", "999999999999999999999.1.1.1 1.1.1.0000000000000000000000000000000000000000000255",
         "5500 0000 0000 0004, 340000000000009; 6011-0000-0000-0004 3088000000000009",
         "line\n4111 1111\n1111 1111 +1 234\n56789"]


def noise(seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices("0123456789.@ab+- ()_\né", weights=[3] * 10 + [5, 2, 2, 2, 3, 3, 5, 1, 1, 1, 1, 1], k=120))
            for _ in range(300)]


def test_base_spans_match_the_contract(docs):
    texts = CASES + noise(1) + [r[1] for r in ODD + many(1, 10)]
    rows = list(enumerate(texts))
    got = sorted(tuple(r)[:6] for r in D.personal_data(docs(rows)).collect())
    want = sorted((i, *brute(t)) for i, t in rows)
    assert got == want
    assert all(sum(w[k] for w in want) > 2 for k in range(1, 5))


def test_method_adds_confirmed_ibans_only(docs):
    rows = [(1, "pay to GB82 WEST 1234 5698 7654 32."), (2, "DE89370400440532013000"), (3, "DE89370400440532013001"),
            (4, "xDE89370400440532013000")]
    got = {r.doc_id: r.spans for r in D.personal_data(docs(rows)).collect()}
    assert got[1] == "iban:7:34" and got[2] == "iban:0:22" and got[3] == got[4] == ""


def test_nearby_words_raise_the_score(docs):
    rows = [(1, "call my phone +1 (974) 555-3436"), (2, "x +1 (974) 555-3436 y"), (3, "+1 (974) 555-3436 is the tel"),
            (4, "telephone" + "x" * 50 + " +1 (974) 555-3436"), (5, "none")]
    got = {r.doc_id: round(r.score, 6) for r in D.personal_data(docs(rows)).collect()}
    assert got == {1: 0.7, 2: 0.6, 3: 0.7, 4: 0.6, 5: 0.0}


def test_checks():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_main_path_is_native(docs):
    plan = D.personal_data(docs(many(1, 20)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty(docs):
    assert D.personal_data(docs([])).collect() == []


def test_sql_says_the_same(docs):
    import duckdb
    texts = [t for t in CASES + noise(2) + [r[1] for r in ODD + many(1, 10)] if t is None or len(t) < 3000]
    texts += ["call my phone +1 (974) 555-3436", "my iban is DE89370400440532013000"]
    table = docs(list(enumerate(texts)))
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    got = sorted((*r[:7], round(r[7], 9)) for r in con.execute(D.SQL).fetchall())
    assert got == sorted((*r[:7], round(r[7], 9)) for r in map(tuple, D.personal_data(table).collect()))


def test_ibans_end_where_their_country_says(docs):
    iban = "DE89 3704 0044 0532 0130 00"
    rows = list(enumerate([f"{iban} BIC COBADEFFXXX", f"{iban} EUR", f"{iban} 2024", f"{iban} GB82 WEST 1234 5698 7654 32", f"{iban}."]))
    got = {r.doc_id: r.spans.split(",iban:") for r in D.personal_data(docs(rows)).collect()}
    assert all("iban:0:27" in ",iban:".join(got[i]) for i in range(5)) and got[3][-1] == "28:55"
