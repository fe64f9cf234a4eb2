"""Rows and the fixture that several tests use (a module of its own: the tests above this folder
import their own ``conftest`` by name)."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()))])


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, schema=DOCUMENTS):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)
    return make


#: Nulls, empty texts, white space, repeated rows, ties.
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (4, "one"), (5, "one "), (None, "one"), (None, None),
       (6, "é日本\U0001f600 x"), (7, None, None), (2, "")]


def many(seed=1, n=60):
    """Prose-like documents with copies, near copies and shared passages."""
    import random
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "and"] + ["".join(rnd.choices("aeiorstnl", k=rnd.randint(3, 8))) for _ in range(300)]
    prose = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    passage = prose(120)
    out = []
    for i in range(n):
        text = prose(rnd.randint(1, 200))
        if i % 5 == 1:
            text = out[rnd.randrange(len(out))][1]
        elif i % 5 == 2:
            words = out[rnd.randrange(len(out))][1].split(" ")
            words[rnd.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif i % 5 == 3:
            text = f"{prose(20)}. {passage} {prose(rnd.randint(1, 30))}"
        out.append((100 + i, text, f"s{i % 4}"))
    return out
