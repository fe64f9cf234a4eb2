import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import lm_score as S
from conftest_llm import ODD, docs, many  # noqa: F401


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows):
    counts = Counter()
    for d, t, *_ in rows:
        if not is_held(d):
            counts.update(tokens(t) + [None])
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for d, t, *_ in rows:
        own = tokens(t) + [None]
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        out.append((d, is_held(d), len(own), sum(counts[w] > 0 for w in own), total, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("known,classes", [(1 << 17, 1024), (40, 16)])
def test_counts_and_base_match_brute_force(docs, monkeypatch, known, classes):
    monkeypatch.setattr(S, "KNOWN", known)
    monkeypatch.setattr(S, "CLASSES", classes)
    monkeypatch.setattr(S, "STEPS", 20)
    monkeypatch.setattr(S.frequent, "__defaults__", (known,))
    monkeypatch.setattr(S.train, "__defaults__", (classes, 8, 20, 9))
    rows = ODD + many(5, 80) + [(800, "x" * 5000 + " Unseen " + "the of " * 3000)]
    got = sorted((tuple(r) for r in S.score(docs(rows)).collect()), key=str)
    want = brute(rows)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5]))):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert g[6] < 0


def test_probabilities_sum_to_one_and_beat_unigrams():
    rng = np.random.default_rng(0)
    c = 20
    truth = rng.dirichlet(np.full(c, 0.1), c)
    n = np.rint(truth * 100_000).astype(int)
    pair = np.flatnonzero(n.ravel())
    table = S.train(pair, n.ravel()[pair], c, 16, 1500)
    assert np.allclose((10 ** table).sum(1), 1)
    unigram = n.sum(0) / n.sum()
    model = (n * table).sum() / n.sum()
    plain = (n * np.log10(unigram)[None, :]).sum() / n.sum()
    best = (n * np.log10(np.maximum(truth, 1e-12))).sum() / n.sum()
    assert model > plain + 0.7 * (best - plain)


def test_model_beats_the_base_on_held_out_texts(docs):
    import random
    rnd = random.Random(1)
    follow = {i: [rnd.randrange(40) for _ in range(3)] for i in range(40)}
    rows = []
    for d in range(300):
        w, text = rnd.randrange(40), []
        for _ in range(60):
            text.append(f"w{w}")
            w = rnd.choice(follow[w])
        rows.append((d, " ".join(text)))
    got = [r for r in S.score(docs(rows)).collect() if r.held_out]
    assert len(got) > 10 and sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)
    assert all(r.score > r.base_score for r in got)


def test_other_words_share_the_rest(docs):
    """The model's probabilities of all words after a word sum to one, with one unseen."""
    rows = many(5, 80)
    counts, shared, facts = S.fit(docs(rows))
    words, number, table, _ = shared.value
    rest = {bytes(r.word): r.n for r in counts.collect()}
    inside = words[:S.CLASSES - 2]
    other = [n for w, n in rest.items() if w not in set(inside)]
    share = sum(n + 0.1 for n in other) + 0.1
    assert abs(share - facts["rare_mass"]) < 1e-6
    assert np.allclose((10 ** table).sum(1), 1)


def test_extra_columns_and_empty(docs):
    table = docs(many(1, 10)).withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("key", F.lit(3))
    assert S.score(table).count() == 10
    assert S.score(docs([])).collect() == []


def chain(n_words, n_docs, seed):
    import random
    rnd = random.Random(seed)
    rows = []
    for d in range(n_docs):
        w, text = rnd.randrange(n_words), []
        for _ in range(60):
            text.append(f"w{w}")
            w = rnd.choice([(w * 7 + k) % n_words for k in (1, 2)])
        rows.append((d, " ".join(text)))
    return rows


def test_words_outside_the_classes_have_contexts(docs, monkeypatch):
    """With eight classes and forty words, nearly all words are others, known or not."""
    monkeypatch.setattr(S, "CLASSES", 8)
    for known in (1 << 17, 12):
        monkeypatch.setattr(S.frequent, "__defaults__", (known,))
        got = [r for r in S.score(docs(chain(40, 300, 1))).collect() if r.held_out]
        tokens_ = sum(r.n_tokens for r in got)
        assert (sum(r.score for r in got) - sum(r.base_score for r in got)) / tokens_ > 0.2


def test_every_training_pair_counts():
    """A context of a few hundred in a thousand million pairs, which a sample of three million
    hardly meets, is learned."""
    n = np.zeros((6, 6), np.int64)
    n[0, 3:] = 3 * 10 ** 8
    n[2, 3] = 300
    pair = np.flatnonzero(n.ravel())
    table = S.train(pair, n.ravel()[pair], 6, 8, 800)
    assert np.allclose((10 ** table).sum(1), 1) and table[2, 3] > np.log10(0.7)


def test_shares_of_other_words_sum_to_one(docs, monkeypatch):
    monkeypatch.setattr(S, "CLASSES", 8)
    counts, shared, facts = S.fit(docs(chain(40, 60, 2)))
    words, number, table, told = shared.value
    after = {(bytes(r.word), r.g): r.n for r in facts["other"].collect()}
    assert sum(after.values()) == sum(r.n for r in counts.collect()) - number[:6].sum()
    s = facts["strength"]
    for g in range(S.GROUPS):
        own = sum(10.0 ** told["rare"][i, g] for i in range(6, len(words)))
        unseen = s * S.SMOOTH / facts["rare_mass"] / (facts["whole"][g] + s)
        assert abs(own + unseen - 1) < 1e-5


def test_numbers_of_a_word_stand_in_one_row(docs, monkeypatch):
    """Words beyond the known ones meet all their numbers in one join: a row per word, with a
    number for each group that sums to the word's count."""
    monkeypatch.setattr(S, "CLASSES", 8)
    counts, shared, facts = S.fit(docs(chain(40, 60, 2)))
    after = {bytes(r.word): list(r.after) for r in facts["after"].collect()}
    inside = set(shared.value[0][:6])
    assert {w: sum(a) for w, a in after.items()} == {bytes(r.word): r.n for r in counts.collect() if bytes(r.word) not in inside}
    assert len(after) == facts["after"].count() and all(len(a) == S.GROUPS for a in after.values())
    monkeypatch.setattr(S.frequent, "__defaults__", (12,))
    plan = S.score(docs(chain(40, 60, 2)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # only that of documents and sums is left
