import hashlib
import re

import numpy as np
import pytest

from lakeward.llm import fingerprints as P
from conftest_llm import ODD, docs, many  # noqa: F401


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def share(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_print(text):
    """The method one bin at a time, from the shingle hashes."""
    hashes = P.shingle_hashes(P.words_of([text.encode()])[0]).tolist()
    if not hashes:
        return bytes(P.BINS * P.BITS // 8)
    least = {}
    for h in hashes:
        b, v = h >> 55, h & (1 << 55) - 1
        least[b] = min(v, least.get(b, v))
    order, codes = P._orders(P.BINS), []
    for i in range(P.BINS):
        j = i if i in least else next(int(j) for j in order[i] if int(j) in least)
        v = np.array([(least[j] + (i + 1) * P._BASE) % 2**64], np.uint64)
        codes.append(int(P.mix(v)[0]) & 15)
    return bytes(codes[k] << 4 | codes[k + 1] for k in range(0, P.BINS, 2))


def brute(rows):
    """doc_id, n_chars, edited_sha256, fingerprints and likeness, each row followed by the next."""
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).digest()))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        third = len(text) // 3
        new = text[:len(text) - third] + following[:third]
        a, b, c = (np.frombuffer(plain_print(t), np.uint8)[None] for t in (text, new, following))
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
                    float(P.likeness(a, b)[0]), float(P.likeness(a, c)[0])))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_matches_brute_force(docs, parts, monkeypatch):
    rows = ODD + many(8, 40) + [(900, "ÄÖ ß 日本 " * 30), (901, "\U0001f600" * 50)]
    assert rows_of(P.edit_report(docs(rows).repartition(parts))) == brute(rows)


def test_rows_of_a_hot_doc_id_and_copies(docs, monkeypatch):
    monkeypatch.setattr(P, "HOT", 3)
    rows = [(7, "same text of some words here")] * 9 + [(7, f"other {i} a b c d e f") for i in range(4)] + [(None, None)] * 5 + many(9, 12)
    want = brute(rows)
    assert rows_of(P.edit_report(docs(rows))) == want
    monkeypatch.setattr(P, "BROADCAST_IDS", 0)
    assert rows_of(P.edit_report(docs(rows))) == want


def test_one_document_follows_itself_and_none(docs):
    assert rows_of(P.edit_report(docs([(1, "abcdefghi j")]))) == brute([(1, "abcdefghi j")])
    assert P.edit_report(docs([])).collect() == []


def test_likeness_estimates_the_share_of_common_shingles():
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(2000)]
    errors = []
    for n in (1, 3, 6, 12, 40, 200, 1500):
        for _ in range(30):
            a = list(rng.choice(vocabulary, n))
            keep = int(n * rng.random())
            b = a[:keep] + list(rng.choice(vocabulary, n - keep))
            x, y = P.fingerprint_texts([" ".join(a).encode(), " ".join(b).encode()])
            errors.append(float(P.likeness(x[None], y[None])[0]) - share(" ".join(a), " ".join(b)))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.12 and np.std(errors) < 0.03


def test_likeness_of_nothing_and_of_single_words():
    texts = [b"", b" \t", b"alone"] + [f"w{i}".encode() for i in range(200)]
    fp = P.fingerprint_texts(texts)
    assert P.likeness(fp[:1], fp[1:2])[0] == 1 and P.likeness(fp[:1], fp[2:3])[0] == 0
    assert P.likeness(np.repeat(fp[2:3], 200, 0), fp[3:]).max() < 0.1


def test_pieces_change_nothing(monkeypatch):
    texts = [("word%d " % i * 50).encode() for i in range(20)] + ["x".encode() * 9000, b"", ("é " * 700).encode()]
    whole = P.fingerprint_texts(texts)
    monkeypatch.setattr(P, "PIECE", 64)
    monkeypatch.setattr(P, "TEXTS", 3)
    assert (P.fingerprint_texts(texts) == whole).all()


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_codes_of_other_sizes(bits):
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + [f"v{i}" for i in range(100)])
    x, y = P.fingerprint_texts([a.encode(), b.encode()], 1024, bits)
    assert len(x) == 128 * bits
    assert abs(float(P.likeness(x[None], y[None], bits)[0]) - share(a, b)) < 0.12


def test_columns_of_fingerprints(docs):
    fp = P.fingerprints(docs([(1, "a b c d e f g"), (2, None)]))
    got = fp.select("doc_id", P.likeness_of(fp["fingerprint"], fp["fingerprint"]).alias("same")).collect()
    assert {(r.doc_id, r.same) for r in got} == {(1, 1.0), (2, 1.0)}


def test_bytes_that_are_no_utf8():
    assert P.edited(b"ab\xffcde", b"\xfe\xfdx") == (6, b"ab\xffc\xfe\xfd")
