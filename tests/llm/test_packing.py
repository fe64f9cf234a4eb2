import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakeward.llm import packing as P
from conftest_llm import ODD, docs, many  # noqa: F401

TEXTS = ["", "It's DON'T we'll 'd ''s !'s", "<|endoftext|> a<|startoftext|>b", "a\x1cb\x85c\xa0d　e", "é é ÀÉÎ ß ẞ İ ı",
         "ΑΣ ΣΑΣ σς ΟΔΟΣ", "日本語 한국 \U0001f600\U0001f44d\U0001f3fd", "1234 5.6 v2_0 a_b", "“quotes” – dash… •", "x" * 5000,
         "word\n\n\tword\r\nWORD", "ñandú-Ñ ǅ ﬁ", "á ñ", "Ⅷ ⅷ ℵ Å K"]


def test_ids_are_the_tokenizers():
    path = P.default_tokenizer()
    tok = Tokenizer.from_file(path)
    for text in TEXTS + [r[1] for r in many(3, 50)]:
        assert np.frombuffer(P.token_bytes(text, path), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def check(rows, got, room):
    tok = Tokenizer.from_file(P.default_tokenizer())
    want = []
    for doc_id, text, *_ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), room)):
            part = ids[at:at + room]
            want.append((doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    return len(bins), sum(w[3] for w in want)


@pytest.mark.parametrize("group_rows", [8192, 20])
def test_pieces_and_sequences(docs, group_rows):
    rows = ODD + many(7, 150) + [(500, "long text " * 900)]
    got = P.pack(docs(rows), room=256, group_rows=group_rows).collect()
    bins, total = check(rows, got, 256)
    assert bins <= -(-total // 256) * 1.06 + 2


def test_local_search_keeps_pieces_and_never_adds_bins():
    rng = np.random.default_rng(1)
    for room, low, high in ((100, 1, 60), (2048, 200, 1200), (100, 26, 49), (50, 1, 50)):
        lengths = rng.integers(low, high, 400)
        first = P.best_fit(lengths, room)
        squares = lambda bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
        before = squares(first)
        bins = P.improve([list(b) for b in first], lengths, room)
        assert sorted(i for b in bins for i in b) == list(range(400))
        assert all(lengths[b].sum() <= room for b in bins)
        assert len(bins) <= len(first) and squares(bins) >= before


def test_local_search_empties_a_bin_by_each_kind_of_change():
    one = np.array([6, 3, 5, 4, 1])       # [6,3] [5,4] [1]: the 1 moves
    assert len(P.improve([[0, 1], [2, 3], [4]], one, 10)) == 2
    two = np.array([5, 4, 3, 3, 2, 2])    # [5,4] gives its 4 for 3 + 2, which fits 10
    bins = P.improve([[0, 1], [2, 3, 4], [5]], two, 10)
    assert len(bins) == 2


def test_empty(docs):
    assert P.pack(docs([])).collect() == []


def test_a_filled_bin_does_not_end_the_search():
    """Mid-size lengths: 763 bins by best fit, 762 when the search ended at a bin filled meanwhile."""
    lengths = np.random.default_rng(5).integers(400, 1100, 2000)
    bins = P.improve(P.best_fit(lengths, 2048), lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(2000)) and len(bins) <= 755


def test_every_pair_of_a_donor_is_offered():
    own = list(range(40))
    lengths = np.array([50 + i for i in own])
    assert {int(lengths[p].sum()) for p in P._pairs(own, lengths)} == {a + b for a in lengths for b in lengths if a < b}


@pytest.mark.parametrize("words, chars", [(1 << 19, 4_000_000), (7, 100)])
def test_texts_together_have_the_tokenizers_ids(monkeypatch, words, chars):
    monkeypatch.setattr(P, "BLOCK_WORDS", words)
    monkeypatch.setattr(P, "BLOCK_CHARS", chars)
    path = P.default_tokenizer()
    tok = Tokenizer.from_file(path)
    texts = TEXTS + [r[1] for r in many(4, 40)] + ["", " \n", "a<‐|b !</w>! </w> Å.. x y", "end"]
    want = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert P.texts_bytes(texts, path) == want
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    portions = list(P._portions(batch))
    assert pa.Table.from_batches(portions) == pa.Table.from_batches([batch])
    assert all(p.num_rows == 1 or sum(map(len, p.column(1).to_pylist())) <= chars + max(map(len, texts)) for p in portions)


def test_parts_without_end_marks_go_to_the_model_one_by_one(monkeypatch):
    path = P.default_tokenizer()
    parts = ["tokenizing", "é", "'s", "7", "...", "ﬁ"]
    want = P._part_ids(parts, path)
    tok, bare, ends, tables = P._encoder(path)
    monkeypatch.setattr(P, "_encoder", lambda _: (tok, bare, np.zeros_like(ends), tables))
    got = P._part_ids(parts, path)
    assert got[0] == want[0] and got[1].tolist() == want[1].tolist()


def test_words_in_use_outlive_a_full_table(monkeypatch):
    """Each word is given to the model once while it is in use, however many others come by."""
    path = P.default_tokenizer()
    known = P._encoder(path)
    monkeypatch.setattr(P, "_encoder", lambda _: (*known[:3], tables))
    monkeypatch.setattr(P, "CACHE_WORDS", 50)
    tables, given = [{}, {}], []
    new_words = P._new_words
    monkeypatch.setattr(P, "_new_words", lambda words, path: given.extend(words) or new_words(words, path))
    for k in range(30):
        P.texts_bytes([f"common words stay {' '.join(f'rare{k}x{i}' for i in range(20))} common"], path)
    assert sorted(given) == sorted({*given}) and len(given) == 3 + 30 * 20
    assert sum(map(len, tables)) <= 2 * (50 + 23)
