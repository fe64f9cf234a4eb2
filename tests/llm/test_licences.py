import random
import re

from lakeward.llm import licences as L
from conftest_llm import ODD, docs, many  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in L.PHRASES for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


NOTICES = [(700, "Released under the MIT License."), (701, "x under the mit LICENSE under the MIT-license\nCC BY-NC 4.0"),
           (702, L.TEMPLATES[0][1]), (703, "prose prose " + L.TEMPLATES[2][1].replace("governing", "ruling") + " more"),
           (704, "cc by nc cc by nc cc by nc"), (705, "Apache License Version 2 apache_license version 2é"),
           (706, "free software foundation"), (707, "This work is licensed under the GNU General Public License, version 3."),
           (708, "Permission is hereby granted, free of charge, to any person"), (709, "under the mit license " * 3000)]


def test_base_matches_brute_force(docs):
    rows = ODD + many(2) + NOTICES
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                  for r in L.licences(docs(rows)).collect()), key=str)
    assert got == sorted(((r[0], *brute_base(r[1])) for r in rows), key=str)


def test_labels_and_scores_of_notices(docs):
    got = {r.doc_id: r for r in L.licences(docs(NOTICES + many(2))).collect()}
    assert got[700].labels == "mit" and got[700].score == 1
    assert got[702].labels == "mit" and got[702].base_labels == "" and got[702].score == 1
    assert got[703].labels == "apache-2" and 0.9 < got[703].score < 1
    assert got[707].labels == "gpl-3" and got[707].score == 1
    assert got[706].labels == "" and got[708].labels == "" and 0 < got[708].score < 0.6
    assert all(got[r[0]].labels == "" and got[r[0]].score == 0 for r in many(2))
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got.values())


def test_matching_statistics_match_brute_force():
    rnd = random.Random(1)
    for _ in range(40):
        templates = [[rnd.randrange(4) for _ in range(rnd.randint(1, 15))] for _ in range(3)]
        stream = [rnd.randrange(5) for _ in range(30)]
        automaton = L.Automaton(templates, 2)

        def places(part):
            return sorted((t, i) for t, own in enumerate(templates) for i in range(len(own) - len(part) + 1)
                          if own[i:i + len(part)] == part)
        longest = []
        for end in range(1, 31):
            longest.append(max(n for n in range(end + 1) if n == 0 or places(stream[end - n:end])))
        want = [(i + 1 - n, n, places(stream[i + 1 - n:i + 1])) for i, n in enumerate(longest)
                if n >= 2 and (i == 29 or longest[i + 1] <= n)]
        got = [(a, n, sorted(p)) for a, n, p in automaton.matches(stream, 2)]
        assert got == want


def test_chains_join_matches_in_order_only():
    assert L.chained([(0, 0, 5), (7, 7, 5)]) == 10
    assert L.chained([(0, 7, 5), (7, 0, 5)]) == 5
    assert L.chained([(0, 0, 5), (50, 5, 5)]) == 5
    assert L.chained([(0, 0, 5), (3, 3, 5)]) == 8


def test_empty(docs):
    assert L.licences(docs([])).collect() == []
