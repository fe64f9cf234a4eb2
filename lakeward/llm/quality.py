"""Quality rules as a short-circuit cascade (operator 5).

Each rule is a test on a text. Its cost (seconds) and selectivity (share it rejects) are
estimated on a bounded sample (``SAMPLE_ROWS`` texts of at most ``SAMPLE_CHARS`` characters);
rules then run in falling order of rejections per second, and a text is done at the first
rule it fails. The order decides speed only: a text is kept if no rule rejects it.

Words are ``[^\\x20\\x09-\\x0D]+``. Rules: ``short`` (n_words < 20) and ``repeats`` (words in
8-word windows found twice or more are over 30 % of words) are the base rules; ``symbols``
(``#*$%&|<>`` per word over 0.3), ``dup_lines`` (over half of the lines with a word repeat an
earlier line), ``shouting`` (over 60 % of letters, all code points
beyond ASCII included, are ASCII capitals), ``long_words`` (over 40 ASCII characters a word: scripts
without blanks have long words), ``no_letters`` (fewer letters than a third of word characters) and
``runs`` (over half of the words equal the word before) are the method's; they are set to leave ordinary prose alone.

Defined results: a null text is empty and has no word, so it fails ``short``; a text of any
length is read whole; repeated rows are judged alike; an empty table gives an empty result;
extra columns are kept by ``keep_good`` whatever their names.
"""

from __future__ import annotations

import operator
import time
from collections import Counter
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import doc_id_of, documents, ship, text_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 500
SAMPLE_CHARS = 100_000
BASE_RULES = ("short", "repeats")
CONTINUATION = bytes(range(0x80, 0xC0))
BEYOND = bytes(range(0x80, 0x100))
SPACE = b" \t\n\x0b\x0c\r"
CAPITALS = bytes(range(65, 91))
SMALL = bytes(range(97, 123))


class Text:
    """Measures of a UTF-8 text, each computed when first asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    def without(self, chars: bytes) -> int:
        return len(self.text.translate(None, chars))

    @cached_property
    def word_chars(self) -> int:
        return self.without(SPACE + CONTINUATION)

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - self.without(SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_run_words(self) -> int:
        """Words equal to the word before."""
        return sum(map(operator.eq, self.words, self.words[1:]))

    @cached_property
    def capitals(self) -> int:
        return len(self.text) - self.without(CAPITALS)

    @cached_property
    def letters(self) -> int:
        """ASCII letters and all code points beyond ASCII."""
        other = len(self.text.translate(None, bytes(range(0x80)) + CONTINUATION))
        return self.capitals + len(self.text) - self.without(SMALL) + other

    @cached_property
    def n_repeat_words(self) -> int:
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        words = np.fromiter(map(hash, self.words), np.int64, self.n_words)
        sums = np.zeros(n, np.int64)
        for i in range(WINDOW):
            sums = sums * 1_000_003 + words[i:i + n]
        ordered = np.sort(sums)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        # Equal sums are held against the words themselves.
        at = np.flatnonzero(np.isin(sums, twice)).tolist()
        windows = [tuple(self.words[i:i + WINDOW]) for i in at]
        found = Counter(windows)
        cover = np.zeros(self.n_words + 1, np.int64)
        hit = np.array([i for i, w in zip(at, windows) if found[w] > 1], np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        return int((np.cumsum(cover) > 0).sum())


def default_rules() -> dict:
    """name -> test that is true for a text the rule rejects."""
    return {
        "short": lambda t: t.n_words < 20,
        "repeats": lambda t: 100 * t.n_repeat_words > 30 * t.n_words,
        "symbols": lambda t: 10 * t.n_symbols > 3 * t.n_words,
        "dup_lines": lambda t: 2 * t.n_dup_lines > len(t.lines),
        "shouting": lambda t: 10 * t.capitals > 6 * t.letters,
        "long_words": lambda t: t.without(SPACE + BEYOND) > 40 * t.n_words,
        "no_letters": lambda t: 3 * t.letters < t.word_chars,
        "runs": lambda t: 2 * t.n_run_words > t.n_words,
    }


def cascade_order(docs: DataFrame, rules: dict | None = None) -> list[str]:
    """Rule names by rejections per second of cost, measured on a bounded sample."""
    rules = rules or default_rules()
    text = text_of(docs)
    sample = (docs.select(text.cast("binary").alias("t")).where(F.length(text) <= SAMPLE_CHARS)
              .head(SAMPLE_ROWS))
    worth = {}
    for name, rejects in rules.items():
        began = time.perf_counter()
        n = sum(rejects(Text(bytes(r.t))) for r in sample)
        worth[name] = n / (time.perf_counter() - began + 1e-9)
    return sorted(rules, key=lambda name: -worth[name])


def first_failure(text: Text, order: list[str], rules: dict) -> str | None:
    """The first rule of the cascade that rejects the text; later ones are not tried."""
    return next((name for name in order if rules[name](text)), None)


def judge(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, the base measures, base_failed, kept."""
    order = order or cascade_order(docs)

    def work(batches):
        rules = default_rules()
        for batch in batches:
            rows = []
            for raw in batch.column(1):
                t = Text(raw.as_py())
                failed = first_failure(t, order, rules)
                base = failed in BASE_RULES or (failed is not None and any(rules[b](t) for b in BASE_RULES))
                rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, base,
                             failed is None))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "kept"])

    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, word_chars long, n_symbols long, "
                                 "n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns kept."""
    order = order or cascade_order(docs)

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        rules = default_rules()
        return pd.Series([first_failure(Text(t), order, rules) is None for t in texts], dtype=bool)

    return docs.where(passes(text_of(docs).cast("binary")))


def op5_quality_rules(spark, sf_dir):
    """Query: base measures and verdict of all documents."""
    return judge(documents(spark, sf_dir))


#: Alike for texts of ASCII; beyond it, its shouting and long_words still reject clean texts of
#: other scripts, which the rules above keep.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
x AS (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
y AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(ws[i:i + 7], ' ')) AS n FROM x),
z AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM y WHERE n > 1) GROUP BY rid),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_run_words,
         len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper,
         length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower,
         length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS beyond
  FROM w LEFT JOIN z USING (rid)),
v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR 10 * upper > 6 * (upper + lower)
         OR word_chars > 40 * n_words OR 2 * n_run_words > n_words OR 3 * (upper + lower + beyond) < word_chars AS rejected FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept FROM v
"""

ship(__name__)
