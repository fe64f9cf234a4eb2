"""Personal data (operator 3): regular expressions propose spans, checksums confirm them,
nearby words adjust their score. DataFrame functions only.

Kinds: email, ip, card and phone are the base (leftmost, non-overlapping for each kind; a
match that fails its check is dropped and not tried again): ip parts are at most 255; cards
have 13 to 19 digits and pass Luhn; phones have 9 to 15 digits. iban is the method's: passes
mod 97; its length is that of its country, and of what else looks like one the longest run is
tried (``SQL`` only has the latter, so it misses IBANs followed by a capital or a digit). Base spans always stay; an iban stays if its score reaches ``MIN_SCORE``.

The patterns match what the contract's do, written so that no text makes them slow: runs are
possessive, and a match starts at the beginning of a run of its characters or where the last
match ended, the only places where a leftmost match can. No pattern crosses a line end.

Places: a text is split at its matches; a match ends where the pieces and matches up to it
end. Positions are code points, end exclusive.

Score of a span: ``SCORES`` by kind, plus 0.1 if one of ``NEARBY``'s words for the kind stands
within 40 characters before or after it (on this side of the neighbouring matches).

Defined results: a null text is empty; a text of any length is searched whole; without spans
the digest is that of the empty string, spans is empty and score 0; repeated rows are alike;
an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import doc_id_of, documents, text_of

#: Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS", 23: "AE|GI|IL|IQ|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "PT",
    26: "IS|TR", 27: "FR|GR|IT|MC|MR|SM", 28: "AL|AZ|CY|DO|GT|HU|LB|PL", 29: "BR|PS|QA", 30: "JO|KW|MU", 31: "MT",
}
_BY_COUNTRY = "|".join(f"(?:{names})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9_])(?:{_BY_COUNTRY}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}})(?![A-Za-z0-9_])",
}
#: What a text must hold to be searched for a kind at all.
HINTS = {"email": "@", "phone": "+"}
BASE = ("email", "ip", "card", "phone")
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.8}
NEARBY = {
    "email": "mail|email|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|account|bank|transfer",
}
MIN_SCORE = 0.5
CONTEXT = 40


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod_97(text: Column) -> Column:
    """Whether an IBAN (spaces aside) has remainder 1."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def confirmed(kind: str, text: Column) -> Column:
    """Whether a proposed span passes its kind's check."""
    n = F.length(_digits(text))
    if kind == "ip":
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(text))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return mod_97(text)
    return F.lit(True)


def _ends(pieces: Column, found: Column) -> Column:
    """Ends of the matches: running sums over pieces and matches."""
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
    nothing = F.array().cast("array<int>")
    return F.aggregate(steps, nothing, lambda ends, n: F.concat(
        ends, F.array(n + F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0)))))


def _spans(kind: str, found: Column, pieces: Column, ends: Column) -> Column:
    """array<struct<kind, start, stop, score>> of the confirmed matches."""
    def span(m, i):
        before, after = F.get(pieces, i), F.get(pieces, i + 1)
        near = F.lower(F.concat_ws(" ", F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT))))
        more = F.when(near.rlike(rf"(?<![a-z])(?:{NEARBY[kind]})(?![a-z])"), 0.1).otherwise(0.0)
        stop = F.get(ends, i)
        good = confirmed(kind, m)
        score = F.lit(SCORES[kind]) + more
        return F.struct(F.lit(kind).alias("kind"), (stop - F.length(m)).alias("start"), stop.alias("stop"),
                        score.alias("score"), good.alias("good"))
    keep = lambda s: s["good"] if kind in BASE else s["good"] & (s["score"] >= MIN_SCORE)
    return F.filter(F.transform(found, span), keep)


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and, for each kind, an array of spans (kind, start, stop, score, good)."""
    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_of(docs).alias("text"))
    kinds = list(PATTERNS)
    none = F.array().cast("array<string>")

    def found(kind):
        got = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(F.col("text").contains(HINTS[kind]), got).otherwise(none) if kind in HINTS else got
    rows = rows.select("doc_id", "text", *[found(k).alias(f"m_{k}") for k in kinds])
    some = lambda k, c: F.when(F.size(f"m_{k}") > 0, c)
    rows = rows.select("doc_id", *[f"m_{k}" for k in kinds],
                       *[some(k, F.split("text", PATTERNS[k], -1)).alias(f"p_{k}") for k in kinds])
    rows = rows.select("doc_id", *[f"{x}_{k}" for k in kinds for x in "mp"],
                       *[some(k, _ends(F.col(f"p_{k}"), F.col(f"m_{k}"))).alias(f"e_{k}") for k in kinds])
    empty = F.array().cast("array<struct<kind:string,start:int,stop:int,score:double,good:boolean>>")
    return rows.select("doc_id", *[F.coalesce(some(k, _spans(k, *(F.col(f"{x}_{k}") for x in "mpe"))), empty).alias(k)
                                   for k in kinds])


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, score
    (of its best span)."""
    rows = find_spans(docs)
    every = F.concat(*PATTERNS)
    best = F.coalesce(F.array_max(F.transform(every, lambda s: s["score"])), F.lit(0.0))
    return rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                       F.sha2(_written(F.concat(*BASE)), 256).alias("base_sha256"),
                       _written(every).alias("spans"), best.alias("score"))


def op3_personal_data(spark, sf_dir):
    """Query: personal data in all documents."""
    return personal_data(documents(spark, sf_dir))


def _sql() -> str:
    """The same in SQL: places from pieces and matches, checks on lists of digits."""
    found = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+",
             "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
             "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b"}
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(range(0, length({digits})), lambda i: CASE WHEN i % 2 = 0
      THEN CAST(substr({digits}, length({digits}) - i, 1) AS INT)
      ELSE CAST(substr('0246813579', CAST(substr({digits}, length({digits}) - i, 1) AS INT) + 1, 1) AS INT) END)) % 10 = 0"""
    turned = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
    numbers = (f"array_to_string(list_transform(regexp_extract_all({turned}, '.'), "
               "lambda c: CASE WHEN ascii(c) < 58 THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), '')")
    good = {"email": "true",
            "ip": "list_sum(list_transform(string_split(m, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) < 3 OR "
                  "(length(ltrim(p, '0')) = 3 AND ltrim(p, '0') <= '255') THEN 0 ELSE 1 END)) = 0",
            "card": f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END",
            "phone": f"length({digits}) BETWEEN 9 AND 15"}
    # An iban's number has up to 68 digits: the remainder goes digit by digit.
    good["iban"] = (f"list_reduce(list_prepend(0, list_transform(regexp_extract_all({numbers}, '.'), lambda d: CAST(d AS INT))), "
                    "lambda a, d: (a * 10 + d) % 97) = 1")
    parts, unions = [], []
    for n, (kind, pattern) in enumerate(found.items()):
        parts.append(f"""{kind}_l AS (
  SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d),
{kind}_m AS (
  SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, ms, ps FROM {kind}_l WHERE len(ms) > 0),
{kind}_s AS (
  SELECT rid, {n} AS n, '{kind}' AS kind, m,
         CAST(list_sum(list_transform(ps[1:i], lambda x: length(x))) + list_sum(list_transform(ms[1:i], lambda x: length(x))) AS BIGINT) AS stop,
         {SCORES[kind]} + CASE WHEN regexp_matches(lower(right(ps[i], {CONTEXT}) || ' ' || left(ps[i + 1], {CONTEXT})),
                                '(^|[^a-z])({NEARBY[kind]})([^a-z]|$)') THEN 0.1::DOUBLE ELSE 0::DOUBLE END AS score
  FROM {kind}_m WHERE {good[kind]})""")
        unions.append(f"SELECT rid, n, kind, stop - length(m) AS start, stop, score FROM {kind}_s")
    written = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY n, start)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{', '.join(parts)},
s AS ({' UNION ALL '.join(unions)}),
a AS (SELECT rid, {counts}, {written} FILTER (WHERE n < {len(BASE)}) AS base, {written} AS spans, max(score) AS score
      FROM s GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(CAST(score AS DOUBLE), 0.0::DOUBLE) AS score
FROM d LEFT JOIN a USING (rid)"""


SQL = _sql()
