"""URL filters (operator 6): domain rules, then logistic regression on hashed character
n-grams of host and path, trained from a small labelled URL table.

Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there
up to ``?`` or ``#``. A rule (host/path prefix) fits its host and all subdomains if the path
starts with the rule's; the longest fitting rule decides. Other URLs get the model's verdict:
``block`` if its probability is at least one half.

Training: a table (url, blocked), each (host, path, blocked) once; of more than ``TRAIN_ROWS``
blocked or ``TRAIN_ROWS`` allowed ones, those of least hash are taken, so the sample is bounded
and the same in every run. The model is fitted by full-batch gradient descent with L2 weights,
in numpy; its ``2**BITS`` weights are all that tasks get. The query trains on ``url_labels.tsv``
beside this file, a table composed of host words and paths of both kinds and the known bad names,
not of judged pages. ``seed_labels`` marks the pages of known bad host names; others have no label.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and
is judged by the model on empty features; repeated rows are judged alike; an empty table
gives an empty result (and an untrained model, which allows); extra columns do not matter.
"""

from __future__ import annotations

import pkgutil
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ship

#: The rules of the contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Host names that the seed table marks as blocked.
BAD_HOSTS = ("casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x")
TRAIN_ROWS = 4000
BITS = 14
GRAMS = (3, 4, 5)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return (F.translate(F.regexp_extract(url, pattern, 1), upper, lower),
            F.regexp_extract(url, pattern, 2))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does."""
    rule = verdict = None
    for name, does in sorted(rules, key=lambda r: -len(r[0])):
        at = name.index("/")
        own, start = name[:at], name[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, does) if verdict is None else verdict.when(fits, does)
    return rule, verdict


def features(host: str, path: str) -> np.ndarray:
    """Hashed character n-grams of host and of path, each set once."""
    out = {0}
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        out.update(zlib.crc32(f"{mark}{text[i:i + n]}".encode()) & ((1 << BITS) - 1)
                   for n in GRAMS for i in range(len(text) - n + 1))
    return np.fromiter(out, np.int64, len(out))


def fit(rows: list[tuple[str, str, int]], steps: int = 300, rate: float = 2.0, l2: float = 1e-4) -> np.ndarray:
    """Weights of the logistic regression for (host, path, blocked) rows."""
    weights = np.zeros(1 << BITS)
    if not rows:
        return weights
    own = [features(h, p) for h, p, _ in rows]
    col = np.concatenate(own)
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    value = 1 / np.sqrt([len(x) for x in own])
    want = np.array([y for *_, y in rows], float)
    share = want.mean()
    worth = np.where(want > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    speed = np.full(1 << BITS, 1e-8)
    for _ in range(steps):
        margin = np.bincount(row, weights[col], len(own)) * value
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - want) * worth / len(own)
        slope = np.bincount(col, (error * value)[row], 1 << BITS) + l2 * weights
        speed += slope * slope
        weights -= rate * slope / np.sqrt(speed) * 0.1
    return weights


def probability(weights: np.ndarray, host: str, path: str) -> float:
    own = features(host, path)
    return float(1 / (1 + np.exp(-np.clip(weights[own].sum() / np.sqrt(len(own)), -30, 30))))


def seed_labels(pages: DataFrame, bad=BAD_HOSTS) -> DataFrame:
    """(url, blocked) of the pages: 1 if a label of the host is a known bad name, null otherwise."""
    host, _ = parts(pages["url"])
    labels = F.split(host, r"\.")
    known = F.arrays_overlap(labels, F.array(*map(F.lit, bad)))
    return pages.select("url", F.when(known, 1).alias("blocked"))


def labelled_urls(spark) -> DataFrame:
    """(url, blocked) of the package's labelled table."""
    lines = pkgutil.get_data("lakeward.llm", "url_labels.tsv").decode().splitlines()
    rows = [(url, int(blocked)) for url, blocked in (line.split("\t") for line in lines)]
    return spark.createDataFrame(rows, "url string, blocked int")


def train(labelled: DataFrame, most: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from a bounded sample of the labelled table: of the blocked and of the allowed ones,
    at most ``most`` different (host, path) each, those of least hash."""
    host, path = parts(labelled["url"])
    kind = (labelled["blocked"].cast("int") != 0).cast("int").alias("blocked")
    rows = labelled.select(host.alias("h"), path.alias("p"), kind).where("h <> '' and blocked is not null").distinct()
    place = F.pmod(F.xxhash64("h", "p"), F.lit(1 << 30))
    sample = []
    for r in sorted(rows.groupBy("blocked").count().collect()):
        # Only about twice as many rows as needed, those of low hash, leave the tasks at all.
        share = min(2 * most / r["count"], 1.0)
        own = rows.where((F.col("blocked") == r["blocked"]) & (place < int(share * (1 << 30))))
        sample += own.orderBy(place, "h", "p").limit(most).collect()
    return fit([(r.h, r.p, int(r.blocked)) for r in sample])


def judge(pages: DataFrame, weights: np.ndarray, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block of every page."""
    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([probability(weights, h, p) for h, p in zip(hosts, paths)], dtype=float)

    host, path = parts(pages["url"])
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("p_block", score("host", "path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, by_model).alias("verdict"), "p_block")


def op6_url_filter(spark, sf_dir):
    """Query: rule and verdict of all pages, the model trained on the labelled table."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, train(labelled_urls(spark)))


ship(__name__)
