"""Language-model scores (operator 9): a log-bilinear neural model, trained in numpy with
noise-contrastive estimation, over counts that cover all training documents.

Documents whose crc32(doc_id as text) mod 10 is not 0 train. Tokens are words
``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end.

Counts: every training token is counted (partial counts in the tasks, then a shuffle by word);
the table of all words stays distributed. The ``KNOWN`` most frequent words of at most
``LONGEST`` bytes, a bounded table, go to the tasks.

Model: classes are the ``CLASSES - 2`` most frequent words, the end, and all other words. As a
context, an other word counts as one of ``HASHED`` classes by its hash. The numbers of all pairs
of context and class in the training documents are what training needs of the corpus: each step
takes the expected NCE gradient over all of them (and over all noise classes, from the unigram
distribution), so that every training pair counts in every step at any corpus size. A class
following h has score  q . r_h + b ; NCE tells true pairs from noise by that score as a
log-probability. The scores of all classes after each context come from one matrix product and
are normalised.

Other words: each word of the training texts, however many there are, has parameters of its own,
one for each of ``GROUPS`` groups of contexts (by likeness of what follows them). Its share among
other words after a context of group g is (n(w, g) + s p(w)) / (n(g) + s): its number after the
group, where NCE without a tie between words has its optimum, drawn to its smoothed share p(w),
(c + 0.1) over the sum of that over other words and one unseen one. The strength s is that of
``STRENGTHS`` with the greatest leave-one-out likelihood. The shares sum to one, and with them
all token probabilities after any context.

Scoring: tasks score all tokens they know and give the rest, words beyond KNOWN, as (document,
word, group, n) rows, which meet the distributed table of words, a row each, in a join.

Defined results: a null text is empty: one token, the end; a null doc_id is the empty text for
crc32, so held out; without training documents every count is 0 and the model is uniform; a text
of any length is scored whole; repeated rows score alike (and train as often as they come); an
empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import doc_id_of, documents, save, ship, text_of

KNOWN = 1 << 17
LONGEST = 64
CLASSES = 1024
HASHED = 512
GROUPS = 16
STRENGTHS = tuple(10.0 ** k for k in range(2, 10))
END, OTHER = 0, 1
WIDTH = 24
STEPS = 800
BATCH = 4096
NOISE = 64
FLUSH = 200_000
SMOOTH = 0.1


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(doc_id_of(docs).alias("doc_id"), text_of(docs).cast("binary").alias("text"))


def word_counts(training: DataFrame) -> DataFrame:
    """(word: binary, n) of all words of the training texts."""
    def work(batches):
        counts: Counter = Counter()

        def out():
            table = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return table
        for batch in batches:
            for text in batch.column(0):
                counts.update(text.as_py().lower().split())
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    return (training.select("text").mapInArrow(work, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def class_ids(words: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in the known table (-1: none), and the classes of the token
    stream: the end before the first word, the words, the end."""
    at = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
    inside = np.full(len(words) + 2, END, np.int64)
    inside[1:-1] = np.where((at >= 0) & (at < CLASSES - 2), at + 2, OTHER)
    return at, inside


def context_ids(words: list[bytes], ids: np.ndarray) -> np.ndarray:
    """Contexts of the tokens after the first end: the classes before them, other words by hash."""
    before = ids[:-1].copy()
    other = np.flatnonzero(before == OTHER)
    before[other] = [CLASSES + zlib.crc32(words[i - 1]) % HASHED for i in other.tolist()]
    return before


def pair_counts(training: DataFrame, shared) -> DataFrame:
    """(pair, n): context h and class w of the training tokens, pair = h * CLASSES + w."""
    def work(batches):
        known = {w: i for i, w in enumerate(shared.value[0][:CLASSES - 2])}
        counts = np.zeros((CLASSES + HASHED) * CLASSES, np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = text.as_py().lower().split()
                _, ids = class_ids(words, known)
                np.add.at(counts, context_ids(words, ids) * CLASSES + ids[1:], 1)
        pair = np.flatnonzero(counts)
        for i in range(0, len(pair), 10_000):
            p = pair[i:i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(counts[p])], ["pair", "n"])

    return (training.select("text").mapInArrow(work, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def train(pair: np.ndarray, n: np.ndarray, classes: int = CLASSES, width: int = WIDTH, steps: int = STEPS,
          seed: int = 9, *, contexts: int | None = None) -> np.ndarray:
    """log10 probabilities (context, class) of the log-bilinear model fitted by NCE: the expected
    gradient over all pairs and all noise, in the size of ``BATCH`` pairs."""
    rng = np.random.default_rng(seed)
    contexts = contexts or classes
    seen = np.zeros((contexts, classes), np.float32)
    seen.ravel()[pair] = n
    unigram = seen.sum(0, dtype=np.float64) + 0.1
    unigram /= unigram.sum()
    bias = np.log(unigram)
    r = rng.normal(0, 0.1, (contexts, width)).astype(np.float32)
    q = rng.normal(0, 0.1, (classes, width)).astype(np.float32)
    if n.sum() > 0:
        seen *= BATCH / n.sum()
        # Noise as often as expected: NOISE samples to each true pair of the context.
        noise = seen.sum(1, keepdims=True) * (NOISE * unigram).astype(np.float32)
        scale = np.log(NOISE) + bias  # of the noise, for NOISE samples to one true pair
        # Hardly more than nothing, so that rare contexts are learned as fast as frequent ones.
        speed = [np.full_like(r, 1e-12), np.full_like(q, 1e-12), np.full(classes, 1e-12)]
        for step in range(steps):
            margin = r @ q.T + (bias - scale).astype(np.float32)
            true = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            slope = seen - (seen + noise) * true
            gr, gq, gb = slope @ q, slope.T @ r, slope.sum(0, dtype=np.float64)
            rate = 0.1 * (1 - 0.9 * step / steps)
            for x, g, s in ((r, gr, speed[0]), (q, gq, speed[1]), (bias, gb, speed[2])):
                s += g * g
                x += rate * g / np.sqrt(s)
    scores = r.astype(np.float64) @ q.T.astype(np.float64) + bias
    top = scores.max(1, keepdims=True)
    return (scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))) / np.log(10)


def grouped(table: np.ndarray, often: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Group of each context: k-means over the roots of what follows, weighted by how often they come."""
    root = np.sqrt(10 ** table)
    order = np.argsort(-often, kind="stable")
    middle = root[order[:GROUPS]]
    for _ in range(rounds):
        near = np.argmax(2 * root @ middle.T - (middle ** 2).sum(1), 1)
        for g in range(len(middle)):
            own = often * (near == g)
            if own.sum() > 0:
                middle[g] = own @ root / own.sum()
    return np.argmax(2 * root @ middle.T - (middle ** 2).sum(1), 1)


def other_counts(training: DataFrame, shared, group: np.ndarray) -> DataFrame:
    """(word, after): how often each word outside the classes comes after a context of each group."""
    def work(batches):
        known = {w: i for i, w in enumerate(shared.value[0][:CLASSES - 2])}
        marks = [bytes([g]) for g in range(GROUPS)]
        counts: Counter = Counter()

        def out():
            words, g = _unmarked(counts)
            table = pa.RecordBatch.from_arrays([words, g, pa.array(list(counts.values()), pa.int64())], ["word", "g", "n"])
            counts.clear()
            return table
        for batch in batches:
            for text in batch.column(0):
                words = text.as_py().lower().split()
                _, ids = class_ids(words, known)
                at = group[context_ids(words, ids)[:-1]].tolist()
                counts.update([words[i] + marks[at[i]] for i in np.flatnonzero(ids[1:-1] == OTHER).tolist()])
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    own = [F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(F.lit(0))).alias(f"n{g}") for g in range(GROUPS)]
    return (training.select("text").mapInArrow(work, "word binary, g int, n long").groupBy("word").agg(*own)
            .select("word", F.array(*[f"n{g}" for g in range(GROUPS)]).alias("after")))


def _unmarked(marked) -> tuple[pa.Array, pa.Array]:
    """Words and groups of words that end in a byte for their group."""
    return pa.array([w[:-1] for w in marked], pa.binary()), pa.array([w[-1] for w in marked], pa.int32())


def known_counts(other: DataFrame, shared) -> np.ndarray:
    """n(w, g) of the known words, at most KNOWN of them."""
    def work(batches):
        known = {w: i for i, w in enumerate(shared.value[0])}
        for batch in batches:
            at = np.fromiter((known.get(w, -1) for w in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            keep = pa.array(at >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(at).filter(keep), batch.column(1).filter(keep)], ["at", "after"])

    got = other.mapInArrow(work, "at long, after array<long>").toArrow()
    out = np.zeros((len(shared.value[0]), GROUPS))
    out[got.column("at").to_numpy()] = got.column("after").combine_chunks().flatten().to_numpy().reshape(-1, GROUPS)
    return out


def strength(after: np.ndarray, plain: np.ndarray, whole: np.ndarray) -> float:
    """The strength with the greatest leave-one-out likelihood of the known other words: numbers
    n(w, g), shares p(w), numbers n(g) of all other words."""
    w, g = np.nonzero(after)
    n = after[w, g]
    like = [(n * np.log((n - 1 + s * plain[w]) / (whole[g] - 1 + s))).sum() for s in STRENGTHS]
    return STRENGTHS[int(np.argmax(like))]


def frequent(counts: DataFrame, most: int = KNOWN) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words of at most LONGEST bytes and their numbers, falling: all words
    from some number on, so that there are at most ``most`` (found by a histogram of numbers
    with 16 steps to each doubling)."""
    level = F.floor(16 * F.log2("n")).cast("int")
    short = counts.where(F.octet_length("word") <= LONGEST).withColumn("level", level)
    least, total = 1 << 20, 0
    for row in sorted(short.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    top = short.where(F.col("level") >= least).select("word", "n").toArrow()
    order = sorted(zip(top.column("n").to_pylist(), top.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
    return [w for _, w in order], np.array([n for n, _ in order], np.int64)


def fit(docs: DataFrame):
    """(table of word counts, what tasks need): counts and model from the training rows."""
    spark = docs.sparkSession
    rows = _rows(docs)
    training = rows.where(~held_out(F.col("doc_id")))
    counts = save(word_counts(training), "counts")
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).head()
    ends = training.count()
    words, number = frequent(counts)
    shared = spark.sparkContext.broadcast((words, number))
    pairs = pair_counts(training, shared).toArrow()
    pair, often = pairs.column("pair").to_numpy(), pairs.column("n").to_numpy()
    table = train(pair, often, CLASSES, contexts=CLASSES + HASHED)
    h, w = np.divmod(pair, CLASSES)
    group = grouped(table, np.bincount(h, often, CLASSES + HASHED))
    after_of = save(other_counts(training, shared, group), "other")
    n_tokens, n_types = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    inside = number[:CLASSES - 2]
    rare_mass = (total["n"] or 0) - int(inside.sum()) + SMOOTH * (total["v"] - len(inside) + 1)
    whole = np.bincount(group[h], often * (w == OTHER), GROUPS)
    after = known_counts(after_of, shared)
    plain = (number + SMOOTH) / rare_mass
    s = strength(after, plain, whole)
    rare = np.log10(after + s * plain[:, None]) - np.log10(whole + s)
    rare[:CLASSES - 2] = 0
    facts = {"tokens": n_tokens, "ends": ends, "base_mass": n_tokens + SMOOTH * (n_types + 1), "rare_mass": rare_mass,
             "strength": s, "whole": whole.tolist(), "group": group, "rare": rare.astype(np.float32), "after": after_of,
             "other": after_of.select("word", F.posexplode("after").alias("g", "n")).where("n > 0")}
    told = {k: v for k, v in facts.items() if k not in ("after", "other")}
    return counts, spark.sparkContext.broadcast((words, number, table, told)), facts


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 of the text's probability under the model)."""
    _, shared, facts = fit(docs)

    def work(batches):
        words, number, table_of, facts = shared.value
        known = {w: i for i, w in enumerate(words)}
        base = np.log10(number + SMOOTH) - np.log10(facts["base_mass"])
        rare, group = facts["rare"], facts["group"]
        end = np.log10(facts["ends"] + SMOOTH) - np.log10(facts["base_mass"])
        marks = [bytes([g]) for g in range(GROUPS)]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32()]
        names = ["doc_id", "key", "word", "n", "n_known", "base", "model", "g"]

        def table(size, **cols):
            return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(size, k) for c, k in zip(names, kinds)], names)

        for batch in batches:
            keys, n, n_known, of_base, model, marked, times, each = [], [], [], [], [], [], [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(hashlib.blake2b(raw, digest_size=16, salt=(str(doc_id).encode())[:16]).digest())
                own = raw.lower().split()
                at, ids = class_ids(own, known)
                inside = at >= 0
                seen = at[inside]
                before = context_ids(own, ids)
                near = group[before[:-1]]
                n.append(len(own) + 1)
                n_known.append(len(seen) + (facts["ends"] > 0))
                of_base.append(float(base[seen].sum() + end))
                model.append(float(table_of[before, ids[1:]].sum() + rare[seen, near[inside]].sum(dtype=float)))
                other = Counter()
                if len(seen) < len(own):
                    near = near.tolist()
                    other.update([own[i] + marks[near[i]] for i in np.flatnonzero(~inside).tolist()])
                    other[marks[0]] = 1  # stands for the row: rows with equal keys are told by it
                    marked.extend(other)
                    times.extend(other.values())
                each.append(len(other))
            keys = pa.array(keys, pa.binary())
            yield table(len(keys), doc_id=batch.column(0), key=keys, n=pa.array(n, pa.int64()), n_known=pa.array(n_known, pa.int64()),
                        base=pa.array(of_base, pa.float64()), model=pa.array(model, pa.float64()))
            words, g = _unmarked(marked)
            yield table(len(words), key=keys.take(pa.array(np.repeat(np.arange(len(each)), each))), word=words,
                        n=pa.array(times, pa.int64()), g=g)

    done = save(_rows(docs).mapInArrow(
        work, "doc_id long, key binary, word binary, n long, n_known long, base double, model double, g int"), "scored")
    rows, rest = done.where("word is null"), done.where("word is not null").select("key", "word", "g", "n")
    # All numbers of a word in one row: outside the classes, each of its places is after some group.
    after = facts["after"].select(F.col("word").alias("_word"), F.col("after").alias("_after"))
    real = F.octet_length("word") > 0
    words = rest.where(real).join(after, F.col("word") == F.col("_word"), "left")
    in_all = sum((F.get("_after", F.lit(g)) for g in range(1, GROUPS)), F.get("_after", F.lit(0)))
    words = words.select("key", "word", "g", "n", in_all.alias("c"), F.get("_after", F.col("g")).alias("after"))
    none = F.lit(None).cast("long")
    marks = rest.where(~real).withColumn("c", none).withColumn("after", none)
    rest = words.unionByName(marks).withColumn("c", F.coalesce("c", F.lit(0)))
    share = F.log10(F.col("c") + F.lit(SMOOTH))
    s, whole = facts["strength"], F.array(*[F.lit(float(x + facts["strength"])) for x in facts["whole"]])
    drawn = F.coalesce("after", F.lit(0)) + (F.col("c") + F.lit(SMOOTH)) * F.lit(float(s / facts["rare_mass"]))
    rest = rest.groupBy("key").agg(
        F.sum((~real).cast("int")).alias("times"),
        F.sum(F.when(real & (F.col("c") > 0), F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.when(real, F.col("n") * (share - F.log10(F.lit(float(facts["base_mass"])))))).alias("base_rest"),
        F.sum(F.when(real, F.col("n") * (F.log10(drawn) - F.log10(F.get(whole, F.col("g")))))).alias("model_rest"))
    rest = save(rest.withColumnRenamed("key", "_key"), "rest")
    each = lambda c: F.coalesce(F.col(c) / F.col("times"), F.lit(0.0))
    return rows.join(rest, F.col("key") == F.col("_key"), "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.round(each("more")).cast("long")).alias("n_known"),
        F.lit(int(facts["tokens"])).cast("long").alias("train_tokens"),
        (F.col("base") + each("base_rest")).alias("base_score"), (F.col("model") + each("model_rest")).alias("score"))


def op9_lm_scores(spark, sf_dir):
    """Query: base and model scores of all documents."""
    return score(documents(spark, sf_dir))


ship(__name__)
