"""Toxicity scores from two class-conditional Kneser-Ney models.

All labelled documents but those of the curve are counted by Spark into word pairs; counts of the larger class weigh
less, so that both classes have the same total (and neither model is
smoother than the other).  Each class has its own discounted pair
and word probabilities, a word's from the number of different words it follows (continuation counts), not from how often it
occurs; pairs back off to words, and words to one share for every word of the pooled
counts, with weights from the pooled counts that both classes have in common, so a word or pair that is
rare or new says nothing about the class by itself.  All pairs and words are counted and tested; those seen ``MIN_COUNT`` times in the pooled,
weighted counts that occur in more texts of one class than of the other by ``APART`` standard errors have class probabilities.  All
others are smoothed into the back-off, with one probability for both classes, and leave the difference as it is: with probabilities of
their own the chance differences of many rare words outweigh the few words that tell.

A document's score compares the two log-likelihoods per word; a logistic curve fitted on a fifth of the
labelled rows (all of these, weighted to the class shares of all labels) maps the
difference to 0..1.  Labels, language, source and
id are never inputs of a score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm import texts
from logweave.llm.common import cut, extended, map_arrow, table, without

#: Labels, and words that tell the classes apart, are broadcast up to so many rows of two values; beyond that they are joined by shuffle.
BROADCAST_LABELS = 2_000_000
#: Points of each class that the curve is fitted on, at most: beyond that a point is the mean of neighbours in the order
#: of their differences, as many for each point, and weighs as much as its rows.
MAX_CURVE_DOCS = 5_000
MIN_COUNT = {"words": 5, "pairs": 20}
#: Standard errors by which the class counts of a word or pair differ, or else both classes share it.
APART = 3.5
#: Differences beyond this many nats per word count as this many.
CLIP = 0.1
START = 1  # stands before the first word of a text
U = np.uint64
TOKEN = np.zeros(256, bool)
TOKEN[128:] = True
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    TOKEN[_lo:_hi] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous word, word, text index) hashes of the distinct word pairs of each text.  Words are runs
    of letters, digits and non-ASCII characters, A-Z in lower case.  A pair counts once in a text, so
    that a text that repeats itself speaks no louder than others."""
    data = texts.LOWER[data]
    starts, ends, doc = texts.spans(TOKEN[data], offsets)
    word = texts.hash_spans(data, starts, ends)
    prev = np.concatenate([np.full(min(1, len(word)), START, U), word[:-1]])
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    prev[first] = START
    _, at = np.unique(texts.mix(pair_key(prev, word) + doc.astype(U) * U(0xD6E8FEB86659FD93)), return_index=True)
    at.sort()
    return prev[at], word[at], doc[at]


def pair_key(prev: np.ndarray, word: np.ndarray) -> np.ndarray:
    return texts.mix(prev * U(0x9E3779B97F4A7C15) + word)


def _added(parts: list, same: int = 0) -> tuple:
    """(key, ``same`` columns that follow from the key, counts...) arrays of several parts, the counts of equal keys added up."""
    key, *n = (np.concatenate([p[i] for p in parts]) for i in range(len(parts[0])))
    if not same:
        found, back = np.unique(key, return_inverse=True)
    else:
        found, first, back = np.unique(key, return_index=True, return_inverse=True)
    return found, *[c[first] for c in n[:same]], *[np.bincount(back, c, len(found)) for c in n[same:]]


def _counts(docs: DataFrame, text: str, toxic: str, names: list[str], of_text, same: tuple[str, ...] = ()) -> DataFrame:
    """(key, ``same``..., ``names``...): what ``of_text(prev, word, text index, label)`` counts, added up by key in the tasks and by Spark;
    columns ``same`` follow from the key."""
    def count(batches):
        held, size = [], 0
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, off in texts.chunks(batch.column(0)):
                p, w, d = tokens(data, off)
                held.append(_added(of_text(p, w, d, label[lo:hi][d]), len(same)))
                size += len(held[-1][0])
            if size > 2_000_000:
                held = [_added(held, len(same))]
                size = len(held[0][0]) // 2
        if size:
            columns = _added(held, len(same))
            for i in range(0, len(columns[0]), 65536):
                yield pa.record_batch([pa.array(x[i: i + 65536].astype(np.int64)) for x in columns], names=["key", *same, *names])

    rows = map_arrow(docs.select(text, F.col(toxic).cast("long")), count, ", ".join(f"{c} long" for c in ("key", *same, *names)))
    return rows.groupBy("key", *same).agg(*[F.sum(c).alias(c) for c in names])


def count_words(docs: DataFrame, text: str, toxic: str) -> DataFrame:
    """(key, t, o, dt, do, v_t, v_o) of each word: the toxic and ordinary texts that have each pair that ends with it, added up
    over pairs; the texts that have the word; the first again, for the pairs that begin with it."""
    def of_text(p, w, d, y):
        new = np.zeros(len(w), np.int64)
        new[np.unique(pair_key(d.astype(U), w), return_index=True)[1]] = 1
        none = np.zeros(len(w), np.int64)
        return [(w, y, 1 - y, y * new, (1 - y) * new, none, none), (p, none, none, none, none, y, 1 - y)]

    return _counts(docs, text, toxic, ["t", "o", "dt", "do", "v_t", "v_o"], of_text)


def count_pairs(docs: DataFrame, text: str, toxic: str) -> DataFrame:
    """(key, word, t, o): the toxic and ordinary texts that have each pair of words, and its second word."""
    return _counts(docs, text, toxic, ["t", "o"], lambda p, w, d, y: [(pair_key(p, w), w, y, 1 - y)], ("word",))


def by_word(pairs: DataFrame, telling: Column) -> DataFrame:
    """(word, k_t, k_o, n1 to n4, pairs) of :func:`count_pairs`: how many different words (or the start of a text) stand before each word
    in toxic texts, and how many in ordinary ones; its pairs with a pooled count of one to four; those that are ``telling``, as
    (key, t, o)."""
    has = [F.count(F.when(F.col(c) > 0, 1)).alias(f"k_{c}") for c in "to"]
    return pairs.groupBy("word").agg(*has, *_frequencies(), F.collect_list(F.when(telling, F.struct("key", "t", "o"))).alias("pairs"))


def words_of_pairs(docs: DataFrame, text: str, keys: np.ndarray) -> DataFrame:
    """(key, prev, word) of the pairs with the sorted ``keys``, found in the texts again: the counts move keys only."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def find(batches):
        seen = np.zeros(len(shared.value), bool)
        for batch in batches:
            for _, _, data, off in texts.chunks(batch.column(0)):
                p, w, _ = tokens(data, off)
                known, at = _find(shared.value, pair_key(p, w))
                new, first = np.unique(at[known], return_index=True)
                first = np.flatnonzero(known)[first[~seen[new]]]
                seen[new] = True
                columns = (pair_key(p[first], w[first]), p[first], w[first])
                yield pa.record_batch([pa.array(x.view(np.int64)) for x in columns], names=["key", "prev", "word"])

    rows = map_arrow(docs.select(text), find, "key long, prev long, word long")
    return rows.groupBy("key").agg(F.first("prev").alias("prev"), F.first("word").alias("word"))


def _frequencies(t: str = "t", o: str = "o", name: str = "n") -> list:
    """How many entries have a pooled count of one to four."""
    return [F.count(F.when(F.col(t) + F.col(o) == i, 1)).alias(f"{name}{i}") for i in (1, 2, 3, 4)]


def _discount(n1: int, n2: int, n3: int, n4: int) -> float:
    """Modified Kneser-Ney's discount of counts of three and more, from the pooled counts."""
    found = 3 - 4 * n1 / (n1 + 2 * n2) * n4 / n3 if n1 and n2 and n3 else 1.5
    return float(min(max(found, 0.5), 2.5))


def fit_models(docs: DataFrame, text: str, toxic: str) -> dict:
    """Both models as sorted hash arrays, counted on all of ``docs``.  The arrays hold the words and pairs that tell the classes apart."""
    words = cut(count_words(docs, text, toxic))
    vocabulary = words.filter(F.col("t") + F.col("o") > 0)
    n_t, n_o, n_words = vocabulary.agg(F.sum("t"), F.sum("o"), F.count("*")).first()
    model = {"words": (np.zeros(0, U),) + (np.zeros(0),) * 3, "pairs": (np.zeros(0, U),) + (np.zeros(0),) * 2, "unseen": 0.0}
    if not n_words or not n_t or not n_o:
        return model
    even, n = n_t / n_o, float(min(n_t, n_o))
    of = lambda c: F.col(c) * F.lit(n / n_t if c.endswith("t") else n / n_o)  # noqa: E731 - both classes have n in all
    own = lambda c, d: F.greatest(c - F.lit(d), F.lit(0.0))
    # the variance of the difference as counted, or as it would be if the classes had one share: the larger one
    spread = lambda t, o: F.greatest(F.col(t) + even * even * F.col(o), even * (F.col(t) + F.col(o)))
    apart = lambda t, o: F.pow(F.col(t) - even * F.col(o), 2.0) > APART ** 2 * spread(t, o)
    often = lambda kind: of("t") + of("o") >= MIN_COUNT[kind]
    telling = cut(vocabulary.filter(often("words") & apart("dt", "do")).select(F.col("key").alias("word"), F.lit(True).alias("tells")))
    # words: the share of a class's different pairs that end with them (continuation counts), however often these occur
    seen = Observation()
    sums = [F.sum(c).alias(c) for c in ("k_t", "k_o", "n1", "n2", "n3", "n4")]
    found = by_word(count_pairs(docs, text, toxic), often("pairs") & apart("t", "o")).observe(seen, *sums, *_frequencies("k_t", "k_o", "c"))
    side = F.broadcast(telling) if telling.count() <= BROADCAST_LABELS else telling
    found = cut(found.join(side, "word", "left").filter((F.size("pairs") > 0) | F.col("tells")))
    k_t, k_o = seen.get["k_t"], seen.get["k_o"]
    k, d1, d2 = float(min(k_t, k_o)), *[_discount(*[seen.get[f"{c}{i}"] for i in (1, 2, 3, 4)]) for c in "cn"]
    follows = lambda c: F.col(c) * F.lit(k / (k_t if c == "k_t" else k_o))  # noqa: E731 - both classes have k in all
    kept = found.filter("tells")
    freed = F.coalesce(F.sum(F.least(follows("k_t"), F.lit(d1)) + F.least(follows("k_o"), F.lit(d1))), F.lit(0.0))
    freed, n_kept, taken = kept.agg(freed, F.count("*"), F.sum(follows("k_t") + follows("k_o"))).first()
    # what the discounts free is shared out evenly over the words, with one weight for both classes
    free = max(freed / k / 2, 1e-6) / (n_kept or 1)
    kept = cut(kept.select("word", *[(own(follows(f"k_{c}"), d1) / k + free).alias(f"p_{c}") for c in "to"]))
    # pairs: own discounted share; the rest of each context, one weight for both classes, goes to the words
    many = cut(found.select(F.explode("pairs").alias("p")).select("p.*"))
    after = words.select(F.col("key").alias("prev"), of("v_t").alias("v_t"), of("v_o").alias("v_o"))
    unseen = float(np.log(max(1 - float(taken or 0) / (2 * k), 1e-6) / (n_words + 1)))
    # a pair may tell the classes apart though its second word does not: that word has one probability for both
    keys = np.sort(many.select("key").toArrow()["key"].to_numpy().astype(np.int64).view(U))
    many = many.join(words_of_pairs(docs, text, keys), "key").join(after, "prev").join(kept, "word", "left")
    many = cut(many.select("key", "prev", "v_t", "v_o", *[F.coalesce(f"p_{c}", F.lit(float(np.exp(unseen)))).alias(f"p_{c}") for c in "to"],
                           *[F.coalesce(F.try_divide(own(of(c), d2), F.col(f"v_{c}")), F.lit(0.0)).alias(f"own_{c}") for c in "to"]))
    rest = F.greatest(1 - F.sum((F.col("own_t") * F.col("v_t") + F.col("own_o") * F.col("v_o")) / (F.col("v_t") + F.col("v_o"))), F.lit(1e-6))
    rest = cut(many.groupBy("prev").agg(rest.alias("g")))
    many = many.join(rest, "prev").select("key", *[F.log(F.col(f"own_{c}") + F.col("g") * F.col(f"p_{c}")).alias(f"l_{c}") for c in "to"])
    single = kept.join(rest.withColumnRenamed("prev", "word"), "word", "full")
    single = single.select(F.col("word").alias("key"), *[F.coalesce(F.log(f"p_{c}"), F.lit(unseen)).alias(f"l_{c}") for c in "to"],
                           F.coalesce(F.log("g"), F.lit(0.0)).alias("b"))
    for name, rows, columns in (("words", single.toArrow(), ("l_t", "l_o", "b")), ("pairs", many.toArrow(), ("l_t", "l_o"))):
        key = rows["key"].to_numpy().astype(np.int64).view(U)
        by = np.argsort(key)
        model[name] = (key[by], *[rows[c].to_numpy().astype(np.float32)[by] for c in columns])
    model["unseen"] = unseen
    return model


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return keys[at] == h, at


def likelihoods(model: dict, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Toxic and ordinary log-likelihood per word, and the number of words, of each text."""
    prev, word, doc = tokens(data, offsets)
    known, at = _find(model["words"][0], word)
    ctx, c_at = _find(model["words"][0], prev)
    pair, p_at = _find(model["pairs"][0], pair_key(prev, word))
    n = np.bincount(doc, minlength=len(offsets) - 1)
    out = []
    for i in (0, 1):
        lp = np.full(len(word), model["unseen"])
        lp[known] = model["words"][1 + i][at[known]]
        lp[ctx] += model["words"][3][c_at[ctx]]
        lp[pair] = model["pairs"][1 + i][p_at[pair]]
        out.append(np.bincount(doc, lp, len(offsets) - 1) / np.maximum(n, 1))
    return out[0], out[1], n


FIELDS = {"toxic_ll": "double", "ordinary_ll": "double"}


def log_likelihoods(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus both log-likelihoods per word (0 for a text without words)."""
    docs = without(docs, *FIELDS)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def score(batches):
        arrays = shared.value
        for batch in batches:
            parts = [likelihoods(arrays, data, off)[:2] for _, _, data, off in texts.chunks(batch.column(at))]
            made = [pa.array(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0), pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *FIELDS])

    return map_arrow(docs, score, extended(docs, **FIELDS))


def class_weights(y: np.ndarray, n: dict[int, int], rows: np.ndarray) -> np.ndarray:
    """A weight for each point of ``rows`` rows, so that the classes have the shares that all labels (``n`` of each
    class) give them, however many rows of each there are."""
    out, total = rows.astype(float), sum(n.values())
    for c, count in n.items():
        of_class = y == c
        if of_class.any():
            out[of_class] *= count / total * rows.sum() / rows[of_class].sum()
    return out


def curve_points(seen: DataFrame) -> DataFrame:
    """(toxic, d, rows) of rows (toxic, d, h): each row is a point, or, of a class with more than ``MAX_CURVE_DOCS`` rows, so many
    neighbours in the order of d are one, their mean.  Ranks come from the places in a distributed sort."""
    part = F.shiftright("m", 33)
    placed = cut(seen.sort("toxic", "d", "h").withColumn("m", F.monotonically_increasing_id()))
    parts = placed.groupBy("toxic", part.alias("part")).agg(F.count("*").alias("n"), F.min("m").alias("m0"))
    whole = Window.partitionBy("toxic")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("toxic", "part", F.col("m0") - F.coalesce(F.sum("n").over(earlier), F.lit(0)), F.sum("n").over(whole)).toDF("toxic", "part", "zero", "n")
    rank = F.col("m") - F.col("zero")
    placed = placed.withColumn("part", part).join(F.broadcast(parts), ["toxic", "part"])
    group = F.floor(rank * F.least(F.col("n"), F.lit(MAX_CURVE_DOCS)) / F.col("n"))
    d = F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.col("d")))
    return placed.groupBy("toxic", group.alias("group")).agg(F.avg(d).alias("d"), F.count("*").alias("rows"))


def fit_curve(diff: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic curve (Newton steps, slight ridge); the difference of
    the log-likelihoods itself decides where one class is missing."""
    if len(set(y.tolist())) < 2:
        return 10.0, 0.0
    diff = np.clip(diff, -CLIP, CLIP)
    scale = diff.std() or 1.0
    x = np.stack([diff / scale, np.ones(len(diff))], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 0.01 * b
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0] / scale), float(b[1])


def split(labels: DataFrame, doc_id: str, toxic: str) -> tuple[DataFrame, dict[int, int]]:
    """All labelled documents as (doc_id, toxic, curve), the curve's chosen by a hash of the id, and their
    number by class.  A document with several labels is toxic if one of
    them says so; null labels do not count."""
    one = (labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
           .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic")))
    one = cut(one.filter(F.col("toxic").isin(0, 1)).withColumn("curve", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0))
    return one, {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """All rows of ``docs`` with ``toxic_ll``, ``ordinary_ll``, ``score`` and ``predicted`` (columns of
    these names give way).  Only rows of ``labels`` are learnt from, from all of them.  A null or empty text gets the
    score of a difference of 0; repeated rows get the same score; without labels of both classes every
    score follows from a difference of 0."""
    one, of_class = split(labels, doc_id, toxic)
    few = sum(of_class.values()) <= BROADCAST_LABELS
    side = lambda rows: F.broadcast(rows) if few else rows
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    hashed = plain.select("doc_id", F.xxhash64("text").alias("h")).join(side(one.filter("not curve").select("doc_id", "toxic")), "doc_id")
    copies = hashed.groupBy("h", "toxic").agg(F.min("doc_id").alias("doc_id"))
    first = cut(copies.select("doc_id", "toxic").distinct())  # each text once for each class
    model = fit_models(plain.join(side(first), "doc_id"), "text", "toxic")
    seen = log_likelihoods(plain.join(side(one.filter("curve").select("doc_id", "toxic")), "doc_id"), model)
    points = curve_points(seen.select("toxic", (F.col("toxic_ll") - F.col("ordinary_ll")).alias("d"), F.xxhash64("doc_id").alias("h"))).toPandas()
    y = points["toxic"].to_numpy(float)
    slope, start = fit_curve(points["d"].to_numpy(float), y, class_weights(y, of_class, points["rows"].to_numpy(float)))
    rows = log_likelihoods(without(docs, "score", "predicted"), model, text)
    diff = F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.col("toxic_ll") - F.col("ordinary_ll")))
    score = 1 / (1 + F.exp(-(F.lit(slope) * diff + F.lit(start))))
    return rows.withColumn("score", score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, labels).select("doc_id", held.alias("held_out"), "score", "predicted", "toxic_ll", "ordinary_ll")
