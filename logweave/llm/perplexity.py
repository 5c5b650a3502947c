"""Quality rules: word and line rules plus bands of n-gram perplexity.

The language model is a modified Kneser-Ney model over the UTF-8 bytes of the texts, one for each
language.  Spark counts the n-grams of the highest order (each task sums its own first); all lower
orders follow from their distinct rows, and so do discounts, back-off weights and probabilities, as
joins and windows on tables of distinct n-grams.  No n-gram is left out for the model's size.

Memory: a model whose counted rows, contexts included, are at most ``MODEL_ROWS`` travels as sorted
arrays of 64-bit hashes, one pair per order, found by binary search.  A larger one stays distributed:
the probabilities of all n-grams of the highest order, back-off worked in, are a table that the distinct
n-grams of each chunk of texts are joined with.  Both ways give the same scores.

A document's score is its mean negative log-likelihood per byte, the logarithm of its perplexity.
Per language, median and median absolute deviation over the distinct texts give a lower and an upper
band, wider for short texts, whose mean scatters more.  A text with many copies counts once, in the
model as in the bands; every copy gets its verdict."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm import texts
from logweave.llm.common import attach, cut, extended, map_arrow, table, without

ORDER = 5
CUTOFF = 1
B = 257  # byte values 0..255 as 1..256; 0 stands before a text
#: Logarithms of the model are whole multiples of 1 / GRID, so their sums are exact in any order.
GRID = float(1 << 24)
#: Rows of a model that is broadcast, at most (16 bytes each in every worker); a larger one is joined.
MODEL_ROWS = 3_000_000
BAND = 12.0
SHORT_BYTES = 200
FLOOR = 0.01
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
SEED = 7219
U = np.uint64


def base_metrics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text of a chunk."""
    n = len(offsets) - 1
    starts, ends, doc = texts.words(data, offsets)
    per_doc = lambda d: np.bincount(d, minlength=n).astype(np.int64)
    before = np.concatenate([[0], np.cumsum((~texts.SPACE[data]) & ((data & 0xC0) != 0x80))])
    marks = np.concatenate([[0], np.cumsum(SYMBOL[data])])
    out = {"n_words": per_doc(doc), "word_chars": before[offsets[1:]] - before[offsets[:-1]],
           "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]]}
    # lines with a word, equal to an earlier line of the text
    l_start, l_end, l_doc = texts.spans(data != 10, offsets)
    in_words = np.concatenate([[0], np.cumsum(~texts.SPACE[data])])
    full = in_words[l_end] > in_words[l_start]
    l_start, l_end, l_doc = l_start[full], l_end[full], l_doc[full]
    out["n_dup_lines"] = per_doc(l_doc) - per_doc(_distinct(texts.hash_spans(data, l_start, l_end), l_doc))
    # words covered by a five-word window that the text has twice or more
    h, at = texts.windows(texts.hash_spans(data, starts, ends), doc, 5)
    key = texts.mix(h ^ texts.mix(doc[at].astype(U) + U(1)))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    covered = np.zeros(len(doc) + 5, np.int64)
    twice = at[count[back] > 1]
    covered[twice] += 1
    covered[twice + 5] -= 1
    out["n_repeat_words"] = per_doc(doc[np.cumsum(covered)[: len(doc)] > 0])
    return out


def _distinct(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The text index of every distinct (hash, text)."""
    _, at = np.unique(texts.mix(h ^ texts.mix(doc.astype(U) + U(1))), return_index=True)
    return doc[at]


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte, the ``order`` bytes that end there as one number in base 257."""
    n, lead = len(data), order - 1
    at = np.arange(n) + lead * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    padded = np.zeros(n + lead * (len(offsets) - 1), U)
    padded[at] = data
    padded[at] += U(1)
    key = padded.copy()
    power = 1
    for i in range(1, order):
        power *= B
        key[i:] += padded[:-i] * U(power)
    return key[at]


def _sum(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def text_hash(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_h1`` and ``_h2``, 128 bits that stand for the text."""
    t = F.col(f"`{text}`").cast("string")
    return without(docs, "_h1", "_h2").withColumns({"_h1": F.xxhash64(t), "_h2": F.xxhash64(F.lit(SEED), t)})


def distinct_texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(text, lang, _h1, _h2): each text of a language once.  Texts that occur once are read where they
    lie; of the others each task sends one copy."""
    rows = text_hash(docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")), "text")
    same = ["lang", "_h1", "_h2"]
    twice = cut(rows.groupBy(*same).agg(F.count("*").alias("n")).filter("n > 1").select(*same, F.lit(True).alias("twice")))
    marked = attach(rows, twice, same, F.xxhash64(F.monotonically_increasing_id()))
    once = marked.filter("twice is null").select("text", *same)
    return once.unionByName(marked.filter("twice").groupBy(*same).agg(F.first("text").alias("text")))


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, key, n): how often each language has each n-gram of the highest order, over its distinct
    texts: copies of a text say nothing more about the language."""
    top = U(B ** ORDER)

    def count(batches):
        codes, held, size = {}, [], 0
        for batch in batches:
            code = np.array([codes.setdefault(x or "", len(codes)) for x in batch.column(1).to_pylist()], U)
            for lo, hi, data, off in texts.chunks(batch.column(0)):
                part = np.unique(gram_keys(data, off) + np.repeat(code[lo:hi] * top, np.diff(off)), return_counts=True)
                held.append(part)
                size += len(part[0])
            if size > 4_000_000:
                held = [_sum(held)]
                size = len(held[0][0]) // 2
        if size:
            keys, n = _sum(held)
            names = np.array(list(codes), object)
            for i in range(0, len(keys), 65536):
                k = keys[i: i + 65536]
                yield pa.record_batch([pa.array(names[(k // top).astype(np.int64)], pa.string()), pa.array((k % top).astype(np.int64)),
                                       pa.array(n[i: i + 65536])], names=["lang", "key", "n"])

    rows = distinct_texts(docs, text, lang).select("text", "lang")
    return (map_arrow(rows, count, "lang string, key long, n long")
            .groupBy("lang", "key").agg(F.sum("n").alias("n")))


def _log(p: Column) -> Column:
    return F.rint(F.log(p) * GRID) / GRID


def levels_of(grams: DataFrame, order: int = ORDER, max_entries: int | None = None) -> list[DataFrame]:
    """Modified Kneser-Ney estimates, a table (lang, key, ctx, p, value, gamma, kept) for each order from
    1 on: ``p`` is the probability of the n-gram's last byte after the others, with what shorter n-grams
    give worked in (all of it, where the n-gram is not ``kept``), ``value`` its logarithm as the packed
    model adds it up; ``gamma`` is what the context leaves to the shorter one.  Only with ``max_entries`` are rarer n-grams of the highest order left to the back-off
    until no more remain.

    n-grams of two bytes or more seen once (shorter ones: in one context) are left to the back-off.  A
    text's own freaks would otherwise look likely to a model that has read them."""
    counted = {order: cut(grams)}
    for o in range(order - 1, 0, -1):
        # continuation counts: in how many distinct contexts the shorter n-gram occurs
        counted[o] = cut(counted[o + 1].groupBy("lang", F.pmod("key", F.lit(B ** o)).alias("key"))
                         .agg(F.count("*").alias("n")))
    least = CUTOFF
    total = counted[order].count() if max_entries is not None else 0
    if max_entries is not None and total > max_entries:
        hist = (counted[order].groupBy(F.least("n", F.lit(1000)).alias("c")).count()
                .orderBy("c").collect())
        for row in hist:
            total -= row["count"]
            least = max(least, row["c"])
            if total <= max_entries:
                break
    lower, levels = None, []
    for o in range(1, order + 1):
        t = counted[o]
        n = {i: F.count(F.when(F.col("n") == i, 1)) for i in (1, 2, 3, 4)}
        d = t.groupBy("lang").agg(*[n[i].alias(f"n{i}") for i in n])
        y = F.try_divide(F.col("n1").cast("double"), F.col("n1") + 2 * F.col("n2"))

        def discount(i, y=y):
            raw = F.lit(float(i)) - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}").cast("double"), F.col(f"n{i}"))
            return F.when(raw.between(0.05, i - 0.05), raw).otherwise(F.lit(i * 0.5))
        d = cut(d.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)]))
        t = attach(t, d, ["lang"], F.xxhash64("key"))
        cutoff = 0 if o == 1 else least if o == order else CUTOFF
        t = t.withColumn("d", F.when(F.col("n") <= cutoff, F.col("n").cast("double")).when(F.col("n") == 1, F.col("d1"))
                         .when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        t = t.withColumn("ctx", F.floor(F.col("key") / F.lit(B)) if o > 1 else F.lit(0).cast("long"))
        w = W.partitionBy("lang", "ctx")
        t = (t.withColumn("sum", F.sum("n").over(w)).withColumn("gamma", F.sum("d").over(w) / F.col("sum"))
             .withColumn("own", (F.col("n") - F.col("d")) / F.col("sum")))
        if o == 1:
            p = t.withColumn("p", F.col("own") + F.col("gamma") / F.lit(float(B))).withColumn("value", _log(F.col("p")))
        else:
            t = t.withColumn("suffix", F.pmod("key", F.lit(B ** (o - 1))))
            p = (t.join(lower.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q"), F.col("value").alias("rest")), ["lang", "suffix"])
                 .withColumn("p", F.col("own") + F.col("gamma") * F.col("q")))
            left = F.when(F.log("gamma") < -1e-9, _log(F.col("gamma"))).otherwise(0.0)
            p = p.withColumn("value", F.when(F.col("n") > cutoff, _log(F.col("p"))).otherwise(left + F.col("rest")))
        lower = cut(p.select("lang", "key", "ctx", "p", "value", "gamma", (F.col("n") > cutoff).alias("kept")))
        levels.append(lower)
    return levels


def model_rows(levels: list[DataFrame]) -> DataFrame:
    """Rows (ord, lang, key, context, value).  With ``context`` false, the log-probability of a kept
    n-gram; with true, the logarithm of what the context ``key`` of ``ord`` - 1 bytes leaves to the
    shorter one."""
    out = None
    for o, level in enumerate(levels, 1):
        own = level.filter("kept").select(F.lit(o).alias("ord"), "lang", "key", F.lit(False).alias("context"), "value")
        left = level.groupBy("lang", F.col("ctx").alias("key")).agg(F.max("gamma").alias("gamma"))
        left = left.filter(F.log("gamma") < -1e-9).withColumn("value", _log(F.col("gamma")))
        rows = own.unionByName(left.select(F.lit(o).alias("ord"), "lang", "key", F.lit(True).alias("context"), "value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def estimate(grams: DataFrame, order: int = ORDER, max_entries: int | None = None) -> DataFrame:
    return model_rows(levels_of(grams, order, max_entries))


def _lang_hash(name: str | None) -> np.uint64:
    return U(int.from_bytes(hashlib.blake2b((name or "").encode(), digest_size=8).digest(), "little"))


def pack(model: DataFrame, order: int = ORDER) -> dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]:
    """The model as sorted hash arrays: (order, context) -> (hashes, values).  All its rows come to the
    driver: count them first."""
    t = model.toArrow()
    ords, context = t["ord"].to_numpy(), t["context"].to_numpy()
    keys, value = t["key"].to_numpy().astype(U), t["value"].to_numpy()
    coded = t["lang"].combine_chunks().dictionary_encode() if t.num_rows else None
    salt = (np.array([_lang_hash(x) for x in coded.dictionary.to_pylist()], U)[coded.indices.to_numpy()]
            if t.num_rows else np.zeros(0, U))
    out = {}
    for o in range(1, order + 1):
        for c in (False, True):
            mine = (ords == o) & (context == c)
            h = texts.mix(keys[mine] ^ salt[mine])
            by = np.argsort(h)
            out[o, c] = (h[by], value[mine][by])
    return out


def log_likelihood(model: dict, data: np.ndarray, offsets: np.ndarray, salt: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Sum of log-probabilities for each text; ``salt`` is the language hash of each text."""
    keys = gram_keys(data, offsets, order)
    who = np.repeat(salt, np.diff(offsets))
    h, back = np.unique(texts.mix(keys ^ who), return_inverse=True)
    one = np.empty(len(h), np.int64)  # a byte for each distinct n-gram of the chunk
    one[back] = np.arange(len(back))
    keys, who = keys[one], who[one]
    left, lp = np.arange(len(h)), np.zeros(len(h))
    for o in range(order, 0, -1):
        found, at = _find(model[o, False][0], h)
        lp[left[found]] += model[o, False][1][at[found]]
        left, who, keys = left[~found], who[~found], keys[~found]
        if not len(left):
            break
        known, at = _find(model[o, True][0], texts.mix(keys // U(B) ^ who))
        lp[left[known]] += model[o, True][1][at[known]]
        keys = keys % U(B ** (o - 1))
        h = texts.mix(keys ^ who)
    lp[left] -= np.log(B)
    sums = np.concatenate([[0.0], np.cumsum(lp[back])])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _find(table_: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table_):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(table_, h), len(table_) - 1)
    return table_[at] == h, at


FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
          "n_repeat_words": "long", "n_bytes": "long", "nll": "double"}


def joined_nll(docs: DataFrame, model: DataFrame, text: str, lang: str) -> DataFrame:
    """(_tl, _t1, _t2, nll) of each distinct text of ``docs`` (language and hash) that has bytes, by a join
    of its n-grams with ``model`` (lang, key, value).  Each chunk of texts sends an n-gram once, with the
    texts that have it, so a common n-gram is one row a chunk."""
    top = U(B ** ORDER)

    def explode(batches):
        for batch in batches:
            names = [x or "" for x in batch.column(1).to_pylist()]
            h1, h2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for lo, hi, data, off in texts.chunks(batch.column(0)):
                if not len(data):
                    continue
                kinds, code = np.unique(np.array(names[lo:hi], object), return_inverse=True)
                doc = np.repeat(np.arange(hi - lo), np.diff(off))
                key = gram_keys(data, off) + code.astype(U)[doc] * top
                by = np.lexsort((doc, key))
                key, doc = key[by], doc[by]
                new = np.ones(len(key), bool)
                new[1:] = key[1:] != key[:-1]
                pair = new.copy()
                pair[1:] |= doc[1:] != doc[:-1]
                at = np.flatnonzero(pair)
                n, d = np.diff(np.append(at, len(key))), doc[at] + lo
                first = np.flatnonzero(new[at])
                key = key[at][first]
                held = pa.StructArray.from_arrays([pa.array(h1[d]), pa.array(h2[d]), pa.array(n)], names=["_t1", "_t2", "n"])
                rows = pa.ListArray.from_arrays(pa.array(np.append(first, len(d)).astype(np.int32)), held)
                lang_of = pa.array(kinds[(key // top).astype(np.int64)], pa.string())
                made = pa.record_batch([lang_of, pa.array((key % top).astype(np.int64)), rows], names=["_tl", "_key", "held"])
                for i in range(0, len(key), 65536):
                    yield made.slice(i, 65536)

    rows = distinct_texts(docs, text, lang).select("text", "lang", "_h1", "_h2")
    grams = map_arrow(rows, explode, "_tl string, _key long, held array<struct<_t1:long,_t2:long,n:long>>")
    found = grams.join(model, (F.col("_tl") == F.col("lang")) & (F.col("_key") == F.col("key")))
    found = found.select("_tl", "value", F.explode("held").alias("h")).select("_tl", "h._t1", "h._t2", "h.n", "value")
    return cut(found.groupBy("_tl", "_t1", "_t2").agg((-F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("nll")))


def score_texts(docs: DataFrame, model: dict | DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns of ``docs`` plus ``FIELDS`` (columns of these names give way).  ``nll`` is the mean
    negative log-likelihood per byte, null for a text without bytes.  A model that is a table must have
    been fitted on texts that include these."""
    docs = without(docs, *FIELDS)
    if not isinstance(model, dict):
        nll = joined_nll(docs, model, text, lang)
        whole = F.col(f"`{text}`").cast("string")
        rows = _scored(docs, None, text, lang).drop("nll")
        rows = rows.withColumns({"_tl": F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")),
                                 "_t1": F.xxhash64(whole), "_t2": F.xxhash64(F.lit(SEED), whole)})
        return attach(rows, nll, ["_tl", "_t1", "_t2"], F.xxhash64(F.monotonically_increasing_id())).drop("_tl", "_t1", "_t2")
    return _scored(docs, model, text, lang)


def _scored(docs: DataFrame, model: dict | None, text: str, lang: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    t_at, l_at = docs.columns.index(text), docs.columns.index(lang)

    def score(batches):
        arrays = shared.value
        for batch in batches:
            salt = np.array([_lang_hash(x) for x in batch.column(l_at).cast(pa.string()).to_pylist()], U)
            cols = {f: [] for f in FIELDS}
            for lo, hi, data, off in texts.chunks(batch.column(t_at)):
                for f, v in base_metrics(data, off).items():
                    cols[f].append(v)
                size = np.diff(off)
                cols["n_bytes"].append(size)
                if arrays is None:
                    cols["nll"].append(np.full(hi - lo, np.nan))
                    continue
                with np.errstate(invalid="ignore", divide="ignore"):
                    cols["nll"].append(-log_likelihood(arrays, data, off, salt[lo:hi]) / size)
            made = []
            for f, kind in FIELDS.items():
                v = np.concatenate(cols[f]) if cols[f] else np.zeros(0)
                made.append(pa.array(v.astype(np.float64), mask=np.isnan(v.astype(np.float64))) if kind == "double"
                            else pa.array(v.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *FIELDS])

    return map_arrow(docs, score, extended(docs, **FIELDS))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", most: int | None = None) -> dict | DataFrame:
    """The model to be broadcast, if it has at most ``most`` (else ``MODEL_ROWS``) rows; otherwise the
    table (lang, key, value) to be joined, with a value for each n-gram of the highest order."""
    levels = levels_of(count_grams(docs, text, lang))
    model = model_rows(levels)
    if model.count() <= (MODEL_ROWS if most is None else most):
        return pack(model)
    return levels[-1].select("lang", "key", "value")


def bands(scored: DataFrame, lang: str = "lang") -> DataFrame:
    """(lang, mid, spread): median and scaled median absolute deviation of ``nll`` by language, each
    distinct text (by :func:`text_hash`) once."""
    scored = scored.filter("nll is not null").groupBy(F.col(lang).alias("lang"), "_h1", "_h2").agg(F.first("nll").alias("nll"))
    scored = cut(scored.select("lang", "nll"))
    mid = cut(scored.groupBy("lang").agg(F.percentile_approx("nll", 0.5, 10000).alias("mid")))
    off = attach(scored, mid, ["lang"], F.xxhash64("nll")).withColumn("off", F.abs(F.col("nll") - F.col("mid")))
    return cut(off.groupBy("lang").agg(F.first("mid").alias("mid"),
                                       (F.percentile_approx("off", 0.5, 10000) * 1.4826).alias("spread")))


def verdicts(scored: DataFrame, band: DataFrame, lang: str = "lang", width: float = BAND) -> DataFrame:
    """Adds ``perplexity``, ``base_failed`` and ``kept`` to the rows of :func:`score_texts`."""
    band = cut(band.select(F.col("lang").alias("_band_lang"), F.col("mid").alias("_band_mid"), F.col("spread").alias("_band_spread")))
    rows = without(scored, "perplexity", "base_failed", "kept").withColumn("_band_lang", F.col(lang))
    rows = attach(rows, band, ["_band_lang"], F.xxhash64("nll", "n_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    reach = width * F.greatest(F.col("_band_spread"), F.lit(FLOOR) * F.col("_band_mid")) * F.sqrt(1 + SHORT_BYTES / F.col("n_bytes"))
    inside = F.coalesce(F.abs(F.col("nll") - F.col("_band_mid")) <= reach, F.lit(True))
    return (rows.withColumn("perplexity", F.exp("nll")).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & inside).drop("_band_lang", "_band_mid", "_band_spread"))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", width: float = BAND,
                  most: int | None = None) -> DataFrame:
    """Every row of ``docs`` with its counts, ``perplexity``, ``base_failed`` and ``kept``.

    A null or empty text has no words: base rules reject it.  A null language is a language of its
    own.  Repeated rows each get the same result.  An empty table gives an empty table."""
    model = fit(docs, text, lang, most)
    narrow = cut(score_texts(text_hash(docs.select(text, lang), text), model, text, lang).select(F.col(lang).alias("lang"), "_h1", "_h2", "nll"))
    return verdicts(score_texts(docs, model, text, lang), bands(narrow), lang, width)


def op7_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs)
    scored = cut(score_texts(text_hash(docs, "text"), model).drop("text"))
    return (verdicts(scored, bands(scored))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "perplexity"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    return quality_rules(docs).filter("kept").select(*docs.columns)
