"""Spelling variants by asymmetric q-chunks.

Two words within one edit of each other (one code point inserted, deleted or replaced) agree in one of the
two halves of the shorter word, at a place shifted by at most one.  So the shorter word of a pair gives two
disjoint chunks, its halves, and the longer one the grams of its own text at the places, shifted by none or
one, where such a chunk can lie; words are joined where a chunk is a gram, and verified.

A short half can be common to very many words.  The edit lies in the other half, in one of *its* halves, so
the part of it that stays is joined on as well: a chunk's row becomes two, each with three quarters of the
word.  The edit's place is the first code point that differs; a pair is taken from the row of that quarter
only, so each pair is found once.  Every word has four rows as the shorter and eight as the longer word,
keyed by a hash of the agreeing parts, so the work follows the vocabulary and a common beginning or ending
is not one key.

Words are counted by tasks in batches, and partial sums before the shuffle, so a frequent word is one
small row per task."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import texts
from logweave.llm.common import cut, map_arrow, table

MIN_CHARS = 6
MIN_COUNT = 5
#: How much more frequent a word's form has to be.
RATIO = 5
#: In the query, one in so many words (by CRC of document and word) loses a letter.
SPOILED = 199
#: Different words a task holds before it hands their counts on.
BUFFER_WORDS = 1 << 17
#: Words longer than this (in bytes) have their CRC taken one by one.
_IN_STEP = 64

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF (in UTF-8: byte C3 and the byte after it): starts,
    ends, text index."""
    lead = data == 0xC3
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return texts.spans(inside, offsets)


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each span's bytes, continued from the CRCs ``before``, all spans in step."""
    size = ends - starts
    by = np.argsort(-size, kind="stable")
    at, left = starts[by], size[by]
    state = before[by] ^ np.uint32(0xFFFFFFFF)
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, "left"))
        state[:live] = _CRC[(state[:live] ^ data[at[:live] + step]) & np.uint32(255)] ^ (state[:live] >> np.uint32(8))
    out = np.empty_like(state)
    out[by] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _chunk_counts(data: np.ndarray, offsets: np.ndarray, ids: list, min_chars: int, spoiled: int | None) -> dict[bytes, int]:
    data = texts.LOWER[data]
    starts, ends, doc = letters(data, offsets)
    marks = np.concatenate([[0], np.cumsum(data == 0xC3)])
    chars = ends - starts - (marks[ends] - marks[starts])
    enough = chars >= min_chars
    starts, ends, doc, chars = starts[enough], ends[enough], doc[enough], chars[enough]
    counts: dict[bytes, int] = {}
    if spoiled:
        known = np.array([i is not None for i in ids], bool)
        prefix = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)[doc]
        size = ends - starts
        crc = np.zeros(len(starts), np.uint32)
        short = size <= _IN_STEP
        crc[short] = crcs(data, starts[short], ends[short], prefix[short])
        for k in np.flatnonzero(~short).tolist():
            crc[k] = zlib.crc32(data[starts[k]: ends[k]].tobytes(), int(prefix[k]))
        hit = (crc % np.uint32(spoiled) == 0) & known[doc]
        for k in np.flatnonzero(hit).tolist():
            if chars[k] > min_chars:
                word, i = data[starts[k]: ends[k]].tobytes().decode(), int(crc[k]) % int(chars[k])
                word = (word[:i] + word[i + 1:]).encode()
                counts[word] = counts.get(word, 0) + 1
        starts, ends = starts[~hit], ends[~hit]
    _, at, n = np.unique(texts.hash_spans(data, starts, ends), return_index=True, return_counts=True)
    for s, e, k in zip(starts[at].tolist(), ends[at].tolist(), n.tolist()):
        word = data[s:e].tobytes()
        counts[word] = counts.get(word, 0) + k
    return counts


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, spoiled: int | None = None) -> DataFrame:
    """(word, n): how often each word of at least ``min_chars`` code points occurs in the whole texts, with
    A-Z lower-cased.  ``spoiled``: one occurrence in so many, by the CRC of ``<doc_id>:<word>``, loses the
    code point that the CRC names; a document without id loses none."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def count(batches):
        held: dict[bytes, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist() if spoiled else [None] * batch.num_rows
            for lo, hi, data, off in texts.chunks(batch.column(1)):
                for word, n in _chunk_counts(data, off, ids[lo:hi], min_chars, spoiled).items():
                    held[word] = held.get(word, 0) + n
                if len(held) > BUFFER_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return map_arrow(rows, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _bounds(chars: Column) -> list[Column]:
    """Ends of the quarters of a word of ``chars`` code points."""
    half = F.floor(chars / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((chars - half) / 2), chars]


def _rows(words: DataFrame, shift: int | None) -> DataFrame:
    """The four rows of each word as the shorter one of a pair, or (with ``shift``) as the one with
    ``shift`` more code points."""
    word, chars = F.col("word"), F.length("word")
    base = chars - (shift or 0)
    ends = _bounds(base)
    moved = shift or 0
    parts = F.array(*[F.struct(F.lit(k).alias("quarter"),
                               F.xxhash64(F.lit(k), base, F.substr(word, F.lit(1), ends[k]),
                                          F.substr(word, ends[k + 1] + 1 + moved, chars)).alias("key"),
                               ends[k + 1].cast("int").alias("upto")) for k in range(4)])
    kind = [] if shift is None else [F.lit(shift).alias("shift")]
    return words.select("word", "n", *kind, F.explode(parts).alias("p")).select("p.key", "p.quarter", "p.upto", "word", "n", *kind)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): each pair of different words that one edit turns into each other, once.  ``words``
    (word, n) has each word once, of at least four code points."""
    short = _rows(words, None).select("key", "quarter", "upto", F.col("word").alias("a"), F.col("n").alias("na"))
    long = _rows(words, 0).unionByName(_rows(words, 1)).select(F.col("key").alias("k2"), F.col("quarter").alias("q2"), F.col("word").alias("b"), F.col("n").alias("nb"), "shift")
    begin = lambda w: F.substr(w, F.lit(1), F.col("upto"))
    own = (F.col("quarter") == 3) | (begin(F.col("a")) != begin(F.col("b")))  # they differ first in this quarter
    cond = ((F.col("key") == F.col("k2")) & (F.col("quarter") == F.col("q2")) & ((F.col("shift") == 1) | (F.col("a") < F.col("b")))
            & (F.length("a") + F.col("shift") == F.length("b")) & own & (F.levenshtein("a", "b", 1) == 1))
    return short.join(long.hint("merge"), cond).select("a", "na", "b", "nb")


def spelling_forms(counts: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of ``counts`` (word, n) with at least
    ``min_chars`` code points (four or more) and ``min_count`` occurrences.

    Words are near if one inserted, deleted or replaced code point makes one the other.  A word's ``form``
    is its near word with the most occurrences (ties: the smallest in code-point order), where it has at
    least ``ratio`` times the word's; ``root`` follows forms to the last.  Words are counted over all rows,
    so repeated rows and several rows of one word add up; a null word or count is left out; other columns
    of ``counts`` are not used.  An empty table gives an empty one; a word may be very long."""
    if min_chars < 4:
        raise ValueError("quarters of a word need four code points")
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its word")
    words = counts.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = cut(words.filter((F.length("word") >= min_chars) & (F.col("n") >= min_count)))
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("n")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("n"))))
    near = near_pairs(words).select(both.alias("p")).groupBy(F.col("p.word").alias("w")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("p.n")).alias("less"), F.col("p.near").alias("near"))).alias("best"))
    best_n = -F.col("best.less")
    judged = words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(best_n >= ratio * F.col("n"), c).alias(name) for c, name in ((F.col("best.near"), "form"), (best_n, "form_n"))])
    judged = cut(judged)
    roots = _roots(judged.filter("form is not null").select("word", F.col("form").alias("root")))
    return judged.join(roots.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): each word's last form.  Every round doubles the steps followed; counts grow by the
    ratio at each step, so a chain is short and there is no circle."""
    while True:
        after = forms.select(F.col("word").alias("w"), F.col("root").alias("next"))
        moved = cut(forms.join(after, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forms = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return forms


def op13_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_forms(word_counts(docs, spoiled=SPOILED))


OP13_SQL = f"""
WITH crc AS (SELECT [{', '.join(str(int(x)) for x in _CRC)}]::BIGINT[] AS t),
r AS (SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)),
o AS (SELECT doc_id, w, COUNT(*) AS n FROM r WHERE length(w) >= {MIN_CHARS} GROUP BY ALL),
h AS (SELECT w, n, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR || ':' || w, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM o, crc),
s AS (SELECT CASE WHEN h % {SPOILED} = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, SUM(n)::BIGINT AS n FROM s WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING SUM(n) >= {MIN_COUNT}),
d AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
e AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM d),
p AS (SELECT a.word, b.word AS near, b.n FROM e a JOIN e b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT e.word, v.word, v.n FROM e JOIN v ON v.word = e.rest UNION SELECT v.word, e.word, e.n FROM e JOIN v ON v.word = e.rest),
g AS (SELECT word, COUNT(*) AS n_near, MAX(n) AS top FROM p GROUP BY word),
b AS (SELECT g.word, n_near, top, MIN(near) AS near FROM g JOIN p ON p.word = g.word AND p.n = g.top GROUP BY ALL),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= {RATIO} * v.n THEN near END AS form, CASE WHEN top >= {RATIO} * v.n THEN top END AS form_n
  FROM v LEFT JOIN b USING (word)),
c AS (WITH RECURSIVE x AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT x.word, f.form, k + 1 FROM x JOIN f ON f.word = x.root WHERE f.form IS NOT NULL)
  SELECT word, arg_max(root, k) AS root FROM x GROUP BY word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM f JOIN c USING (word)
"""
