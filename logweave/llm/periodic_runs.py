"""Periodic runs of words: stretches that repeat a block of ``q`` words at least twice.

A run of period ``q`` is a diagonal of the table "word i equals word i - q": as long as words keep
matching, the match length of lag ``q`` grows; when it ends with ``max(q, min_length - q)`` matches or
more, a run has ended.  Only a few cells of that table are kept:

* A lag in ``[B, 2B)`` needs ``B`` matches in a row, so for these lags a cell counts only where the last
  ``B`` words equal an earlier occurrence of themselves, looked up by the name of their window.  Window
  lengths double from band to band; names of the next band are pairs of names of this one, so equal names
  mean equal words.  Bands end when no window occurs twice.
* Occurrences of a window at most ``B / 2`` apart have a constant step, a shorter period, and form a chain
  inside a run that a lower band has found.  Two chains meet on the lags that align their first or their
  last members; where the chains touch, also on the lags a step further.  No other lag of theirs can match
  long enough.  So a text of one word a million times has few cells, not their square.

Cells of one lag that overlap are one diagonal.  Its whole match length is found by jumps over names, longest
window first.  Of the diagonals with one stretch, the least lag is the stretch's period.

A batch of texts is one sequence, with a word of its own between texts, which no diagonal can cross."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import texts
from logweave.llm.common import SPACES, extended, map_arrow, table, without

MIN_LENGTH = 12
#: Words of the texts that are searched together (a longer text is searched alone).
CHUNK_WORDS = 1 << 17
FIELDS = {"runs": "array<struct<start:long,length:long,period:long>>", "collapsed": "string"}
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _names(shorter: np.ndarray, length: int, longer: int) -> np.ndarray:
    """Names of all windows of ``longer`` words, from those of ``length`` words (at least half as many)."""
    n = len(shorter) - (longer - length)
    if n <= 0:
        return np.zeros(0, np.int64)
    pair = shorter[:n] * (int(shorter.max()) + 1) + shorter[longer - length: longer - length + n]
    return np.unique(pair, return_inverse=True)[1].astype(np.int64)


def _cells(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window start, lag) of the cells of the lags in ``[size, 2 * size)``."""
    order = np.argsort(names, kind="stable")
    name = names[order]
    linked = (name[1:] == name[:-1]) & (2 * (order[1:] - order[:-1]) <= size)
    head = np.flatnonzero(np.concatenate([[True], ~linked]))
    tail = np.concatenate([head[1:], [len(order)]]) - 1
    first, last, name = order[head], order[tail], name[head]
    members = tail - head + 1
    step = np.where(members > 1, order[np.minimum(head + 1, len(order) - 1)] - first, 0)
    at, lag = [], []
    for back in (1, 2, 3):  # chains are over size / 2 apart, so a fourth is out of reach
        c = np.flatnonzero((name[back:] == name[:-back]) & (first[back:] - last[:-back] < 2 * size)) + back
        p = c - back
        at += [first[c], last[c]]
        lag += [first[c] - first[p], last[c] - last[p]]
        if back == 1:
            d = np.maximum(step[c], step[p])
            touch = (d > 0) & (first[c] - last[p] - size < 2 * d)
            c, p, d = c[touch], p[touch], d[touch]
            nearest = first[c] - last[p]
            times = np.minimum(members[c] + members[p] - 1, np.maximum(0, (2 * size - 1 - nearest) // np.maximum(d, 1) + 1))
            k = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            c, p, d, nearest = (np.repeat(x, times) for x in (c, p, d, nearest))
            at.append(first[c] + np.minimum(k, members[c] - 1) * d)
            lag.append(nearest + k * d)
    at, lag = np.concatenate(at), np.concatenate(lag)
    fit = (lag >= size) & (lag < 2 * size)
    return at[fit], lag[fit]


def _diagonals(at: np.ndarray, lag: np.ndarray, size: int, tables: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first match, end of matches, lag) of the diagonals through the cells."""
    by = np.lexsort((at, lag))
    at, lag = at[by], lag[by]
    new = np.ones(len(at), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (at[1:] - at[:-1] > size)
    left, lag = at[new].copy(), lag[new]
    right = left.copy()
    for length, names in reversed(tables):
        live = np.arange(len(right))
        while live.size:
            live = live[right[live] < len(names)]
            live = live[names[right[live]] == names[right[live] - lag[live]]]
            right[live] += length
        live = np.arange(len(left))
        while live.size:
            live = live[left[live] - lag[live] >= length]
            live = live[names[left[live] - length] == names[left[live] - length - lag[live]]]
            left[live] -= length
    return left, right, lag


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of ``words`` (numbers from 0 up), by start, then length."""
    if min_length < 2:
        raise ValueError("a run has at least two words")
    found = []
    words = np.unique(words, return_inverse=True)[1].astype(np.int64)
    size = (min_length + 1) // 2  # a lag q needs max(q, min_length - q) matches, never fewer than this
    for q in range(1, min(size, len(words))):
        equal = np.concatenate([[False], words[q:] == words[:-q], [False]])
        edge = np.flatnonzero(equal[1:] != equal[:-1])
        found.append((edge[::2] + q, edge[1::2] + q, np.full(len(edge) // 2, q)))
    lengths = [size]
    while lengths[-1] > 1:
        lengths.append((lengths[-1] + 1) // 2)
    tables = [(1, words)]
    for length in reversed(lengths[:-1]):
        tables.append((length, _names(tables[-1][1], tables[-1][0], length)))
    while len(tables[-1][1]) and int(tables[-1][1].max()) + 1 < len(tables[-1][1]):  # a window occurs twice
        size, names = tables[-1]
        found.append(_diagonals(*_cells(names, size), size, tables))
        tables.append((2 * size, _names(names, size, 2 * size)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    left, right, lag = (np.concatenate([x[i] for x in found]).astype(np.int64) for i in range(3))
    enough = right - left >= np.maximum(lag, min_length - lag)
    start, length, lag = (left - lag)[enough], (right - left + lag)[enough], lag[enough]
    by = np.lexsort((lag, length, start))
    start, length, lag = start[by], length[by], lag[by]
    least = np.ones(len(start), bool)  # a stretch's period is its least lag
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[least], length[least], lag[least]


def _repeats(words: list[list[bytes]], sizes: np.ndarray, size: int) -> np.ndarray:
    """Texts in which some window of ``size`` words may occur twice (equal hashes; none is missed)."""
    h = np.fromiter(map(hash, chain.from_iterable(words)), np.int64, int(sizes.sum())).view(texts.U)
    doc = np.repeat(np.arange(len(words)), sizes)
    h, at = texts.windows(h, doc, size)
    h = texts.mix(h + doc[at].astype(texts.U))
    by = np.argsort(h)
    return np.unique(doc[at[by[1:][h[by[1:]] == h[by[:-1]]]]])


def search_texts(split: list[list[bytes]], min_length: int = MIN_LENGTH) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of each text that has any, the texts given as lists of words."""
    sizes = np.array([len(w) for w in split], np.int64)
    chosen = _repeats(split, sizes, (min_length + 1) // 2).tolist()
    if not chosen:
        return {}
    number: dict[bytes, int] = {}  # equal numbers are equal words
    ids: list[int] = []
    for k, d in enumerate(chosen):
        ids += [number.setdefault(x, len(number)) for x in split[d]]
        ids.append(-1 - k)  # a word of its own after each text
    base = np.cumsum(sizes[chosen] + 1) - (sizes[chosen] + 1)
    start, length, period = find_runs(np.array(ids, np.int64), min_length)
    of = np.searchsorted(base, start, "right") - 1
    cut = np.searchsorted(of, np.arange(len(chosen) + 1)).tolist()
    return {d: (start[a:b] - base[k], length[a:b], period[a:b]) for k, (d, a, b) in enumerate(zip(chosen, cut[:-1], cut[1:])) if a < b}


def _kept(n: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which words no run holds after its first period."""
    start, length, period = runs
    cover = np.bincount(start + period, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(cover[:n]) == 0


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """All columns of ``docs`` plus ``runs`` (start, length, period of each run in words, by start, then
    period) and ``collapsed``: the words that no run holds after its first period, joined by one space
    (columns of these names give way).

    Words are runs of anything but ASCII white space.  A run is a stretch of at least ``min_length`` words
    and twice its smallest period that no neighbouring word extends; the same words may lie in several runs.
    A null or empty text has no runs and an empty ``collapsed``; rows are judged one by one, so null ids,
    ties and repeated rows change nothing.  A very long text is searched whole, by itself."""
    docs = without(docs, *FIELDS)
    at = docs.columns.index(text)

    def search(batches):
        for batch in batches:
            values = batch.column(at).cast(pa.large_binary()).to_pylist()
            runs: list[list[dict]] = []
            collapsed: list[bytes] = []
            lo = 0
            while lo < len(values):
                split, total = [], 0
                while lo < len(values) and (not split or total < CHUNK_WORDS):
                    split.append((values[lo] or b"").split())  # ASCII white space only
                    total += len(split[-1])
                    lo += 1
                found = search_texts(split, min_length)
                for i, words in enumerate(split):
                    if i not in found:
                        runs.append([])
                        collapsed.append(b" ".join(words))
                        continue
                    start, length, period = found[i]
                    by = np.lexsort((period, start))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in zip(start[by].tolist(), length[by].tolist(), period[by].tolist())])
                    collapsed.append(b" ".join([w for w, k in zip(words, _kept(len(words), found[i]).tolist()) if k]))
            made = [pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *FIELDS])

    return map_arrow(docs, search, extended(docs, **FIELDS))


def planted(doc_id: Column, text: Column) -> Column:
    """The query's texts: every tenth document, by the CRC of its id, repeats a block of its words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    white = f"[{SPACES}]+"

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        block = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), block), F.lit(1), n), " "))

    words = F.transform(F.array(F.array_remove(F.split(text, white), "")), repeated)
    return F.when((h % 10 == 0) & text.isNotNull(), F.coalesce(F.get(words, F.lit(0)), text)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    longest = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.when(x["length"] > y["length"], -1).otherwise(1))
                                 .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                                 .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
