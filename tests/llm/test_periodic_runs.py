import hashlib
import zlib

import numpy as np
import pytest

from logweave.llm import periodic_runs
from logweave.llm.periodic_runs import find_runs, op12_periodic_runs


def brute(words, least=12):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def fast(words, least=12):
    start, length, period = find_runs(np.array(words, np.int64), least)
    return sorted(zip(start.tolist(), length.tolist(), period.tolist()))


def nested(rng):
    """Blocks repeated inside repeated blocks, with words changed here and there."""
    w = rng.integers(0, 3, int(rng.integers(1, 6))).tolist()
    for _ in range(int(rng.integers(1, 5))):
        w = w * int(rng.integers(1, 6)) + rng.integers(0, 3, int(rng.integers(0, 3))).tolist()
        w = (w * int(rng.integers(1, 4)))[: int(rng.integers(5, 400))]
    for _ in range(int(rng.integers(0, 3))):
        w[int(rng.integers(0, len(w)))] = int(rng.integers(0, 4))
    return w


@pytest.mark.parametrize("seed", range(4))
def test_all_runs(seed):
    rng = np.random.default_rng(seed)
    for k in range(400):
        w = nested(rng) if k % 2 else rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(0, 120))).tolist()
        for least in (12, 2, 5, 13):
            assert fast(w, least) == brute(w, least), (w, least)


def test_touching_and_apart():
    for w in ([0, 1] * 40 + [0] + [0, 1] * 40, [0] * 70 + [1] + [0] * 70 + [1] + [0] * 60, ([0] * 30 + [1]) * 6 + [0] * 9, [0, 1, 0, 0, 1] * 33,
              ([0, 1, 2] * 16 + [3]) * 5 + [0, 1, 2] * 30):
        assert fast(w) == brute(w)


def test_long_texts_of_few_words():
    n = 1 << 19
    assert fast([0] * n) == [(0, n, 1)]
    half = [0] * (n // 2)
    assert fast(half + [1] + half)[-1] == (n // 2 + 1, n // 2, 1) and (0, n + 1, n // 2 + 1) not in brute([0, 1])
    assert (0, n + 2, n // 2 + 1) in fast((half + [1]) * 2)


def test_whole_texts(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " \n".join(f"w{x}" for x in nested(rng))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "a " * 30000), (None, "é ü " * 20), (404, "x\x1cy " * 14), (404, "x\x1cy " * 14)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, RUNS string, length int").repartition(3)
    out = periodic_runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "length", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        words = (r.text or "").encode().split()
        want = brute(words) if len(words) < 1000 else [(0, 30000, 1)]
        assert [tuple(x) for x in r.runs] == sorted(want, key=lambda x: (x[0], x[2]))
        gone = {i for s, length, q in want for i in range(s + q, s + length)}
        assert r.collapsed == b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def plant(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(str(x) for x in rng.integers(0, 40 if i % 3 else 2, int(rng.integers(0, 200))))) for i in range(400)] + [(1000, None), (1001, " "), (None, "a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    planted = 0
    for d, text in rows:
        words = plant(d, text) if d is not None else text.encode().split()
        runs = sorted(brute(words), key=lambda x: (x[0], x[2]))
        planted += d is not None and zlib.crc32(str(d).encode()) % 10 == 0 and bool(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        r = got[d]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    assert planted > 20
