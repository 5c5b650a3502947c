import re
import zlib
from collections import Counter

import numpy as np
import pytest

from logweave.llm import spelling


def one_edit(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows, spoiled=None, least=6):
    n = Counter()
    for d, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{d}:{w}".encode())
            if spoiled and d is not None and h % spoiled == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= least}


def forms(n, min_count=5, ratio=5):
    words = {w: k for w, k in n.items() if k >= min_count}
    out = {}
    for w, k in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = [best if best and words[best] >= ratio * k else None, k, len(near)]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return {w: (f, root, k, near, words[f] if f else None) for w, (f, k, near, root) in out.items()}


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_counts(spark):
    rng = np.random.default_rng(1)
    letters = list("aAbBzZéÉ×ÿ¿Ā -1'") + ["€", "\U0001F600"]
    rows = [(int(d) if d % 7 else None, "".join(rng.choice(letters, int(rng.integers(0, 400))))) for d in range(300)]
    rows += [(900, None), (901, ""), (902, "x" * 300), (903, "LONG" * 50000), (902, "x" * 300)]
    docs = spark.createDataFrame([(*r, "w", 3) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    for spoiled in (None, 3, 199):
        got = {r.word: r.n for r in spelling.word_counts(docs, spoiled=spoiled, min_chars=4).collect()}
        assert got == counted(rows, spoiled, 4)


def test_buffer(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BUFFER_WORDS", 3)
    rows = [(i, " ".join(f"wordnumber{chr(97 + (i * j) % 26)}" for j in range(40))) for i in range(50)]
    got = {r.word: r.n for r in spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string"), spoiled=5).collect()}
    assert got == counted(rows, 5)


@pytest.mark.parametrize("seed", range(3))
def test_near_words(spark, seed):
    rng = np.random.default_rng(seed)
    words = set()
    while len(words) < 700:
        w = "".join(rng.choice(list("abé"), int(rng.integers(6, 10))))
        words |= {w, w[1:] + "a", w[:-1]} if rng.random() < 0.3 else {w}
    n = {w: int(5 * 3 ** rng.integers(0, 7) + rng.integers(0, 2)) for w in words if len(w) >= 6}
    table = spark.createDataFrame([(w, k, "x") for w, k in n.items()], "word string, n long, near string").repartition(5)
    pairs = [(r.a, r.b) for r in spelling.near_pairs(table.select("word", "n")).collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert result(spelling.spelling_forms(table)) == forms(n)


def test_cases(spark):
    rows = [("aaaaaa", 30), ("aaaaaaa", 6), ("aaaaaa", 1), (None, 9), ("bbbbbb", None), ("cccccc", 4), ("dddddd", 5), ("ddddddd", 25), ("eddddddd", 125),
            ("x" * 5000, 5), ("x" * 4999 + "y", 500), ("ffffff", 5), ("fffffa", 25), ("fffffb", 25)]
    got = result(spelling.spelling_forms(spark.createDataFrame(rows, "word string, n long")))
    assert got["aaaaaa"] == (None, "aaaaaa", 31, 1, None) and got["aaaaaaa"] == ("aaaaaa", "aaaaaa", 6, 1, 31)
    assert got["dddddd"] == ("ddddddd", "eddddddd", 5, 1, 25) and got["ddddddd"][:2] == ("eddddddd", "eddddddd")
    assert got["x" * 5000][0] == "x" * 4999 + "y" and got["ffffff"][0] == "fffffa"
    assert set(got) == {w for w, n in rows if w and n and (w == "aaaaaa" or n >= 5)}
    assert result(spelling.spelling_forms(spark.createDataFrame([], "word string, n long"))) == {}


def test_query(spark, tmp_path):
    rng = np.random.default_rng(4)
    stems = ["".join(rng.choice(list("abcdeè"), int(rng.integers(6, 11)))) for _ in range(60)]
    rows = [(d, ". ".join(s.capitalize() if rng.random() < 0.2 else s for s in rng.choice(stems, 300, p=np.arange(1, 61) / 1830))) for d in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = result(spelling.op13_spelling_forms(spark, str(tmp_path)))
    want = forms(counted(rows, 199))
    assert got == want and any(v[0] for v in want.values())
