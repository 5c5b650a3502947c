import re

import numpy as np
import pytest

from logweave.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent):
    """(set size, smallest reachable id) of each row, by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(len(s), (least.get(root(i)) if s else rows[i][0])) for i, s in enumerate(sets)]


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(int(rng.integers(0, edits + 1))):
            w[int(rng.integers(len(w)))] = f"e{rng.integers(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    vocab = [f"v{i}" for i in range(60)]
    words = lambda n: list(rng.choice(vocab, n))
    texts = [" ".join(words(int(rng.integers(1, 80)))) for _ in range(150)]
    for n, size, edits in ((60, 90, 3), (25, 150, 5), (10, 40, 2), (8, 30, 1)):
        texts += family(rng, words(size), n, edits)
    passage = " ".join(words(40))
    texts += [" ".join(words(30)) + "\n" + passage + "\t" + " ".join(words(30)) for _ in range(40)]
    texts += ["One two", "one TWO", "one  two three", "", "  ", None, texts[0], texts[0], texts[0].upper(), "same " * 4000, "same " * 3999]
    order = rng.permutation(len(texts))
    return [(int(i), texts[j]) for i, j in enumerate(order)]


@pytest.mark.parametrize("k,percent,group,cluster", [(4, 85, 1024, 256), (4, 85, 7, 8), (5, 80, 16, 12)])
def test_against_all_pairs(spark, rows, k, percent, group, cluster):
    extra = rows + [(None, "no id here at all"), (None, rows[3][1]), (rows[7][0], rows[7][1])]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in extra], "doc_id long, text string, n long, fp long").repartition(6)
    got = ngram_join.jaccard_components(docs, k=k, percent=percent, group_block=group, cluster_block=cluster).toPandas()
    assert len(got) == len(extra)
    want = brute(extra, k, percent)
    by = {}
    for (d, _), w in zip(extra, want):
        if d is not None:
            by[d] = w
    for r in got.dropna(subset=["doc_id"]).itertuples():
        assert (r.n_shingles, r.component_id) == by[r.doc_id]
    nulls = got[got.doc_id.isna()]
    assert len(nulls) == 2 and nulls.component_id.isna().sum() == 1


def test_keep_one(spark, rows):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows] + [(rows[2][0], rows[2][1], "x")], "doc_id long, text string, row string")
    kept = sorted(r.doc_id for r in ngram_join.keep_one(docs, k=4, percent=85).collect())
    want = brute(rows, 4, 85)
    assert kept == sorted(d for (d, t), (n, c) in zip(rows, want) if n == 0 or d == c)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_components(docs).count() == 0
    assert ngram_join.keep_one(docs).count() == 0


def test_sketch_never_overstates():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        x = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        y = np.unique(np.concatenate([x[int(rng.integers(0, n // 5 + 1)):], rng.integers(0, 2 ** 63, int(rng.integers(0, n // 5 + 2))).astype(np.uint64)]))
        x = np.unique(x)
        if not len(y):
            continue
        a, b = ngram_join.sketch(x), ngram_join.sketch(y)
        size = min(len(a), len(b))
        apart = int(np.bitwise_count(ngram_join.fold(a, size) ^ ngram_join.fold(b, size)).sum())
        assert apart <= len(np.setxor1d(x, y))


def test_trie_links_random_blocks():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sets = [np.unique(rng.integers(0, 30, int(rng.integers(1, 25)))).astype(np.uint64) for _ in range(int(rng.integers(2, 30)))]
        sets += [s[: max(1, len(s) - 1)] for s in sets[:5]]
        found = ngram_join.block_links(sets, np.ones(len(sets), bool), 80)

        def classes(pairs):
            parent = list(range(len(sets)))
            root = lambda i: i if parent[i] == i else root(parent[i])
            for a, b in pairs:
                parent[root(a)] = root(b)
            return {frozenset(j for j in range(len(sets)) if root(j) == root(i)) for i in range(len(sets))}

        true = [(i, j) for i in range(len(sets)) for j in range(i)
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
        assert classes(found) == classes(true)
