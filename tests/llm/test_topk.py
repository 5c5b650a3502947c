import numpy as np
import pytest

from logweave.llm import topk


def brute(vectors, queries, k):
    out = set()
    ready = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    whole = lambda v: [int(np.floor(64 * float(x))) for x in v]
    for qid, q in queries:
        if qid is None or not ready(q):
            continue
        q = whole(q)
        scored = sorted((-sum(a * b for a, b in zip(q, whole(v))), vid) for vid, v in vectors if vid is not None and vid != qid and ready(v))
        out |= {(qid, r + 1, vid, -s) for r, (s, vid) in enumerate(scored[:k])}
    return out


def test_against_all_scores(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 12)]) for i in range(700)]
    vectors += [(1000 + i, vectors[5][1]) for i in range(60)]  # ties
    vectors += [(2000, None), (2020, [0.1, None] * 6), (2040, [float("nan")] * 12), (2060, [float("inf")] + [0.0] * 11), (None, vectors[1][1]),
                (2080, [1.5, -2.25]), (2100, []), (2120, [1.0] * 20)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, score int")
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 200)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    got = {tuple(r) for r in topk.top_k(df, df.filter("vec_id % 20 = 0"), 20).collect()}
    assert got == brute(vectors, [v for v in vectors if v[0] is not None and v[0] % 20 == 0], 20)


def test_repeated_ids_few_rows_and_empty(spark):
    rows = [(1, [1.0]), (1, [2.0]), (3, [0.5]), (3, [0.5]), (20, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, df.filter("vec_id = 20"), 20).orderBy("rank").collect()]
    assert got == [(20, 1, 1, 8192), (20, 2, 1, 4096), (20, 3, 3, 2048), (20, 4, 3, 2048)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("scale,kind", [(1.0, "small"), (3e5, "double"), (2e7, "long")])
def test_rounds_change_nothing(scale, kind):
    rng = np.random.default_rng(8)
    x, q = np.floor(rng.normal(0, scale, (400, 6))), np.floor(rng.normal(0, scale, (9, 6)))
    ids = rng.permutation(400)
    plain = topk.block_top(ids[:9], q, ids, x, 15, rounds=())
    nra = topk.block_top(ids[:9], q, ids, x, 15, rounds=(0.05, 0.3, 0.6))
    as_set = lambda t: set(zip(*map(lambda a: a.tolist(), t)))
    assert as_set(plain) == as_set(nra) and len(plain[0]) == 9 * 15


def test_large_components_in_a_full_block():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(0, 20, (topk.VECTOR_BLOCK, 64)))
    x[77] = np.floor(64 * 1e5)  # one outlier
    x[5000:5040] = x[77]        # and its copies: ties
    ids = rng.permutation(len(x))
    at = np.array([77, 3, 900])
    r, c, score = topk.block_top(ids[at], x[at], ids, x, 20)
    whole = x[at].astype(np.int64) @ x.astype(np.int64).T
    for i in range(3):
        want = sorted((-int(whole[i, j]), int(ids[j])) for j in range(len(x)) if j != at[i])[:20]
        assert sorted(zip((-score[r == i]).tolist(), ids[c[r == i]].tolist())) == want


def test_scores_up_to_a_long():
    x = np.array([[3e9], [2e9], [-3e9], [3e9]])
    r, c, score = topk.block_top(np.array([0]), x[:1], np.arange(4), x, 2)
    assert list(zip(c.tolist(), score.tolist())) == [(3, 9 * 10 ** 18), (1, 6 * 10 ** 18)]
    with pytest.raises(OverflowError):
        topk.block_top(np.array([0]), 2 * x[:1], np.arange(4), x, 2)
