import numpy as np

from logweave.llm import texts, toxicity
import pyarrow as pa
from pyspark.sql import functions as F

BAD = ["scum", "moron", "idiot", "trash"]


def corpus(spark, n=1200, seed=5):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = list(rng.choice(vocab, int(rng.integers(8, 120))))
        if toxic:
            for _ in range(max(1, len(words) // 20)):
                words.insert(int(rng.integers(len(words))), str(rng.choice(BAD)).upper() if rng.random() < 0.2 else str(rng.choice(BAD)) + "!")
        rows.append((i, " ".join(words), "x"))
        if rng.random() < 0.7:
            labels.append((i, toxic))
    truth = {i: t for i, t in labels}
    return rows, labels, truth


def test_held_out(spark):
    rows, labels, _ = corpus(spark)
    held = {i for i, _ in labels if i % 5 == 0}
    rows += [(None, "scum", "x"), (5001, None, "x"), (5002, "", "x"), (5003, rows[3][1], "x"), (3, rows[3][1], "x"), (5004, "w1 " * 60000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(5)
    lab = spark.createDataFrame([x for x in labels if x[0] not in held] + [(None, 1), (7, None), (99999, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, lab)
    assert got.columns == ["doc_id", "text", "toxic_ll", "ordinary_ll", "score", "predicted"]
    got = got.toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    by = got.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id").predicted
    toxic = [i for i, t in labels if t and i in held]
    clean = [i for i, t in labels if not t and i in held]
    assert by[toxic].mean() > 0.9 and by[clean].mean() < 0.05
    empty = got[got.doc_id.isin([5001, 5002])].score
    assert empty.nunique() == 1 and (empty < 0.5).all()
    assert got[got.doc_id == 3].score.nunique() == 1


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, none).filter("score between 0 and 1").count() == 2
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, one).count() == 2
    assert toxicity.toxicity(docs.limit(0), one).count() == 0


def test_distinct_pairs():
    data, off = texts.raw(pa.array(["a b a b a b", "", "B a"]))
    prev, word, doc = toxicity.tokens(data, off)
    assert np.bincount(doc, minlength=3).tolist() == [3, 0, 2]  # start-a, a-b, b-a; start-b, b-a
    assert len(set(word.tolist())) == 2


def test_curve_has_the_prior_of_all_labels(spark, monkeypatch):
    rows, labels, _ = corpus(spark)
    share, seen = np.mean([t for _, t in labels]), []

    def fit(d, y, weight=None, real=toxicity.fit_curve):
        seen.append((len(y), np.average(y, weights=weight)))
        return real(d, y) if weight is None else real(d, y, weight)

    monkeypatch.setattr(toxicity, "fit_curve", fit)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    for most in (5000, 25):
        monkeypatch.setattr(toxicity, "MAX_CURVE_DOCS", most)
        toxicity.toxicity(docs, lab)
    assert seen[0][0] > seen[1][0] == 50
    assert np.allclose([s for _, s in seen], share)


def test_every_labelled_row_counts(spark, monkeypatch):
    rows, labels, truth = corpus(spark)
    curve = {r[0] for r in spark.createDataFrame(labels, "doc_id long, toxic int").filter("pmod(xxhash64(doc_id), 5) = 0").collect()}
    fitted, points = [], []

    def models(docs, *names, real=toxicity.fit_models):
        fitted.extend(r[0] for r in docs.select("doc_id").collect())
        return real(docs, *names)

    def made(seen, real=toxicity.curve_points):
        out = real(seen)
        points.append((seen.count(), out.toPandas(), seen.toPandas()))
        return out

    monkeypatch.setattr(toxicity, "fit_models", models)
    monkeypatch.setattr(toxicity, "curve_points", made)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(5)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    for most in (5000, 10):
        monkeypatch.setattr(toxicity, "MAX_CURVE_DOCS", most)
        del fitted[:]
        toxicity.toxicity(docs, lab)
        assert sorted(fitted) == sorted(set(truth) - curve)  # far more ordinary texts than toxic ones, all of them
    for n, got, seen in points:
        assert got["rows"].sum() == n == len(curve)
        clipped = seen.d.clip(-toxicity.CLIP, toxicity.CLIP)
        assert np.allclose((got.d * got.rows).groupby(got.toxic).sum(), clipped.groupby(seen.toxic).sum())
    assert len(points[0][1]) == len(curve) and len(points[1][1]) == 20


def test_counts_of_words_and_pairs(spark):
    docs = spark.createDataFrame([("a b a b", 1), ("A b", 0), ("b a", 0), (None, 1), ("", 0)], "text string, toxic int").repartition(3)
    h = lambda w: texts.hash_spans(*[x for x in (np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))])
    a, b = h("a"), h("b")
    words = {r["key"]: tuple(r)[1:] for r in toxicity.count_words(docs, "text", "toxic").collect()}
    key = lambda x: int(np.asarray(x, np.uint64).view(np.int64).ravel()[0])
    assert words[key(a)] == (2, 2, 1, 2, 1, 1) and words[key(b)] == (1, 2, 1, 2, 1, 1)
    pairs = {r["key"]: (r["t"], r["o"]) for r in toxicity.count_pairs(docs, "text", "toxic").collect()}
    ab, ba = toxicity.pair_key(a, b), toxicity.pair_key(b, a)
    assert len(pairs) == 4 and pairs[key(ab)] == (1, 1) and pairs[key(ba)] == (1, 1)
    found = toxicity.words_of_pairs(docs, "text", np.sort(np.concatenate([ab, ba]))).collect()
    assert {tuple(r) for r in found} == {(key(ab), key(a), key(b)), (key(ba), key(b), key(a))}


def key_of(word):
    return texts.hash_spans(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word)]))


def test_predecessors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(" ".join(rng.choice(list("abcdef"), int(rng.integers(0, 5)))), int(rng.random() < 0.4)) for _ in range(60)] + [(None, 1), ("", 0)]
    want = {}
    for text, y in rows:
        words = (text or "").split()
        for before, word in zip(["", *words], words):
            want.setdefault(word, (set(), set()))[1 - y].add(before)
    pairs = toxicity.count_pairs(spark.createDataFrame(rows, "text string, toxic int").repartition(4), "text", "toxic")
    got = toxicity.by_word(pairs, F.lit(False)).collect()
    assert {r["word"]: (r["k_t"], r["k_o"]) for r in got} == {int(key_of(w).view(np.int64)[0]): tuple(map(len, k)) for w, k in want.items()}
    assert all(r["pairs"] == [] for r in got)


def test_words_count_by_what_they_follow(spark):
    """Two words in as many toxic texts as often, one always after the same word: by itself it is the less likely one."""
    rows = [(f"w{i} v{i} moron u{i} san francisco", 1) for i in range(40)] + [(f"w{i} v{i} u{i} x{i} y{i} san", 0) for i in range(40)]
    model = toxicity.fit_models(spark.createDataFrame(rows, "text string, toxic int").repartition(3), "text", "toxic")
    key, l_t = model["words"][0].tolist(), model["words"][1]
    of = {w: float(l_t[key.index(int(key_of(w)[0]))]) for w in ("moron", "francisco")}
    # 40 and 1 of the class's 160 + 40 + 1 pairs; what the discounts free is shared out over both words
    assert of["moron"] - of["francisco"] > 2.5


def test_pairs_of_words_that_do_not_tell(spark):
    rows = [(f"w{i} v{i} silly goat u{i}", 1) for i in range(24)] + [(f"a{i} w{i} silly v{i} b{i} u{i} goat c{i}", 0) for i in range(24)]
    model = toxicity.fit_models(spark.createDataFrame(rows, "text string, toxic int").repartition(3), "text", "toxic")
    assert key_of("goat")[0] not in model["words"][0]  # as many texts of either class have it
    at = np.flatnonzero(model["pairs"][0] == toxicity.pair_key(key_of("silly"), key_of("goat"))[0])
    assert len(at) == 1 and model["pairs"][1][at[0]] > model["pairs"][2][at[0]] + 1
