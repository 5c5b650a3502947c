import re

import numpy as np
import pyarrow as pa

from logweave.llm import perplexity, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i: i + 5]), []).append(i)
    covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(5)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


EDGE = [None, "", " ", "\n\n", "a", "a b c d e a b c d e", "x\nx\nx", " x\nx", "é ü\n€ 漢字 <|>", "one two three four five six seven eight nine ten",
        "a\x0bb\x0cc\rd", "w " * 3000, "\nlast", "# * $ % & | < >"]


def random_texts(n, seed=0):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("aab é\n\t#"), int(rng.integers(0, 120)))) for _ in range(n)]


def test_base_metrics():
    strings = EDGE + random_texts(400)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {f: [] for f in names}
    for _, _, data, off in texts.chunks(pa.array(strings)):
        for f, v in perplexity.base_metrics(data, off).items():
            got[f] += v.tolist()
    assert [list(r) for r in zip(*[got[f] for f in names])] == [plain(t) for t in strings]


def test_chunks_cover_all(monkeypatch):
    monkeypatch.setattr(texts, "CHUNK_BYTES", 50)
    strings = EDGE + random_texts(50)
    parts = [(lo, hi, bytes(data)) for lo, hi, data, _ in texts.chunks(pa.array(strings).slice(3))]
    assert [p[0] for p in parts] == [0] + [p[1] for p in parts[:-1]] and parts[-1][1] == len(strings) - 3
    assert b"".join(p[2] for p in parts) == "".join(t or "" for t in strings[3:]).encode()


def corpus(spark, n=300):
    rng = np.random.default_rng(1)
    vocab = ["".join(rng.choice(list("abcdeé"), int(rng.integers(2, 7)))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(vocab, int(rng.integers(12, 90)))), ["en", "fr", None][i % 3]) for i in range(n)]
    rows += [(1000, "".join(chr(int(c)) for c in rng.integers(0x4E00, 0x9FFF, 400)).replace("\u5000", " ") + " " + " ".join(f"Q{i}Z" for i in range(100, 160)), "en")]
    rows += [(1001, None, "en"), (1002, "", None), (None, rows[5][1], "en"), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame([(*r, "x", 7, "m") for r in rows], "doc_id long, text string, lang string, kept string, N_words int, mid string").repartition(4), rows


def test_model_sums_to_one(spark):
    docs, _ = corpus(spark)
    for limit in (10 ** 6, 700):
        model = perplexity.estimate(perplexity.count_grams(docs, "text", "lang"), max_entries=limit).toPandas()
        assert len(model[(model.ord == 5) & ~model.context]) <= limit
        for lang in ("en", ""):
            m = model[model.lang == lang]
            value = {(o, c, k): v for o, c, k, v in zip(m.ord, m.context, m.key, m.value)}

            def prob(o, key):
                if o == 0:
                    return 1 / 257
                if (o, False, key) in value:
                    return np.exp(value[o, False, key])
                return np.exp(value.get((o, True, key // 257), 0.0)) * prob(o - 1, key % 257 ** (o - 1))

            for ctx in list(m[(m.ord == 5) & m.context].key)[:5]:
                assert abs(sum(prob(5, int(ctx) * 257 + c) for c in range(257)) - 1) < 1e-6


def test_quality_rules(spark):
    docs, rows = corpus(spark)
    got = perplexity.quality_rules(docs)
    assert got.columns[:4] == ["doc_id", "text", "lang", "mid"] and len(set(map(str.lower, got.columns))) == len(got.columns)
    got = got.toPandas()
    assert len(got) == len(rows)
    for r in got.itertuples():
        want = plain(r.text)
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    good = got[got.doc_id < 300]
    assert good[~good.base_failed].kept.mean() > 0.99
    assert not got[got.doc_id == 1000].kept.any() and not got[got.doc_id == 1000].base_failed.any()
    assert got[got.doc_id == 5].perplexity.nunique() == 1


def test_empty_table(spark):
    assert perplexity.quality_rules(corpus(spark, 9)[0].limit(0)).count() == 0


def test_copies_move_no_band(spark):
    docs, rows = corpus(spark)
    many = spark.createDataFrame([(5000 + i, rows[1][1], "fr", "x", 7, "m") for i in range(900)], docs.schema)
    own = perplexity.quality_rules(docs).select("doc_id", "lang", "nll", "kept", "base_failed").toPandas()
    got = perplexity.quality_rules(docs.unionByName(many).repartition(7)).select("doc_id", "lang", "nll", "kept", "base_failed").toPandas()
    assert len(got) == len(own) + 900 and got[got.doc_id >= 5000].kept.all()
    clean = got[(got.lang == "fr") & (got.doc_id < 300) & ~got.base_failed]
    assert clean.kept.mean() > 0.99
    by = lambda d: d[d.doc_id.between(6, 1000)].set_index("doc_id").nll.sort_index().to_numpy()
    assert np.allclose(by(own), by(got), rtol=1e-9)


def test_large_model_is_joined_with_equal_scores(spark):
    docs, rows = corpus(spark, 90)
    sent = perplexity.quality_rules(docs).toPandas().astype({"doc_id": float})
    joined = perplexity.quality_rules(docs, most=0)
    assert joined.columns == list(sent.columns)
    joined = joined.toPandas().astype({"doc_id": float})
    assert len(joined) == len(rows)
    by = lambda d: d.fillna({"doc_id": -1, "lang": "", "text": ""}).sort_values(["doc_id", "lang", "text"])
    sent, joined = by(sent), by(joined)
    assert np.array_equal(sent.nll, joined.nll, equal_nan=True) and sent.nll.isna().sum() == 2
    for c in ("kept", "base_failed", "n_words", "n_bytes"):
        assert sent[c].tolist() == joined[c].tolist()
