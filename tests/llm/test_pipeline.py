import re

import numpy as np

import corpus_pipeline
from logweave.llm.catalog import QUERIES


def test_stages(spark, tmp_path):
    rng = np.random.default_rng(9)
    vocab = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 8)))) for _ in range(500)]
    line = lambda n: " ".join(rng.choice(vocab, n))
    rows = [(i, "\n".join(line(int(rng.integers(8, 20))) for _ in range(int(rng.integers(2, 8)))), "en", f"s{i % 3}") for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "s0") for i in range(10)]                         # exact copies
    rows += [(220 + i, "one flat " + line(60).replace("\n", " "), "en", "s1") for i in range(3)]
    rows += [(230 + i, rows[-3 + i][1] + " end", "en", "s1") for i in range(3)]            # near copies
    shared = "\n".join(line(12) for _ in range(3))
    rows += [(240 + i, line(25) + "\n" + shared + "\n" + line(25), "en", "s2") for i in range(5)]
    rows += [(260, "too few words", "en", "s1"), (261, "again and again it is " * 30, "en", "s1"), (262, None, None, None)]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.toPandas()
        assert name == "packing" or docs.columns == columns
    assert list(seen) == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]
    ids = {n: set(d.doc_id) for n, d in seen.items()}
    assert not ids["quality_rules"] & {260, 261, 262} and len(ids["quality_rules"]) >= len(rows) - 6
    cleaned = seen["line_dedup"].set_index("doc_id").text
    assert shared in cleaned[240] and not any(shared in cleaned[240 + i] for i in range(1, 5))
    for i in range(10):  # a copy's lines are gone where they were in windows of three
        assert 200 + i not in cleaned.index or len(rows[i][1].split("\n")) < 3
    for i in range(3):
        assert len({220 + i, 230 + i} & ids["near_duplicates"]) == 1
    mixed = seen["mixing"].assign(w=lambda d: d.text.map(lambda t: len(re.findall(r"\S+", t)))).groupby("source").w.sum()
    assert mixed["s2"] > mixed["s1"] > mixed["s0"]
    assert ids["packing"] == ids["mixing"]


def test_run_and_names(spark):
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "start", "length", "sequence_id"} <= set(out.columns) and out.count() > 0
