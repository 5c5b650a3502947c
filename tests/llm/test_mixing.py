import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import mixing
from logweave.llm.common import word_count


def water(sizes, weights, cap):
    """Targets by resharing the excess until no source is above its limit."""
    total, fixed = float(sum(sizes.values())), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in fixed}
        left = total - sum(fixed.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()} if free else {}
        over = [s for s in share if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        source = ["a", "b", "c", "d", None, "tiny"][int(rng.choice(6, p=[.34, .2, .2, .2, .05, .01]))]
        rows.append((i, " ".join(["w"] * int(rng.integers(1, 200))), source))
    rows += [(2000, None, "a"), (2001, "", "b"), (2002, "  \n ", "c"), (None, "one two three", "a"), (5, rows[5][1], rows[5][2]), (2003, "x " * 5000, "d")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(-1)).withColumn("row", F.lit("extra"))


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\n", "é ü\x0bx\x0cy\rz", "a\xa0b", "x" * 100000]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", word_count(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in got} == dict(enumerate([0, 0, 0, 1, 2, 5, 1, 1]))


def test_targets_and_taken(docs):
    got = mixing.plan_mix(docs, block_words=2000, shard_words=20000).toPandas()
    assert len(got) == docs.count() and "size" in got and (got["size"] == -1).all() and (got["row"] == "extra").all()
    got["source"] = got.source.fillna("~null")
    sizes = got.groupby("source").mix_size.sum().to_dict()
    order = sorted(s for s in sizes if s != "~null") + ["~null"]
    want = water(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, 3.0)
    got["taken"] = got.mix_size * got.mix_draws.map(len)
    for s, g in got.groupby("source"):
        assert g.mix_target.iloc[0] == pytest.approx(want[s])
        assert abs(g.taken.sum() - want[s]) <= max(10, 0.01 * want[s])
    assert (got.taken <= 3 * got.mix_size).all()
    for d in got.mix_draws:
        assert len({x["epoch"] for x in d}) == len(d)


def test_reruns_agree_and_shards_share(docs):
    one = mixing.mix(docs, block_words=500, shard_words=10000)
    two = mixing.mix(docs.repartition(7), block_words=500, shard_words=10000)
    key = ["doc_id", "mix_shard", "mix_epoch", "mix_order"]
    a, b = (sorted(map(str, d.select(*key).collect())) for d in (one, two))
    assert a == b
    words = one.groupBy("mix_shard").agg(F.sum(word_count(F.col("text"))).alias("w")).toPandas()
    total = docs.select(F.sum(word_count(F.col("text")))).first()[0]
    assert len(words) == -(-total // 10000)
    assert words.w.max() < 2 * words.w.mean()


def test_empty_table(docs):
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("marked,total,drawn", [(30, 100, 20), (5, 9, 4), (0, 7, 3), (7, 7, 3), (3, 7, 7), (400, 100000, 50000), (1, 1, 0)])
def test_hypergeometric(spark, marked, total, drawn):
    c = lambda v: F.lit(v).cast("long")
    u = mixing.uniform(F.lit(1), F.col("id"))
    got = spark.range(4000).select(mixing.hypergeometric(c(marked), c(total), c(drawn), u).alias("x")).toPandas().x.to_numpy()
    mean = drawn * marked / total
    var = mean * (1 - marked / total) * (total - drawn) / max(total - 1, 1)
    assert got.min() >= max(0, drawn - (total - marked)) and got.max() <= min(drawn, marked)
    assert got.mean() == pytest.approx(mean, abs=5 * (var / 4000) ** 0.5 + 1e-9)
    assert got.var() == pytest.approx(var, rel=0.15, abs=1e-9)


def test_tree_keeps_quotas(spark):
    q = spark.createDataFrame([([17, 0, 301, 5],)], "quotas array<long>")
    leaves = mixing.split_tree(q, 13).collect()
    assert sorted(r.shard for r in leaves) == list(range(13))
    assert np.sum([r.quotas for r in leaves], axis=0).tolist() == [17, 0, 301, 5]
    assert max(sum(r.quotas) for r in leaves) - min(sum(r.quotas) for r in leaves) <= 2
