"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: sources share the words of the whole table by weight; none gets more than ``cap`` times its
   own words, and what is cut off goes to the others by weight (one water level over all sources).
2. Blocks: a document falls into one of its source's blocks by a hash, so blocks are random samples of
   about ``block_words`` words and no source is ever sorted or gathered.  Blocks are put in an order by
   an affine permutation.  A source is drawn in rounds: as many whole rounds as its target needs, and
   then the first blocks of the order, up to its target.
3. Quotas: these draws are exact block counts.  A binary tree over the output shards splits them: each
   node gives its left half a multivariate-hypergeometric draw of its quotas, source by source, so
   every shard is a random share of the whole and all quotas add up exactly.  Each leaf's quota is a
   run of the source's draws; runs do not overlap.
4. The block at the target is filled by documents in falling size, so the taken words end within a few
   words of the target.  Documents are taken whole, once for each draw.
5. Inside a shard, rows are shuffled by a hash.

All of it is DataFrame operations; a rerun gives the same mix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweave.llm.common import attach, cut, table, without, word_count

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 24
SEED = 17
#: A prime above any number of blocks of a source; multiplying by it permutes the blocks.
PRIME = 2147483647
#: Prefix sums go over runs of this many blocks first, then over the runs.
RUN = 1024
FILL_PASSES = 3
#: Levels of the tree in one plan.
LEVELS = 2
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_draws")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).  One row per source passes through
    one window; the number of sources does not follow the number of documents."""
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("weight", F.element_at(pattern, (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("most", F.lit(cap) * F.col("source_size"))
    by_level = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    above = by_level.rowsBetween(W.unboundedPreceding, -1)
    rest = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(above), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("level", level)
    free = F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level"))
    s = s.withColumn("water", F.first(free, ignorenulls=True).over(by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return s.withColumn("target", F.least(F.col("most"), F.coalesce(F.col("water") * F.col("weight"), F.col("most")))).drop("most", "level", "water")


def uniform(*parts) -> Column:
    """A number in [0, 1) from a hash of ``parts``."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def let(body, **values: Column) -> Column:
    """``body`` of a struct of named values: each is written (and computed) once, however often used."""
    bound = F.array(F.struct(*[c.alias(name) for name, c in values.items()]))
    return F.element_at(F.transform(bound, body), 1)


def hypergeometric(marked: Column, total: Column, drawn: Column, u: Column) -> Column:
    """The number of ``marked`` items among ``drawn`` of ``total``, by inversion of ``u``.

    Probabilities follow from the most likely count by their ratios; counts further than 12 standard
    deviations from it have less probability than a double can add."""
    none = F.array().cast("array<bigint>")

    def likely(v):  # the most likely count and the deviation
        share = F.try_divide(v.k, v.n)
        variance = v.d * share * (1 - share) * F.try_divide(v.n - v.d, v.n - 1)
        mode = F.floor((v.d + 1) * (v.k + 1) / (v.n + 2)).cast("long")
        return let(lambda m: ranges(v, m), mode=F.greatest(v.low, F.least(v.high, mode)),
                   reach=F.ceil(12 * F.sqrt(F.greatest(F.coalesce(variance, F.lit(0.0)), F.lit(0.0))) + 2).cast("long"))

    def ranges(v, m):  # the counts above and below it
        first, last = F.greatest(v.low, m.mode - m.reach), F.least(v.high, m.mode + m.reach)
        return let(lambda r: sums(v, m, r),
                   up=F.when(last > m.mode, F.sequence(m.mode + 1, last)).otherwise(none),
                   down=F.when(first < m.mode, F.sequence(m.mode - 1, first, F.lit(-1).cast("long"))).otherwise(none))

    def sums(v, m, r):  # their probabilities over that of the most likely count
        grow = lambda w, i: w * (v.k - i + 1) * (v.d - i + 1) / (i * (v.n - v.k - v.d + i))
        fall = lambda w, i: w * (i + 1) * (v.n - v.k - v.d + i + 1) / ((v.k - i) * (v.d - i))
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))

        def add(step):
            return lambda a, i: let(lambda x: F.struct(x.w.alias("w"), (a.s + x.w).alias("s")), w=step(a.w, i))

        return let(lambda t: let(lambda g: invert(m, r, t, g, grow, fall), goal=v.u * (t.above + t.below + 1)),
                   above=F.aggregate(r.up, start, add(grow)).s, below=F.aggregate(r.down, start, add(fall)).s)

    def invert(m, r, t, g, grow, fall):  # the most likely count first, then upwards, then downwards
        def find(step, goal):
            start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), F.lit(-1).cast("long").alias("at"))

            def walk(a, i):
                return let(lambda x: F.struct(x.w.alias("w"), (a.s + x.w).alias("s"),
                                              F.when((a["at"] < 0) & (a.s + x.w > goal), i).otherwise(a["at"]).alias("at")), w=step(a.w, i))
            return lambda counts: F.aggregate(counts, start, walk)["at"]

        return let(lambda f: F.when(g.goal < 1, m.mode).when((g.goal - 1 < t.above) & (f["higher"] >= 0), f["higher"])
                   .when(f["lower"] >= 0, f["lower"]).otherwise(m.mode),
                   higher=find(grow, g.goal - 1)(r.up), lower=find(fall, g.goal - 1 - t.above)(r.down))

    return let(likely, k=marked.cast("double"), n=total.cast("double"), d=drawn.cast("double"), u=u,
               low=F.greatest(F.lit(0).cast("long"), drawn - (total - marked)), high=F.least(drawn, marked))


def split_tree(quotas: DataFrame, n_shards: int, seed: int = SEED) -> DataFrame:
    """(shard, quotas) from one row with the array ``quotas`` (draws of each source)."""
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), F.col("quotas"))
    width, depth = n_shards, 0
    while width > 1:
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q)
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        share = F.floor(total * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")
        nodes = nodes.select("lo", "hi", "quotas", total.alias("total"), mid.alias("mid"), share.alias("share"))
        begin = F.struct(F.col("total").alias("rest"), F.col("share").alias("draws"), F.array().cast("array<bigint>").alias("got"))

        def take(a, q):
            got = hypergeometric(q, a["rest"], a["draws"], uniform(F.lit(seed), F.col("lo"), F.col("hi"), F.size(a["got"])))
            return F.struct((a["rest"] - q).alias("rest"), (a["draws"] - got).alias("draws"), F.array_append(a["got"], got).alias("got"))

        left = F.aggregate("quotas", begin, take, lambda a: a["got"])
        nodes = nodes.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, left).otherwise(F.col("quotas")))
        halves = F.when(F.col("hi") - F.col("lo") > 1, F.array(
            F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("quotas")),
            F.struct(F.col("mid").alias("lo"), F.col("hi"), F.zip_with("quotas", "left", lambda a, b: a - b).alias("quotas"))))
        same = F.array(F.struct(F.col("lo"), F.col("hi"), F.col("quotas")))
        nodes = nodes.select(F.explode(F.coalesce(halves, same)).alias("n")).select("n.*")
        width, depth = (width + 1) // 2, depth + 1
        if depth % LEVELS == 0:  # a plan of a few levels at a time
            nodes = cut(nodes)
    return nodes.select(F.col("lo").alias("shard"), "quotas")


def running(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Adds ``before`` (sum of ``value`` of earlier rows) and ``rank`` (number of earlier rows) within
    ``key`` by ``order`` (a distinct number from 0): over runs of ``RUN`` numbers, then over runs."""
    rows = rows.withColumn("run", F.floor(F.col(order) / RUN))
    w = W.partitionBy(*key, "run").orderBy(order)
    earlier = w.rowsBetween(W.unboundedPreceding, -1)
    rows = cut(rows.withColumn("in_run", F.coalesce(F.sum(value).over(earlier), F.lit(0).cast("long")))
               .withColumn("nth", F.row_number().over(w) - 1))
    runs = rows.groupBy(*key, "run").agg(F.sum(value).alias("v"), F.count("*").alias("c"))
    earlier = W.partitionBy(*key).orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = cut(runs.select(*key, "run", *[F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("long")).alias(n) for c, n in (("v", "base"), ("c", "base_n"))]))
    return (attach(rows, runs, [*key, "run"], F.xxhash64(order))
            .withColumn("before", F.col("in_run") + F.col("base")).withColumn("rank", F.col("nth") + F.col("base_n"))
            .drop("run", "in_run", "nth", "base", "base_n"))


def fill(rows: DataFrame) -> DataFrame:
    """The documents taken from each source's last block: in falling size while they fit into ``gap``,
    then smaller ones into what is left, at last one more if that ends nearer."""
    block = W.partitionBy("source", "block")
    rows = rows.withColumn("took", F.lit(False))
    for _ in range(FILL_PASSES):
        rows = rows.withColumn("left", F.col("gap") - F.sum(F.when(F.col("took"), F.col("size")).otherwise(0)).over(block))
        fits = ~F.col("took") & (F.col("size") <= F.col("left")) & (F.col("size") > 0)
        rows = rows.withColumn("fits", fits)
        order = block.orderBy(F.desc("fits"), F.desc("size"), "h")
        upto = F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0))
        rows = rows.withColumn("took", F.col("took") | (F.col("fits") & (upto <= F.col("left"))))
    rows = rows.withColumn("left", F.col("gap") - F.sum(F.when(F.col("took"), F.col("size")).otherwise(0)).over(block))
    next_one = F.row_number().over(block.orderBy("took", F.col("size") == 0, "size", "h")) == 1
    closer = ~F.col("took") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("left"))
    return rows.withColumn("took", F.col("took") | (next_one & closer))


def plan_mix(docs: DataFrame, source: str = "source", size: Column | None = None, key: tuple[str, ...] = ("doc_id",),
             text: str = "text", weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, block_words: int = BLOCK_WORDS,
             shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """All rows of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_draws``: the
    draws that take the row, each (epoch, shard).  Columns of these names give way.

    A null source is a source of its own, last in the order of weights.  A null or empty text has size 0
    and is drawn with its block, adding nothing.  Rows are told apart by ``key`` and size; rows
    that agree in both share a block and are taken in any order.  An empty table stays empty."""
    docs = without(docs, *ADDED)
    size = word_count(F.col(text)) if size is None else size
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).cast("string").alias("source"),
                        size.cast("long").alias("size"), F.xxhash64(F.lit(seed), *key).alias("h0"))
    keyed = keyed.withColumn("h", F.xxhash64("h0", "size")).drop("h0")
    sizes = cut(keyed.select("source", "size", "h"))

    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sources, weights, cap)
    sources = sources.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    epochs = F.floor(F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)) + 1e-9).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    sources = cut(sources)
    n_sources = sources.count()
    block = F.pmod(F.col("h"), F.col("n_blocks"))

    blocks = attach(sizes, sources, ["source"], F.col("h"), rows=n_sources).groupBy("source", block.alias("block")).agg(F.sum("size").alias("words"))
    blocks = attach(blocks, sources.select("source", "n_blocks", "epochs", "rest"), ["source"], F.col("block"), rows=n_sources)
    blocks = blocks.withColumn("pos", F.pmod(F.col("block") * F.lit(PRIME) + F.abs(F.xxhash64(F.lit(seed), "source") % (1 << 30)), F.col("n_blocks")))
    blocks = running(blocks, ["source"], "pos", "words")
    blocks = blocks.withColumn("whole", F.col("before") + F.col("words") <= F.col("rest")).withColumn("gap", F.col("rest") - F.col("before"))
    blocks = cut(blocks.withColumn("edge", ~F.col("whole") & (F.col("gap") > 0)))

    # exact quotas: whole rounds of all blocks, then the whole blocks and the edge block of the last
    drawn = blocks.groupBy("source").agg(F.count("*").alias("n_real"), F.first("epochs").alias("epochs"),
                                         F.sum((F.col("whole") & (F.col("rest") > 0) | F.col("edge")).cast("long")).alias("last"))
    drawn = drawn.withColumn("quota", F.col("epochs") * F.col("n_real") + F.col("last"))
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    drawn = cut(drawn.select("source", "n_real", "quota", number.alias("nr")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    n_shards = max(1, -(-total // shard_words))
    quotas = drawn.agg(F.transform(F.array_sort(F.collect_list(F.struct("nr", "quota"))), lambda s: s["quota"]).alias("quotas"))
    shards = split_tree(quotas, n_shards, seed).select("shard", F.posexplode("quotas").alias("nr", "share"))
    shards = shards.withColumn("first", F.coalesce(F.sum("share").over(W.partitionBy("nr").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    draws = shards.filter("share > 0").select("nr", "shard", F.explode(F.sequence("first", F.col("first") + F.col("share") - 1)).alias("draw"))
    draws = attach(draws, drawn.select("nr", "source", "n_real"), ["nr"], F.col("draw"), "inner", rows=n_sources)
    draws = draws.select("source", F.struct(F.floor(F.col("draw") / F.col("n_real")).alias("epoch"), F.col("shard")).alias("draw"),
                         F.pmod("draw", F.col("n_real")).alias("rank"))
    draws = draws.groupBy("source", "rank").agg(F.array_sort(F.collect_list("draw")).alias("draws"))  # at most cap + 1 each
    plan = blocks.join(draws.withColumnRenamed("source", "s").withColumnRenamed("rank", "r"),
                       F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r")), "left").drop("s", "r")
    edge = blocks.filter("edge").select("source", "block", "gap")
    at_edge = attach(attach(sizes, sources.select("source", "n_blocks"), ["source"], F.col("h"), rows=n_sources).withColumn("block", block),
                     edge, ["source", "block"], F.col("h"), "inner", rows=n_sources)  # one edge block a source
    taken = fill(at_edge).filter("took").groupBy("source", "block").agg(F.collect_set("h").alias("picked"))
    plan = plan.join(taken.select(F.col("source").alias("s"), F.col("block").alias("b"), "picked"),
                     F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    plan = cut(plan.select("source", "block", "draws", "picked", "edge", "epochs"))

    rows = attach(keyed, sources.select("source", "source_size", "target", "n_blocks"), ["source"], F.col("h"), rows=n_sources).withColumn("block", block)
    rows = attach(rows, plan, ["source", "block"], F.col("h"))
    none = F.array().cast("array<struct<epoch:bigint,shard:int>>")
    kept = F.filter("draws", lambda d: ~F.col("edge") | (d["epoch"] < F.col("epochs")) | F.array_contains(F.coalesce("picked", F.array().cast("array<bigint>")), F.col("h")))
    return rows.select("row.*", F.col("size").alias("mix_size"), F.col("source_size").alias("mix_source_size"),
                       F.col("target").alias("mix_target"), F.coalesce(kept, none).alias("mix_draws"))


def mix(docs: DataFrame, key: tuple[str, ...] = ("doc_id",), seed: int = SEED, **options) -> DataFrame:
    """The mix itself: one row for each draw of a document, with ``mix_shard``, ``mix_epoch`` and
    ``mix_order`` (columns of these names give way), spread by range over shard and order and sorted, so
    that written files hold the shuffled shards one after the other."""
    docs = without(docs, "mix_shard", "mix_epoch", "mix_order")
    rows = plan_mix(docs, key=key, seed=seed, **options)
    rows = rows.withColumn("_draw", F.explode("mix_draws"))
    order = F.xxhash64(F.lit(seed + 1), F.col("_draw.epoch"), *key)
    rows = rows.select(*docs.columns, F.col("_draw.shard").alias("mix_shard"), F.col("_draw.epoch").alias("mix_epoch"), order.alias("mix_order"))
    return rows.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    rows = plan_mix(cut(docs), size=F.col("size"))
    return rows.select("doc_id", "source", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), (F.col("mix_size") * F.size("mix_draws")).cast("long").alias("taken"))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents as often as the mix takes them."""
    return mix(docs).select(*docs.columns)
