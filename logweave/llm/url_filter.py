"""URL filters: rules where one fits, else gradient-boosted trees on lexical features.

The rules label the URLs that they fit; Spark ML trains boosted trees on a bounded sample of these
labels and judges the URLs that no rule fits.  Features are read off the URL alone: length, depth,
shares of digits and other characters, entropy, parameters, and statistics of the host's suffixes and of the path's first segment:
how often other URLs with the same one are allowed, smoothed by the share among all labelled URLs.  What a
labelled URL is trained with leaves out its own label, so a rare suffix does not give the answer away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import attach, cut, table, without

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Labelled URLs that the trees are trained on, at most, chosen for each verdict by a hash of the URL.
MAX_SAMPLE = 20_000
TREES = 10
DEPTH = 4
#: Labelled URLs that the general share counts for in a suffix's statistics.
SMOOTH = 20.0
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "hyphens", "symbols",
            "parameters", "query_length", "has_fragment", "entropy", "longest_label", "last_digits", "has_extension",
            "suffix_1", "suffix_2", "segment", "suffix_segment")


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host in lower case (A-Z), the path up to ``?`` or ``#``; both empty without ``://``."""
    after = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matched(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; of rules of equal length the one
    with the longer host wins, then the first by its text."""
    by_length = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(by_length):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def suffix(host: Column, k: int) -> Column:
    return F.substring_index(host, ".", -k)


def count_of(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The lexical features that need nothing but the URL."""
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    last = F.regexp_extract(path, r"([^/]*)/?$", 1)
    # entropy over the characters, each distinct one counted by what is left without it
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(letters, F.lit(0.0), lambda a, c: a - F.when(share(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))
    longest = F.aggregate(F.split(host, r"\."), F.lit(0), lambda a, c: F.greatest(a, F.length(c)))
    return {"length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "depth": count_of(path, "/"),
            "labels": count_of(host, r"\."), "digits": count_of(url, "[0-9]") / size,
            "host_digits": count_of(host, "[0-9]") / F.greatest(F.length(host), F.lit(1)), "hyphens": count_of(url, "-"),
            "symbols": count_of(url, "[^0-9A-Za-z]") / size, "parameters": count_of(query, "=") , "query_length": F.length(query),
            "has_fragment": F.contains(url, F.lit("#")).cast("double"), "entropy": entropy, "longest_label": longest,
            "last_digits": count_of(last, "[0-9]"), "has_extension": last.rlike(r"\.[A-Za-z0-9]+$").cast("double")}


def statistic_keys(host: Column, path: Column) -> dict[str, Column]:
    """What labelled URLs are counted by: the host's last label and last two, the path's first segment, and the
    last label with that segment."""
    segment = F.lower(F.regexp_extract(path, r"^/([^/]*)", 1))
    return {"suffix_1": suffix(host, 1), "suffix_2": suffix(host, 2), "segment": segment, "suffix_segment": F.concat(suffix(host, 1), F.lit("/"), segment)}


class Learnt:
    """Statistics of labelled URLs (u, host, path, label 1.0: allowed) and trees trained on a sample of them."""

    def __init__(self, labelled: DataFrame, max_sample: int = MAX_SAMPLE, seed: int = 7):
        from pyspark.ml.classification import GBTClassifier  # here, so that other queries' drivers do without

        urls = cut(labelled.groupBy("u", "host", "path").agg(F.max("label").alias("label")))
        n, allowed = urls.agg(F.count("*"), F.sum("label")).first()
        self.both = bool(n) and 0 < allowed < n
        if not self.both:
            return
        self.general = allowed / n
        self.stats = {name: cut(urls.groupBy(key.alias(f"k_{name}")).agg(F.sum("label").alias(f"a_{name}"), F.count("*").alias(f"n_{name}")))
                      for name, key in statistic_keys(F.col("host"), F.col("path")).items()}
        sample = sampled(urls, max_sample, seed)
        share = sample.agg(F.avg("label")).first()[0]
        weighted = sample.withColumn("weight", F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
        trees = GBTClassifier(featuresCol="f", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=seed, stepSize=0.3)
        self.model = trees.fit(cut(self._featured(weighted, own=True).select("f", "label", "weight")))

    def _featured(self, rows: DataFrame, own: bool = False) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        rows = rows.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{n}") for n, c in features(F.col("u"), F.col("host"), F.col("path")).items()])
        for name, key in statistic_keys(F.col("host"), F.col("path")).items():
            rows = attach(rows.withColumn(f"k_{name}", key), self.stats[name], [f"k_{name}"], F.xxhash64("u"))
            a, n = F.coalesce(f"a_{name}", F.lit(0.0)), F.coalesce(f"n_{name}", F.lit(0))
            if own:
                a, n = a - F.col("label"), n - 1
            rows = rows.withColumn(f"f_{name}", (a + SMOOTH * self.general) / (n + SMOOTH)).drop(f"k_{name}", f"a_{name}", f"n_{name}")
        return VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="f").transform(rows).drop(*[f"f_{n}" for n in FEATURES])

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (u, host, path, ...) with ``p``, the probability that a URL is allowed."""
        from pyspark.ml.functions import vector_to_array

        scored = self.model.setProbabilityCol("p").transform(self._featured(rows))
        return scored.withColumn("p", F.element_at(vector_to_array(F.col("p")), 2)).drop("f", "rawPrediction", "prediction")


def sampled(urls: DataFrame, most: int, seed: int) -> DataFrame:
    """All labelled URLs, or ``most`` of them by hash, of which the rarer verdict has up to half."""
    pick = lambda d, y, k: d.filter(F.col("label") == y).orderBy(F.xxhash64(F.lit(seed), "u"), "u").limit(k)
    both = cut(pick(urls, 0.0, most).unionByName(pick(urls, 1.0, most)))
    n = {y: both.filter(F.col("label") == y).count() for y in (0.0, 1.0)}
    if sum(n.values()) <= most:
        return both
    keep = {y: min(n[y], max(most // 2, most - n[1.0 - y])) for y in n}
    return cut(pick(both, 0.0, keep[0.0]).unionByName(pick(both, 1.0, keep[1.0])))


def judge(pages: DataFrame, url: str = "url", rules=RULES, max_sample: int = MAX_SAMPLE, seed: int = 7) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` (null where none fits), ``verdict`` and
    ``p_allow`` (the trees' probability, null where a rule decides); columns of these names give way.

    The trees learn from both verdicts with equal weight, however rare one of them is.

    A null URL counts as empty.  Repeated rows get the same verdict.  Where no rule fits and the labelled
    URLs have but one verdict (or there are none), the trees cannot learn and the verdict is ``allow``."""
    pages = without(pages, "host", "path", "rule", "verdict", "p_allow")
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host, path = parts(u)
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), u.alias("u"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("m", matched(F.col("host"), F.col("path"), rules))
    labelled = rows.filter("m is not null").select("u", "host", "path", F.when(F.col("m.verdict") == "allow", 1.0).otherwise(0.0).alias("label"))
    made = lambda r, p, v: r.select("row.*", "host", "path", F.col("m.rule").alias("rule"),
                                    F.coalesce(F.col("m.verdict"), v).alias("verdict"), F.when(F.col("m").isNull(), p).alias("p_allow"))
    learnt = Learnt(labelled, max_sample, seed)
    if not learnt.both:
        return made(rows, F.lit(None).cast("double"), F.lit("allow"))
    return made(learnt.score(rows), F.col("p"), F.when(F.col("p") >= 0.5, "allow").otherwise("block"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "p_allow")
