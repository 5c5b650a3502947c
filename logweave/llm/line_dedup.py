"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a text (lines without a word are passed over) are hashed to 128 bits.
A window found again anywhere is a repetition: its first occurrence, by document and position, stays,
and the lines of every later one go.  Positions covered by several windows are merged, so a long
repeated passage goes as one piece.

Windows are made inside each row.  Counting them is a partial aggregation, so a window that a third of
all rows have is one small row per task; the repeated windows, cut to a table of their own, are joined
back by a sort-merge join whose large partitions Spark splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import WORD, cut, table, without

LINES = 3
SEED = 1469


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, th, at, h1, h2, covers): windows with the positions of their lines; ``th`` is the text's hash."""
    parts = F.transform(lines_of(F.col(text)), lambda line, i: F.struct(
        i.alias("i"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(SEED), line).alias("b"), line.rlike(WORD).alias("full")))
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("th"), F.filter(parts, lambda p: p["full"]).alias("p"))
    rows = rows.filter(F.size("p") >= LINES)
    at = lambda k, f: F.element_at("p", F.col("at") + k)[f]
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("p") - (LINES - 1))))
    return rows.select("id", "th", "at", F.xxhash64(*[at(k, "a") for k in range(LINES)]).alias("h1"),
                       F.xxhash64(*[at(k, "b") for k in range(LINES)]).alias("h2"),
                       F.array(*[at(k, "i") for k in range(LINES)]).alias("covers"))


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, th, gone): for each document with repetitions, the positions (from 0) of lines that go."""
    windows = _windows(docs, doc_id, text)
    place = F.struct("id", "th", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    repeated = cut(repeated.select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first"))
    later = windows.join(repeated.hint("merge"), (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")))
    later = later.filter(~place.eqNullSafe(F.col("first"))).select("id", "th", F.explode("covers").alias("i"))
    return later.distinct().groupBy("id", "th").agg(F.collect_list("i").alias("gone"))  # bounded by a text's lines


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``text`` cleaned, ``n_lines`` and ``n_removed`` (columns of these names
    give way).

    Lines are compared as they are; lines without a word are in no window and stay.  A null text stays
    null with no lines; a text of fewer than three lines with words stays whole.  The order of documents is that of
    their ids (null first), then of their texts' hashes; rows that agree in id and text are one
    document and get one result.  A text may end up empty; its row stays."""
    docs = without(docs, "n_lines", "n_removed")
    gone = removed_lines(docs, doc_id, text).select(F.col("id").alias("_id"), F.col("th").alias("_th"), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("_d"),
                       F.col(text).alias("_t"), F.xxhash64(text).alias("_h"))
    rows = rows.join(gone, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left")
    parts = lines_of(F.col("_t"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "gone")
    clean = F.when(F.col("gone").isNull(), F.col("_t")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    n_lines = F.when(F.col("_t").isNull(), F.lit(0)).otherwise(F.size(parts))
    return rows.select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns],
                       n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


OP9_SQL = """
WITH l AS (
  SELECT doc_id, CAST(u.i AS BIGINT) - 1 AS i, u.line FROM (
    SELECT doc_id, unnest(list_zip(range(1, len(s) + 1), s)) AS z FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)
  ), LATERAL (SELECT z[1] AS i, z[2] AS line) u),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
w AS (
  SELECT a.doc_id, a.pos, a.i AS i1, b.i AS i2, c.i AS i3, a.line AS x, b.line AS y, c.line AS z
  FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 JOIN f c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, pos) AS nth FROM w) WHERE nth > 1),
gone AS (SELECT doc_id, i1 AS i FROM later UNION SELECT doc_id, i2 FROM later UNION SELECT doc_id, i3 FROM later)
SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
       coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '') AS text
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
"""


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages go; so do documents of which nothing is left."""
    clean = dedup_lines(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD)).select(*docs.columns)
