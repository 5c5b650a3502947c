"""Run statistics (A1-A3): per file, totals, per endpoint.  Plain aggregations on the job's own
DataFrames (map-side partial aggregation, one shuffle of per-file partial counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_trim
from .multiline import SKIP

BLANK, DOC, SKIPPED = "blank", "doc", "skip"
BLANK_STATE = "BLANK"  # state of a blank line in a classification that keeps them


def line_status(lines: DataFrame, parsed: DataFrame, matched_col: str = "_matched", routed: bool = False) -> DataFrame:
    """``(file, line_num, status)`` for a single-line job.  ``lines``: all physical lines;
    ``parsed``: the extraction over every non-blank line, before routing, with ``matched_col``.
    ``routed``: unmatched lines were kept as records (``unmatched_line_name``), so they are
    documents too."""
    blank = lines.select("file", "line_num", F.lit(BLANK).alias("status")).where(java_trim(F.col("line")) == "")
    is_doc = F.lit(True) if routed else F.col(matched_col)
    rest = parsed.select("file", "line_num", F.when(is_doc, F.lit(DOC)).otherwise(F.lit(SKIPPED)).alias("status"))
    return blank.unionByName(rest)


def status_of(parsed: DataFrame, matched_col: str = "_matched", line_col: str = "line",
              routed: bool = False) -> DataFrame:
    """Single-pass variant of :func:`line_status`: ``parsed`` is the job run over
    ``normalize_lines(lines, keep_blank=True)``, so every physical line is there once; blank lines
    count as blank whatever the parser made of them (they never reach a parser)."""
    is_doc = F.lit(True) if routed else F.col(matched_col)
    status = (F.when(F.col(line_col) == "", F.lit(BLANK)).when(is_doc, F.lit(DOC)).otherwise(F.lit(SKIPPED)))
    return parsed.select("file", "line_num", status.alias("status"))


def file_stats(status: DataFrame) -> DataFrame:
    """Single-line jobs: ``(file, lines_read, lines_parsed, lines_skipped, docs)``; blank lines
    count as parsed, so ``read = parsed + skipped``."""
    s = F.col("status")
    return status.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.sum(F.when(s.isin(BLANK, DOC), 1).otherwise(0)).cast("bigint").alias("lines_parsed"),
        F.sum(F.when(s == SKIPPED, 1).otherwise(0)).cast("bigint").alias("lines_skipped"),
        F.sum(F.when(s == DOC, 1).otherwise(0)).cast("bigint").alias("docs"),
    )


def multiline_file_stats(lines: DataFrame, classified: DataFrame, records_all: DataFrame) -> DataFrame:
    """Multi-line jobs.  ``lines``: all physical lines; ``classified``: non-blank lines with
    ``state``; ``records_all``: :func:`assemble_records` with ``keep_empty=True``.

    parsed = blank lines + lines of emitted records; skipped = SKIP lines + lines of buffers closed
    by END with nothing in them; lines whose parse failed count in neither.
    """
    per_line = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.sum(F.when(java_trim(F.col("line")) == "", 1).otherwise(0)).cast("bigint").alias("__blank"))
    per_state = classified.groupBy("file").agg(
        F.sum(F.when(F.col("state") == SKIP, 1).otherwise(0)).cast("bigint").alias("__skip"))
    per_rec = records_all.groupBy("file").agg(
        F.sum(F.when(F.col("emitted"), 1).otherwise(0)).cast("bigint").alias("docs"),
        F.sum(F.when(F.col("emitted"), F.col("n_lines")).otherwise(0)).cast("bigint").alias("__rec_lines"),
        F.sum(F.when(~F.col("emitted") & F.col("has_end"), F.col("n_lines")).otherwise(0)).cast("bigint").alias("__empty_end"))
    z = F.lit(0).cast("bigint")
    out = per_line.join(per_state, "file", "left").join(per_rec, "file", "left")
    return out.select(
        "file", "lines_read",
        (F.col("__blank") + F.coalesce("__rec_lines", z)).alias("lines_parsed"),
        (F.coalesce("__skip", z) + F.coalesce("__empty_end", z)).alias("lines_skipped"),
        F.coalesce("docs", z).alias("docs"))


def multiline_stats(classified: DataFrame, records_all: DataFrame) -> DataFrame:
    """Like :func:`multiline_file_stats` with one pass fewer: ``classified`` holds every
    physical line with its ``state`` (``BLANK`` for blank lines, NULL where the classifier
    failed), so lines read, blank and SKIP lines come from one aggregation."""
    st = F.col("state")
    per_line = classified.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.sum(F.when(st == BLANK_STATE, 1).otherwise(0)).cast("bigint").alias("__blank"),
        F.sum(F.when(st == SKIP, 1).otherwise(0)).cast("bigint").alias("__skip"))
    per_rec = records_all.groupBy("file").agg(
        F.sum(F.when(F.col("emitted"), 1).otherwise(0)).cast("bigint").alias("docs"),
        F.sum(F.when(F.col("emitted"), F.col("n_lines")).otherwise(0)).cast("bigint").alias("__rec_lines"),
        F.sum(F.when(~F.col("emitted") & F.col("has_end"), F.col("n_lines")).otherwise(0)).cast("bigint").alias("__empty_end"))
    z = F.lit(0).cast("bigint")
    out = per_line.join(per_rec, "file", "left")
    return out.select(
        "file", "lines_read",
        (F.col("__blank") + F.coalesce("__rec_lines", z)).alias("lines_parsed"),
        (F.col("__skip") + F.coalesce("__empty_end", z)).alias("lines_skipped"),
        F.coalesce("docs", z).alias("docs"))


def run_stats(stats: DataFrame) -> DataFrame:
    """Totals over :func:`file_stats`: files, documents, lines read / parsed / skipped."""
    return stats.agg(
        F.count(F.lit(1)).alias("files_total"),
        F.sum(F.when(F.col("docs") > 0, 1).otherwise(0)).cast("bigint").alias("files_with_docs"),
        F.sum("docs").cast("bigint").alias("docs"),
        F.sum("lines_read").cast("bigint").alias("lines_read"),
        F.sum("lines_parsed").cast("bigint").alias("lines_parsed"),
        F.sum("lines_skipped").cast("bigint").alias("lines_skipped"),
    )


def endpoint_stats(deliveries: DataFrame) -> DataFrame:
    """Documents sent per endpoint (from :func:`logweave.sinks.deliver.deliver`)."""
    return deliveries.groupBy("endpoint").agg(
        F.sum("n_docs").cast("bigint").alias("docs_sent"), F.count(F.lit(1)).alias("batches"))


def run_counts(status_col: str = "status", files: bool = True) -> list:
    """Totals of a job over rows with a status (:func:`status_of`) and, for ``files``, ``line_num``: files that have lines,
    lines read, parsed and skipped, documents; for ``observe`` or ``agg``."""
    s = F.col(status_col)
    return [
        *([F.sum(F.when(F.col("line_num") == 1, 1).otherwise(0)).alias("files")] if files else []),
        F.count(F.lit(1)).alias("lines_read"),
        F.sum(F.when(s.isin(BLANK, DOC), 1).otherwise(0)).alias("lines_parsed"),
        F.sum(F.when(s == SKIPPED, 1).otherwise(0)).alias("lines_skipped"),
        F.sum(F.when(s == DOC, 1).otherwise(0)).alias("docs"),
    ]


def observe_run(df: DataFrame, name: str = "logweave_run", status_col: str = "status"):
    """Totals gathered while ``df`` is written by the job's own sink, with no second pass:
    returns ``(observed_df, observation)``; after the action ``observation.get`` holds
    ``lines_read, lines_parsed, lines_skipped, docs``.  ``df`` carries a ``status`` column as
    produced by :func:`status_of` (keep the non-document rows until the sink filters them).  For streams use
    ``df.observe(name, *run_counts())`` and :class:`logweave.streaming.progress.ProgressListener`."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, *run_counts(status_col, files=False)), obs
