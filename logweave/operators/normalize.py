"""Line normalisation and routing (N1-N6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import materialize
from ..functions.text import collapse_ws, java_trim

# Fixed value: the capture name whose values are never kept.
IGNORED_FIELD = "ignored"


def normalize_lines(lines: DataFrame, col: str = "line", keep_blank: bool = False) -> DataFrame:
    """Java-style trim of every line; blank lines are dropped (they never reach a parser, and
    count as parsed in the statistics).  ``keep_blank=True`` keeps them with an empty string."""
    # the trimmed line sits behind the generator barrier: the blank-line filter is not inlined
    # (and pushed down to the scan) as a second copy of everything that produced the line
    cols = [c for c in lines.columns if c != col]
    out = materialize(lines, "__trimmed", java_trim(F.col(col))).select(*cols, F.col("__trimmed").alias(col))
    return out if keep_blank else out.where(F.col(col) != "")


def collapse_whitespace(lines: DataFrame, col: str = "line") -> DataFrame:
    return lines.withColumn(col, collapse_ws(F.col(col)))


def swap_delimiter(lines: DataFrame, col: str = "line", old: str = "|", new: str = " ") -> DataFrame:
    return lines.withColumn(col, F.translate(F.col(col), old, new))


def prune_empty_value(c: Column) -> Column:
    """NULL for a value that is NULL or blank (Java trim), else the value."""
    return F.when(java_trim(c) != "", c)


def prune_empty(df: DataFrame, fields: list[str], drop: tuple[str, ...] = (IGNORED_FIELD,)) -> DataFrame:
    """Blank string values become NULL (and so are left out of documents); the field named
    ``ignored`` is dropped."""
    out = df.withColumns({f: prune_empty_value(F.col(f"`{f}`")) for f in fields if f not in drop
                          and dict(df.dtypes).get(f) == "string"})
    return out.drop(*[f for f in drop if f in df.columns])


def prune_empty_map(c: Column) -> Column:
    return F.map_filter(c, lambda k, v: (k != IGNORED_FIELD) & v.isNotNull() & (java_trim(v) != ""))


def ignore_before(df: DataFrame, cutoff: str, ts_col: str = "ts") -> DataFrame:
    """Keep records at or after ``cutoff`` (``yyyy-MM-dd'T'HH:mm:ss`` UTC); records without a
    timestamp are kept.  On a stored table the predicate reaches the Parquet scan."""
    cut = F.to_timestamp(F.lit(cutoff), "yyyy-MM-dd'T'HH:mm:ss")
    return df.where(F.col(ts_col).isNull() | (F.col(ts_col) >= cut))


def route_unmatched(parsed: DataFrame, unmatched_line_name: str | None = None, matched_col: str = "_matched",
                    line_col: str = "line") -> DataFrame:
    """With a name: an unmatched line becomes a record holding the line under that name (all
    other fields NULL).  Without: unmatched lines are dropped (they count as skipped)."""
    if not unmatched_line_name:
        return parsed.where(F.col(matched_col))
    return parsed.withColumn(unmatched_line_name,
                             F.when(~F.col(matched_col), F.col(line_col)).cast("string"))


def split_unmatched(parsed: DataFrame, matched_col: str = "_matched") -> tuple[DataFrame, DataFrame]:
    """(matched records, rejected lines) as two DataFrames over the same plan."""
    rejected = parsed.where(~F.col(matched_col)).select("file", "line_num", "line")
    return parsed.where(F.col(matched_col)), rejected
