"""Single-line extraction jobs: grok (P1-P5), DNS (P6), JSON lines (P7), raw lines (P8).

Every job is ``lines(file, line_num, line, ...) → records``; the parser runs as Spark SQL
expressions on the executors, lines are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grok import PatternLibrary, compile_grok
from ..functions.plan import materialize
from ..functions.text import file_line_id
from ..functions.timefmt import iso_string, parse_timestamp
from ..session import ensure_utc, prepare
from .normalize import swap_delimiter

DEFAULT_GROK = "%{COMMONAPACHELOG}"

# Fixed value: the DNS server log expression and date format of the reference's DNS parser.
DNS_EXPRESSION = (
    "%{SYSLOGTIMESTAMP} %{HOSTNAME} MSWinEventLog 1 Application %{NUMBER} %{DAY} "
    "%{SYSLOGTIMESTAMP:logdate} %{YEAR} 3 Lucent DNS Service N/A N/A Information %{HOSTNAME:host} "
    "None  client %{IP:client}#%{NUMBER}: query: "
    "(?<query>\\b((xn--)?[a-z0-9\\w]+(-[a-z0-9]+)*\\.)+[a-z]{2,}\\b) IN %{WORD:type}"
)
DNS_DATE_FORMAT = "MMM dd HH:mm:ss yyyy"


def grok_extract(lines: DataFrame, pattern: str = DEFAULT_GROK, library: PatternLibrary | None = None, *,
                 source_col: str = "line", keep_unnamed=(), strip_quotes: bool = True,
                 matched_col: str = "_matched") -> DataFrame:
    """Add ``_matched`` and one STRING (or typed) column per capture of ``pattern``.

    Unmatched lines stay in the result with ``_matched = false`` and NULL fields; route them with
    :func:`logweave.operators.normalize.route_unmatched`.
    """
    grok = compile_grok(pattern, library, keep_unnamed=keep_unnamed, strip_quotes=strip_quotes)
    return grok.apply(lines, source_col=source_col, matched_col=matched_col)


def grok_fields(pattern: str = DEFAULT_GROK, library: PatternLibrary | None = None, keep_unnamed=()) -> list[str]:
    return compile_grok(pattern, library, keep_unnamed=keep_unnamed).fields


def normalize_timestamp(df: DataFrame, date_field: str, date_format: str, out_field: str,
                        drop_source: bool = False, ts_col: str | None = None) -> DataFrame:
    """Parse ``date_field`` with a SimpleDateFormat-style ``date_format`` in UTC and write the
    ISO-8601 string to ``out_field``; a value that does not parse leaves ``out_field`` NULL.
    ``drop_source`` removes the source field when parsing succeeded (search-log job).
    ``ts_col`` additionally keeps the TIMESTAMP value (for filters / partitioning)."""
    ensure_utc(df.sparkSession)
    ts = parse_timestamp(F.col(f"`{date_field}`"), date_format)
    out = df.withColumn("__ts", ts).withColumn(out_field, iso_string(F.col("__ts")))
    if drop_source:
        out = out.withColumn(date_field, F.when(F.col("__ts").isNull(), F.col(f"`{date_field}`")))
    if ts_col:
        out = out.withColumnRenamed("__ts", ts_col)
    return out.drop("__ts")


def grok_job(lines: DataFrame, pattern: str = DEFAULT_GROK, library: PatternLibrary | None = None, *,
             timestamp_field: str | None = None, date_field: str | None = None,
             date_format: str | None = None, unmatched_line_name: str | None = None,
             keep_unnamed=(), strip_quotes: bool = True) -> DataFrame:
    """The reference's configurable grok parser as one job: extract, optional ISO timestamp,
    routing of unmatched lines.  Output keeps ``file, line_num, _matched`` and the fields."""
    from .normalize import route_unmatched
    out = grok_extract(lines, pattern, library, keep_unnamed=keep_unnamed, strip_quotes=strip_quotes)
    if timestamp_field:
        if date_format is None:
            raise ValueError("timestamp_field needs date_format")
        out = normalize_timestamp(out, date_field or "timestamp", date_format, timestamp_field)
    return route_unmatched(out, unmatched_line_name)


def dns_log(lines: DataFrame, library: PatternLibrary | None = None) -> DataFrame:
    """DNS server log job: ``|`` → space, fixed expression, ``timestamp`` from ``logdate`` and the
    unnamed ``YEAR``.  A line whose date does not parse is rejected (``_matched`` false)."""
    ensure_utc(lines.sparkSession)
    swapped = swap_delimiter(lines)
    out = grok_extract(swapped, DNS_EXPRESSION, library, keep_unnamed=["YEAR"])
    ts = parse_timestamp(F.concat_ws(" ", F.col("logdate"), F.col("YEAR")), DNS_DATE_FORMAT)
    out = out.withColumn("timestamp", iso_string(ts))
    return out.withColumn("_matched", F.col("_matched") & F.col("timestamp").isNotNull())


def json_lines(lines: DataFrame, schema=None, col: str = "line") -> DataFrame:
    """One JSON object per line.

    Without ``schema``: ``fields MAP<STRING, VARIANT>`` keeping value types and nesting; a key
    given twice keeps its last value, JSON ``null`` values are left out.  With ``schema`` (DDL
    string or StructType): its columns.  Malformed lines, arrays, scalars and ``null`` lines are
    rejected (``_matched`` false).
    """
    prepare(lines.sparkSession)  # LAST_WIN: rebuilding the map keeps a repeated key's last value
    m = F.from_json(F.col(col), "map<string,variant>")
    fields = F.map_filter(F.map_from_entries(F.map_entries(m)), lambda k, v: ~F.is_variant_null(v))
    out = materialize(lines, "fields", fields).withColumn("_matched", F.col("fields").isNotNull())
    if schema is not None:
        typed = F.from_json(F.col(col), schema)
        out = out.withColumn("__typed", F.when(F.col("_matched"), typed)).select("*", "__typed.*").drop("__typed")
    return out


def raw_lines(lines: DataFrame) -> DataFrame:
    """``{id: "file:line", _raw_content_: line}`` for every line."""
    return lines.select("file", "line_num",
                        file_line_id(F.col("file"), F.col("line_num")).alias("id"),
                        F.col("line").alias("_raw_content_"))
