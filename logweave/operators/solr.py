"""Search-server (log4j) log job with stack traces: P11 and its post-steps P12-P14."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grok import PatternLibrary, compile_grok
from ..functions.text import collapse_ws, java_trim
from ..functions.timefmt import iso_string, parse_timestamp
from ..session import prepare
from .multiline import CHUNK_LINES, CONT, START, assemble_records, record_pieces
from .normalize import IGNORED_FIELD, prune_empty_value

# Defaults and names used by the reference's search-log parser.
DEFAULT_LOG_EXPRESSION = "%{SOLR_6_LOG4J}"
DEFAULT_REQUEST_EXPRESSION = "%{SOLR_6_REQUEST}"
DEFAULT_MESSAGE_FIELD = "message_txt_en"
REQUEST_CATEGORIES = ("o.a.s.c.S.Request", "org.apache.solr.core.SolrCore")
MDC_KEYS = (("c", "collection_s"), ("s", "shard_s"), ("r", "replica_s"), ("x", "core_s"))
DROPPED_AFTER_ASSEMBLY = ("SECOND", "MONTHNUM", "YEAR", "MONTHDAY")


def unpack_mdc(df: DataFrame, mdc_col: str = "mdc_s") -> DataFrame:
    """``c:coll s:shard r:replica x:core`` → the four ``*_s`` columns.

    The value is split on whitespace; a token counts when splitting it on ``:`` gives exactly
    two parts (trailing empty parts are dropped, as Java's ``split`` does); a later token wins; a
    column keeps its value when its key is absent.  One regex per key, no per-token lambdas."""
    mdc = F.col(mdc_col)
    cols = {}
    for key, name in MDC_KEYS:
        # last whitespace-delimited token "key:value" followed only by ':'s
        rx = rf"(?s)^.*(?:^|\s){key}:([^:\s]+):*(?:\s|$)"
        v = F.nullif(F.regexp_extract(mdc, rx, 1), F.lit(""))
        cur = F.col(name) if name in df.columns else F.lit(None).cast("string")
        cols[name] = F.coalesce(v, cur)
    return df.withColumns(cols)


# a key (text before the first '='), other than '_', that does not end in "_s" gets the suffix
_PARAM_KEY = r"(^|&)(?!_=)([^&=]*)(?<!_s)="


def explode_params(params: Column) -> Column:
    """``a=1&b=2&_=3`` → ``MAP{a_s: 1, b_s: 2}``: pairs without ``=`` and key ``_`` are skipped,
    ``_s`` is appended unless present, no URL decoding, a later pair wins.

    Native functions only: one regex adds the suffixes, ``str_to_map`` splits the pairs at the
    first ``=`` (a later key replaces an earlier one under the session's LAST_WIN policy, set by
    :func:`logweave.session.prepare`), one ``map_filter`` drops ``_`` and what is left of pairs
    without ``=``, which an earlier regex has emptied so that they replace nothing."""
    pairs = F.regexp_replace(params, r"(^|&)[^&=]*(?=&|$)", "$1")  # pairs without "=" go first
    suffixed = F.regexp_replace(pairs, _PARAM_KEY, "$1$2_s=")
    m = F.str_to_map(suffixed, F.lit("&"), F.lit("="))
    return F.when(params.isNotNull(), F.map_filter(m, lambda k, v: v.isNotNull() & (k != "_")))


def solr_request_fields(records: DataFrame, message_col: str = DEFAULT_MESSAGE_FIELD,
                        expression: str = DEFAULT_REQUEST_EXPRESSION, library: PatternLibrary | None = None,
                        parse_params: bool = True) -> DataFrame:
    """For request categories, match the (whitespace-collapsed, trimmed) message against the
    request expression and overwrite the record's fields with its captures (also NULLs, as the
    reference puts every capture).  ``params`` holds the exploded ``params_s`` pairs."""
    return _apply_request(records, message_col, expression, library, parse_params)


def solr_log(lines: DataFrame, expression: str = DEFAULT_LOG_EXPRESSION, library: PatternLibrary | None = None, *,
             timestamp_field: str | None = "timestamp_tdt", date_field: str = "logdate",
             date_format: str | None = "yyyy-MM-dd HH:mm:ss.SSS", message_field: str = DEFAULT_MESSAGE_FIELD,
             request_expression: str | None = DEFAULT_REQUEST_EXPRESSION, parse_params: bool = True,
             chunk_lines: int = CHUNK_LINES, keep_empty: bool = False, pieces: bool = False) -> DataFrame:
    """Search-server log with multi-line entries.

    Input: trimmed, non-blank lines.  Each line is whitespace-collapsed; a line matching
    ``expression`` starts a record (its fields, ``logmessage`` trimmed into ``message_field``,
    the ISO timestamp replacing ``date_field`` when it parses, blank fields pruned), any other line
    continues the message after one space.  Then the MDC is unpacked and request lines get their
    request fields and parameters.

    ``pieces``: instead of records, their messages as ordered pieces (:func:`logweave.operators.multiline.record_pieces`:
    ``file, first_line, part_no, text``), for logs with records too long for one value, such as one in which no line
    begins a record; a piece holds what ``chunk_lines`` lines add.
    """
    prepare(lines.sparkSession)
    grok = compile_grok(expression, library)
    collapsed = lines.withColumn("line", collapse_ws(F.col("line")))
    parsed = grok.apply(collapsed, source_col="line", matched_col="__start")
    fields = [f for f in grok.fields if f not in ("logmessage", IGNORED_FIELD)]
    top = expression[2:-1] if expression.startswith("%{") and expression.endswith("}") else None
    if timestamp_field and date_format:
        ts = parse_timestamp(F.col(f"`{date_field}`"), date_format)
        parsed = parsed.withColumn(timestamp_field, iso_string(ts))
        if date_field in fields:
            parsed = parsed.withColumn(date_field, F.when(ts.isNull(), F.col(f"`{date_field}`")))
        if timestamp_field not in fields:
            fields.append(timestamp_field)
    start_vals = {f: F.when(F.col("__start"), prune_empty_value(F.col(f"`{f}`"))) for f in fields}
    piece = F.when(F.col("__start"), java_trim(F.col("logmessage"))) if "logmessage" in grok.fields else \
        F.when(F.col("__start"), F.lit(None).cast("string"))
    piece = F.when(F.col("__start"), piece).otherwise(F.concat(F.lit(" "), F.col("line")))
    classified = parsed.select(
        "file", "line_num",
        F.when(F.col("__start"), F.lit(START)).otherwise(F.lit(CONT)).alias("state"),
        *[v.alias(f) for f, v in start_vals.items()],
        piece.alias("__piece"),
    )
    if pieces:
        return record_pieces(classified, "__piece", chunk_lines=chunk_lines)
    rec = assemble_records(classified, fields=fields, text_col="__piece", chunk_lines=chunk_lines,
                           keep_empty=keep_empty)
    rec = rec.withColumn(message_field, F.when(F.col("__piece") != "", F.col("__piece"))).drop("__piece")
    drop = [c for c in DROPPED_AFTER_ASSEMBLY + ((top,) if top else ()) if c in rec.columns]
    rec = rec.drop(*drop)
    if "mdc_s" in rec.columns:
        rec = unpack_mdc(rec)
    if request_expression and "category_s" in rec.columns:
        rec = _apply_request(rec, message_field, request_expression, library, parse_params)
    return rec


def _apply_request(rec: DataFrame, message_col: str, expression: str, library, parse_params: bool) -> DataFrame:
    grok = compile_grok(expression, library)
    req_fields = [f for f in grok.fields if f not in ("logmessage", "BASE10NUM", IGNORED_FIELD)]
    eligible = F.col("category_s").isin(*REQUEST_CATEGORIES) & F.col(message_col).isNotNull()
    # captures go to temporary names first, then overwrite the record's fields when matched
    tmp = {f: f"__rq_{i}" for i, f in enumerate(req_fields)}
    staged = rec.withColumn("__req", F.when(eligible, java_trim(collapse_ws(F.col(message_col)))))
    applied = grok.apply(staged.withColumnsRenamed({f: f"__orig_{i}" for i, f in enumerate(req_fields) if f in rec.columns}),
                         source_col="__req", matched_col="__req_ok")
    hit = F.coalesce(F.col("__req_ok"), F.lit(False))
    cols = {}
    for i, f in enumerate(req_fields):
        orig = F.col(f"__orig_{i}") if f in rec.columns else F.lit(None).cast("string")
        cols[tmp[f]] = F.when(hit, F.col(f"`{f}`")).otherwise(orig)
    out = applied.withColumns(cols)
    out = out.drop(*[f for f in grok.fields], *[f"__orig_{i}" for i, f in enumerate(req_fields) if f in rec.columns])
    out = out.withColumnsRenamed({v: k for k, v in tmp.items()})
    if parse_params:
        out = out.withColumn("params", F.when(hit, explode_params(F.col("params_s"))))
    return out.drop("__req", "__req_ok")
