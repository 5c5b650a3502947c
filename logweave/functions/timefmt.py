"""Date parsing with reference (SimpleDateFormat-style) formats, output as ISO-8601 UTC strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ISO-8601 form written for every parsed timestamp (UTC, milliseconds).
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def spark_format(java_format: str) -> str:
    """Translate a SimpleDateFormat pattern to a Spark datetime pattern.

    SimpleDateFormat parses numbers leniently (``dd`` accepts ``9``); Spark's ``dd`` needs two
    digits, so day-of-month becomes ``d``.  Quoted literals are left alone.
    """
    out, i = [], 0
    for m in re.finditer(r"'[^']*'|(d+)", java_format):
        out.append(java_format[i:m.start()])
        out.append("d" if m.group(1) else m.group(0))
        i = m.end()
    out.append(java_format[i:])
    return "".join(out)


def parse_timestamp(value: Column, java_format: str) -> Column:
    """TIMESTAMP or NULL.  Runs of whitespace are read as one blank, as SimpleDateFormat skips
    blanks before numeric fields (``Dec  9``).  The session time zone must be UTC
    (:func:`logweave.session.ensure_utc`)."""
    if not java_format:
        raise ValueError("a date format is required to parse timestamps")
    v = value
    if " " in java_format:
        v = F.regexp_replace(v, " {2,}", " ")
    return F.try_to_timestamp(v, F.lit(spark_format(java_format)))


def iso_string(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)
