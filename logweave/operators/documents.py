"""Records → documents ``{id, fields: [{name, value}]}`` (D1-D3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import file_line_id

# bookkeeping columns of our jobs that are not record fields
SYSTEM_COLUMNS = ("file", "line_num", "line", "_matched", "first_line", "last_line", "n_lines", "has_end",
                  "orphan", "emitted", "state")


def _as_variant(c: Column, dtype: str) -> Column:
    """The value with its own type (a JSON null is no value)."""
    if dtype == "variant":
        return F.when(~F.is_variant_null(c), c)
    if dtype.startswith(("struct<", "map<", "array<")):
        return F.to_variant_object(c)
    return c.cast("variant")


def _as_string(c: Column, dtype: str) -> Column:
    if dtype == "string":
        return c
    if dtype == "variant":
        return F.try_variant_get(c, "$", "string")
    return c.cast("string")


def record_line(df: DataFrame) -> Column:
    """Line number used in ids: a record's own ``line_i`` (when it reads as a number), else the
    first line of an orphan multi-line record, else ``line_num``."""
    cands = []
    if "line_i" in df.columns:
        cands.append(F.col("line_i").cast("string").try_cast("bigint"))
    if "first_line" in df.columns:
        cands.append(F.col("first_line"))
    if "line_num" in df.columns:
        cands.append(F.col("line_num"))
    return F.coalesce(*cands)


def to_documents(records: DataFrame, id_field: str = "id", fields: list[str] | None = None,
                 map_cols: list[str] | None = None, keep_source: bool = True,
                 keep: list[str] | None = None, typed: bool = False) -> DataFrame:
    """One document per record.

    ``id``: the record's ``id_field`` value when not NULL, else ``file:line``.  ``fields``: one
    ``{lower(name), value}`` per non-NULL value (columns, then map entries; a map entry replaces a
    column of the same name), sorted by name; a record with its own id also gets
    ``_src_ = file:line``.  Values are strings (variants: their JSON text or scalar text).
    With ``typed`` values are variants: numbers, booleans and nested values stay what they are.
    ``keep``: columns carried along next to the document (a batching key, an order).
    """
    dtypes = dict(records.dtypes)
    if map_cols is None:
        map_cols = [c for c, t in records.dtypes if t.startswith("map<") and c not in SYSTEM_COLUMNS]
    if fields is None:
        fields = [c for c in records.columns if c not in SYSTEM_COLUMNS and c not in map_cols
                  and not c.startswith("__")]
    entry = "struct<name:string,value:variant>" if typed else "struct<name:string,value:string>"
    as_value = _as_variant if typed else _as_string
    empty = F.array().cast(f"array<{entry}>")
    # without map columns names need no de-duplication, so they are lower-cased right here
    col_entries = [F.struct(F.lit(f if map_cols else f.lower()).alias("name"),
                            as_value(F.col(f"`{f}`"), dtypes[f]).alias("value"))
                   for f in fields]
    arr = F.filter(F.array(*col_entries).cast(f"array<{entry}>") if col_entries else empty,
                   lambda e: e["value"].isNotNull())
    for m in map_cols:
        vt = dtypes[m][len("map<string,"):-1]
        ents = F.filter(F.coalesce(F.transform(F.map_entries(F.col(m)), _entry_fn(vt, as_value)), empty),
                        lambda e: e["value"].isNotNull())
        arr = F.concat(arr, ents)

    line = record_line(records)
    src = file_line_id(F.col("file"), line)
    own_id = _own_id(records, id_field, fields, map_cols, dtypes)
    kept = [c for c in ("file",) if c in records.columns]
    kept += [c for c in keep or [] if c not in kept]
    staged = records.select(F.coalesce(own_id, src).alias("id"), own_id.isNotNull().alias("__own"),
                            src.alias("__src"), arr.alias("__arr"),
                            *[F.col(f"`{c}`") for c in kept])
    arr = F.col("__arr")
    if map_cols:
        # a later entry (a map entry) replaces an earlier one of the same name
        rev = F.reverse(arr)
        names = F.transform(rev, lambda e: e["name"])
        arr = F.filter(rev, lambda e, i: F.array_position(names, e["name"]) == i + 1)
    lowered = F.transform(arr, lambda e: F.struct(F.lower(e["name"]).alias("name"), e["value"].alias("value"))) \
        if map_cols else arr
    if keep_source:
        lowered = F.when(F.col("__own"), F.concat(lowered, F.array(F.struct(
            F.lit("_src_").alias("name"), as_value(F.col("__src"), "string").alias("value"))))).otherwise(lowered)
    # (name, value) structs sort by name first: the natural order, no comparator lambda
    if typed:  # variants have no order of their own
        in_order = F.array_sort(lowered, lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    else:
        in_order = F.array_sort(lowered)
    return staged.select("id", in_order.alias("fields"),
                         *[F.col(f"`{c}`") for c in kept])


def _entry_fn(vt: str, as_value):
    def fn(e):
        return F.struct(e["key"].alias("name"), as_value(e["value"], vt).alias("value"))
    return fn


def _own_id(records, id_field, fields, map_cols, dtypes) -> Column:
    if id_field in fields:
        return _as_string(F.col(f"`{id_field}`"), dtypes[id_field])
    for m in map_cols:
        vt = dtypes[m][len("map<string,"):-1]
        return _as_string(F.col(m)[id_field], vt)
    return F.lit(None).cast("string")


def explode_documents(docs: DataFrame) -> DataFrame:
    """``(id, name, value)`` rows, one per document field."""
    return docs.select("id", F.inline("fields"))


def preview_documents(docs: DataFrame) -> DataFrame:
    """Parse-only mode: each document as pretty JSON text (for ``show``/logs; nothing is sent)."""
    return docs.select("id", F.to_json(F.struct("id", "fields"), {"pretty": "true"}).alias("json"))
