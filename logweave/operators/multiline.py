"""Multi-line records (P9) and the XML field-record job (P10).

Each non-blank line carries a state: START, CONT, END or SKIP (NULL = the classifier failed on the
line, which is then ignored).  The rules of the reference, per file in line order:

* START closes the open buffer (emitting it when non-empty) and opens a new one holding the line's
  fields and ``line_i`` = its line number.
* CONT merges its fields (a later value wins, as ``putAll`` does); END merges and closes.
* SKIP changes nothing; it counts as skipped.
* A buffer is emitted when it is non-empty: it has a START, or some field value.  Lines of a
  closed-but-empty buffer (END with nothing buffered) count as skipped.
* CONT lines before any START form an *orphan* record; it is identified by its own first line.

On Spark, lines with equal ``entry = #START at or before + #END strictly before`` (per file) form
one buffer.  A task sums up each run of consecutive lines that it holds (:func:`_packed`): the records that
begin and end in the run, the open head before the first of them, the open tail after the last.  Records that
are whole stay where they are.  Only heads and tails are shuffled, with their place in the file: the number of
entries in all runs before, summed over a table of one row per run.  Summaries are associative, so any cut of a file
into runs gives the same records; lines that lie in order, as files are read, give two fragments per run of up to
``chunk_lines`` lines.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.plan import materialize
from ..session import keep, prepare

START, CONT, END, SKIP = "START", "CONT", "END", "SKIP"
CHUNK_LINES = 1 << 20
#: Bytes of lines that a task sums up at a time.
CHUNK_BYTES = 32 << 20


def _keep_columns(df: DataFrame, flag: str) -> Column:
    """An aggregate that is always 0 and references every column of ``df`` without evaluating
    them (``flag`` is 0 or 1); it is added to a needed total.  It keeps column pruning from narrowing this branch, so its shuffle is identical to
    the other branch's and Spark reuses it: the input is computed once."""
    never = F.when(F.col(flag) < 0, F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    return F.coalesce(F.max(never), F.lit(0))


def _sort_by_k(items: Column) -> Column:
    return F.array_sort(items, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))


def _fold_maps(sorted_items: Column, field: str) -> Column:
    """The maps of ``sorted_items`` merged in order, a later entry winning: their entries are
    concatenated and one map is built under the session's LAST_WIN key policy."""
    return F.map_from_entries(F.flatten(F.transform(sorted_items[field], F.map_entries)))


def _chunk_parts(lines: DataFrame, state_col: str, fields: list[str], map_col: str | None, text_col: str | None,
                 chunk_lines: int) -> DataFrame:
    """The first level of grouping: one row for each record and chunk of lines, with the record's
    number in its file (``__entry``) and the values merged inside the chunk."""
    st = F.col(state_col)
    base = lines.where(st.isin(START, CONT, END))
    val_cols = [F.col(f"`{f}`").alias(f) for f in fields]
    if map_col:
        val_cols.append(F.col(map_col).alias("__map"))
    if text_col:
        val_cols.append(F.col(text_col).alias("__text"))
    base = base.select(
        "file", "line_num",
        F.floor((F.col("line_num") - 1) / chunk_lines).cast("bigint").alias("__chunk"),
        (st == START).cast("int").alias("__s"),
        (st == END).cast("int").alias("__e"),
        *val_cols,
    )
    w = Window.partitionBy("file", "__chunk").orderBy("line_num")
    ranked = base.select(
        "*",
        F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__s_in"),
        F.coalesce(F.sum("__e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__e_in"),
    )
    # per-chunk totals → rows of earlier chunks of the same file (small table).  Taken from the
    # window's running sums, so both branches read the same (reused) exchange: the input is
    # parsed once.
    per_chunk = ranked.groupBy("file", "__chunk").agg(
        (F.max("__s_in") + _keep_columns(ranked, "__s")).alias("__cs"),
        F.max(F.col("__e_in") + F.col("__e")).alias("__ce"))
    wc = Window.partitionBy("file").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_chunk.select(
        "file", "__chunk",
        (F.coalesce(F.sum("__cs").over(wc), F.lit(0)) + F.coalesce(F.sum("__ce").over(wc), F.lit(0))).alias("__before"),
    )
    # both sides are clustered by (file, __chunk): only the small side moves
    # null-safe keys: an ordinary equi-join makes the optimizer infer IS NOT NULL filters and
    # push them into the two branches differently, which would keep Spark from reusing the shuffle
    p = prefix.select(F.col("file").alias("__pf"), F.col("__chunk").alias("__pc"), "__before")
    keyed = ranked.join(p, F.col("file").eqNullSafe(F.col("__pf")) & F.col("__chunk").eqNullSafe(F.col("__pc")))
    keyed = keyed.drop("__pf", "__pc").withColumn("__entry", F.col("__before") + F.col("__s_in") + F.col("__e_in"))

    # level 1: inside one chunk (no new shuffle)
    def last_value(c: str) -> Column:
        return F.max(F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.col("line_num").alias("k"), F.col(f"`{c}`").alias("v"))))

    agg1 = [
        F.min(F.when(F.col("__s") == 1, F.col("line_num"))).alias("__line_i"),
        F.min("line_num").alias("__first"), F.max("line_num").alias("__last"),
        F.count(F.lit(1)).alias("__n"), F.max("__e").alias("__has_end"),
    ]
    agg1 += [last_value(f).alias(f) for f in fields]
    if map_col:
        agg1.append(_sort_by_k(F.collect_list(F.when(F.col("__map").isNotNull(),
                                                       F.struct(F.col("line_num").alias("k"), F.col("__map").alias("m"))))).alias("__maps"))
    if text_col:
        agg1.append(F.array_sort(F.collect_list(F.when(F.col("__text").isNotNull(),
                                                       F.struct(F.col("line_num").alias("k"), F.col("__text").alias("t"))))).alias("__texts"))
    part = keyed.groupBy("file", "__chunk", "__entry").agg(*agg1)
    part_cols = ["file", "__chunk", "__entry", "__line_i", "__first", "__last", "__n", "__has_end", *[F.col(f"`{f}`") for f in fields]]
    if map_col:
        part_cols.append(F.when(F.size("__maps") > 0, _fold_maps(F.col("__maps"), "m")).alias("__map"))
    if text_col:
        part_cols.append(F.when(F.size("__texts") > 0, F.array_join(F.col("__texts")["t"], "")).alias("__text"))
    return part.select(*part_cols)


def record_pieces(lines: DataFrame, text_col: str, state_col: str = "state", chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """The text of records as ordered pieces, for records too long to be one value: ``file,
    first_line`` (the record's), ``part_no`` and ``text``.  A piece holds what the record has of one chunk
    of lines; the pieces of a record in order are its whole text.  Only line numbers meet across chunks,
    so a file that is one record is still many tasks."""
    part = _chunk_parts(lines, state_col, [], None, text_col, chunk_lines)
    firsts = part.groupBy(F.col("file").alias("__f"), F.col("__entry").alias("__n_entry")).agg(F.min("__first").alias("first_line"))
    out = part.join(firsts, F.col("file").eqNullSafe(F.col("__f")) & (F.col("__entry") == F.col("__n_entry")))
    return out.where(F.col("__text").isNotNull()).select("file", "first_line", F.col("__chunk").alias("part_no"), F.col("__text").alias("text"))


def _pack(n_fields: int, with_map: bool, with_text: bool, chunk_lines: int):
    """Batches of classified lines (file, line_num, state code, fields, entries, text) to one row for each run and
    entry, without a loop over lines: texts and entries of a record are slices of what the batch holds."""

    def pack(table: pa.RecordBatch) -> pa.RecordBatch | None:
        n = table.num_rows
        line, state = (table.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        codes = table.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        breaks = np.ones(n, bool)
        breaks[1:] = (codes[1:] != codes[:-1]) | (line[1:] != line[:-1] + 1)
        run = np.cumsum(breaks) - 1
        begin = np.flatnonzero(breaks)
        starts, ends = np.cumsum(state == 1), np.cumsum(state == 3)
        entry = starts + ends - (state == 3)
        base = (starts + ends - (state == 1) - (state == 3))[begin]  # before the run
        entry = entry - base[run]
        stop = np.concatenate([begin[1:], [n]]) - 1
        steps = (starts + ends)[stop] - base
        known = np.flatnonzero(state > 0)
        if not len(known):
            return None
        k_run, k_entry = run[known], entry[known]
        first = np.ones(len(known), bool)
        first[1:] = (k_run[1:] != k_run[:-1]) | (k_entry[1:] != k_entry[:-1])
        head = np.flatnonzero(first)
        tail = np.concatenate([head[1:], [len(known)]]) - 1
        g_run = k_run[head]
        lead = np.ones(len(head), bool)
        lead[1:] = g_run[1:] != g_run[:-1]
        has_end = state[known[tail]] == 3
        right = np.concatenate([~lead[1:], [False]]) | has_end
        left = k_entry[head] > 0
        line_i = np.where(state[known[head]] == 1, line[known[head]], -1)
        columns = [table.column(0).take(pa.array(known[head])), pa.array(line[begin][g_run], pa.int64()), pa.array(steps[g_run], pa.int64()), pa.array(lead),
                   pa.array(k_entry[head], pa.int64()), pa.array(left & right), pa.array(line_i, pa.int64(), mask=line_i < 0), pa.array(line[known[head]], pa.int64()),
                   pa.array(line[known[tail]], pa.int64()), pa.array(tail - head + 1, pa.int64()), pa.array(has_end)]
        bounds = np.concatenate([head, [len(known)]])
        rows = pa.array(known)
        for i in range(n_fields):  # the last value that is not null
            values = table.column(3 + i).take(rows)
            at = np.maximum.accumulate(np.where(values.is_valid().to_numpy(zero_copy_only=False), np.arange(len(known)), -1))[tail]
            columns.append(values.take(pa.array(at, mask=at < head)))
        if with_map:
            values = table.column(3 + n_fields).take(rows)
            some = np.add.reduceat(values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), head) > 0
            offsets = values.offsets.to_numpy()[bounds]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.concatenate([~some, [False]])), values.values))
        if with_text:
            values = table.column(table.num_columns - 1).take(rows)
            some = np.add.reduceat(values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), head) > 0
            values = values.fill_null("").cast(pa.large_string())
            offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset: values.offset + len(known) + 1][bounds]
            text = pa.LargeStringArray.from_buffers(len(head), pa.py_buffer(offsets.tobytes()), values.buffers()[2]).cast(pa.string())
            columns.append(pc.if_else(pa.array(some), text, pa.scalar(None, pa.string())))
        return pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])

    def run(batches):
        held, rows, size = [], 0, 0

        def whole():
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, chunk_lines - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows, size = rows + part.num_rows, size + part.nbytes
                if rows >= chunk_lines or size >= CHUNK_BYTES:
                    out = pack(whole())
                    if out is not None:
                        yield out
                    held, rows, size = [], 0, 0
        if rows:
            out = pack(whole())
            if out is not None:
                yield out

    return run


_RUN_COLUMNS = ("file", "__run", "__steps", "__lead", "__entry", "__whole", "line_i", "first_line", "last_line", "n_lines", "has_end")


def _packed(lines: DataFrame, state_col: str, fields: list[str], map_col: str | None, text_col: str | None, chunk_lines: int) -> DataFrame:
    """One row for each run of lines and entry in it, kept (:func:`logweave.session.keep`), as several parts of
    the plan read it and the lines are to be parsed once."""
    st = F.col(state_col)
    code = F.when(st == START, 1).when(st == CONT, 2).when(st == END, 3).otherwise(0).cast("int")
    columns = [F.col("file"), F.col("line_num").cast("bigint"), code.alias("__state"), *[F.col(f"`{f}`") for f in fields]]
    if map_col:
        columns.append(F.map_entries(F.col(map_col)).alias("__entries"))
    if text_col:
        columns.append(F.col(text_col).cast("string").alias("__text"))
    base = lines.select(*columns)
    types = {f.name: f.dataType for f in base.schema.fields}
    kinds = ["string", "bigint", "bigint", "boolean", "bigint", "boolean", "bigint", "bigint", "bigint", "bigint", "boolean"]
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(_RUN_COLUMNS, kinds)])
    schema = T.StructType([*schema.fields, *[T.StructField(f"__f{i}", types[f]) for i, f in enumerate(fields)]])
    if map_col:
        schema = schema.add("__entries", types["__entries"])
    if text_col:
        schema = schema.add("__text", "string")
    return keep(base.mapInArrow(_pack(len(fields), bool(map_col), bool(text_col), max(1, min(chunk_lines, CHUNK_LINES))), schema))


def assemble_records(lines: DataFrame, state_col: str = "state", fields: list[str] = (),
                     map_col: str | None = None, text_col: str | None = None,
                     chunk_lines: int = CHUNK_LINES, keep_empty: bool = False) -> DataFrame:
    """Group classified lines into records.

    ``lines``: ``file, line_num, <state_col>`` plus the value columns.
    ``fields``: scalar columns merged by "last non-NULL value in line order wins".
    ``map_col``: a ``MAP<STRING,STRING>`` merged key by key, later value wins.
    ``text_col``: string pieces concatenated in line order (e.g. a message and its continuation
    lines); NULL pieces are skipped.

    Output: ``file, line_i`` (START line, NULL for an orphan), ``first_line, last_line,
    n_lines`` (START/CONT/END lines), ``has_end, orphan``, the merged columns and, with
    ``keep_empty``, also non-emitted buffers (``emitted`` false) for the statistics.

    The packed lines are kept by Spark until :func:`logweave.session.release` or the end of the application.
    """
    if map_col:
        prepare(lines.sparkSession)  # LAST_WIN policy for merging maps
    fields = list(fields)
    packed = _packed(lines, state_col, fields, map_col, text_col, chunk_lines)
    values = [f"__f{i}" for i in range(len(fields))] + (["__entries"] if map_col else []) + (["__text"] if text_col else [])
    facts = ["file", "line_i", "first_line", "last_line", "n_lines", "has_end"]

    # heads and tails: the entries of all runs before give a record's number in its file
    earlier = Window.partitionBy("file").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = packed.filter("__lead").select(F.col("file").alias("__rf"), F.col("__run").alias("__rr"), F.coalesce(F.sum("__steps").over(earlier), F.lit(0)).alias("__before"))
    parts = packed.filter(~F.col("__whole")).join(runs, F.col("file").eqNullSafe(F.col("__rf")) & (F.col("__run") == F.col("__rr")))
    parts = parts.withColumn("__no", F.col("__before") + F.col("__entry"))

    def in_order(c: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col("__run").alias("k"), F.col(c).alias("v")))))["v"]

    merged = [F.min("line_i").alias("line_i"), F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"),
              F.sum("n_lines").alias("n_lines"), F.bool_or("has_end").alias("has_end")]
    merged += [F.max(F.when(F.col(f"__f{i}").isNotNull(), F.struct(F.col("__run").alias("k"), F.col(f"__f{i}").alias("v"))))["v"].alias(f"__f{i}") for i in range(len(fields))]
    if map_col:
        entries = F.collect_list(F.when(F.col("__entries").isNotNull(), F.struct(F.col("__run").alias("k"), F.col("__entries").alias("v"))))
        merged.append(F.when(F.size(entries) > 0, F.flatten(_sort_by_k(entries)["v"])).alias("__entries"))
    if text_col:
        merged.append(F.when(F.size(in_order("__text")) > 0, F.array_join(in_order("__text"), "")).alias("__text"))
    rec = packed.filter("__whole").select(*facts, *values).unionByName(parts.groupBy("file", "__no").agg(*merged).select(*facts, *values))

    out_cols = [*facts, F.col("line_i").isNull().alias("orphan"), *[F.col(f"__f{i}").alias(f) for i, f in enumerate(fields)]]
    nonempty = F.col("line_i").isNotNull()
    for i in range(len(fields)):
        nonempty = nonempty | F.col(f"__f{i}").isNotNull()
    if map_col:
        out_cols.append(F.map_from_entries("__entries").alias(map_col))
        nonempty = nonempty | (F.coalesce(F.size("__entries"), F.lit(0)) > 0)
    if text_col:
        out_cols.append(F.col("__text").alias(text_col))
        nonempty = nonempty | F.col("__text").isNotNull()
    out = rec.select(*out_cols, nonempty.alias("emitted"))
    return out if keep_empty else out.where("emitted").drop("emitted")


# ---------------------------------------------------------------------------------------------
# XML field records (P10)

# The XML record markers of the reference's XML parser.
XML_DOC_START = "<doc>"
XML_DOC_END = "</doc>"
XML_FIELD_PREFIX = '<field name="'
XML_FIELD_SUFFIX = "</field>"
_XML_FIELD = r'^<field name="([^"]*)"(?s:.)((?s:.)*)</field>$'


def classify_xml(line: Column) -> tuple[Column, Column]:
    """(state, {name: value}) for one trimmed line.  A field line whose inner text cannot be
    split (no closing quote) is a parse failure: state NULL, the line is ignored."""
    fixed = F.replace(line, F.lit('name = "'), F.lit('name="'))
    is_field = fixed.startswith(XML_FIELD_PREFIX) & fixed.endswith(XML_FIELD_SUFFIX)
    ok = fixed.rlike(_XML_FIELD)
    key = F.regexp_extract(fixed, _XML_FIELD, 1)
    val = F.regexp_extract(fixed, _XML_FIELD, 2)
    state = (F.when(line.startswith(XML_DOC_START), F.lit(START))
             .when(line.startswith(XML_DOC_END), F.lit(END))
             .when(is_field & ok, F.lit(CONT))
             .when(is_field, F.lit(None).cast("string"))
             .otherwise(F.lit(SKIP)))
    fields = F.when(state == CONT, F.create_map(key, val))
    return state, fields


def xml_field_docs(lines: DataFrame, chunk_lines: int = CHUNK_LINES, keep_empty: bool = False) -> DataFrame:
    """``<doc>`` … ``</doc>`` blocks of ``<field name="k">v</field>`` lines → ``(file, line_i,
    fields MAP<STRING,STRING>)``; input lines must be trimmed and non-blank."""
    state, fields = classify_xml(F.col("line"))
    parsed = materialize(lines.select("file", "line_num", "line"), "__x",
                         F.struct(state.alias("state"), fields.alias("fields")))
    classified = parsed.select("file", "line_num", "__x.state", "__x.fields")
    return assemble_records(classified, map_col="fields", chunk_lines=chunk_lines, keep_empty=keep_empty)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed
