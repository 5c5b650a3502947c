"""Exact row numbers inside (possibly huge) groups without ordering a whole group in one task.

``row_number() over (partition by key order by o)`` sorts each key group in a single task, which
breaks when one key holds a large share of all rows.  Here the order column is cut into bounded
chunks: rows are numbered inside ``(key, chunk)`` and offset by the row counts of earlier chunks
of the same key, which come from a small per-chunk table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chunked_row_number(df: DataFrame, keys: list[str], order_col: str, chunk_width: int = 1 << 16,
                       out_col: str = "rn") -> DataFrame:
    """Add ``out_col`` = 1-based position of the row inside its key group, ordered by the
    integer column ``order_col`` (must be unique inside a group).  Rows with a NULL key are a group
    of their own; rows with a NULL order value come first in their group, in any order."""
    keys = list(keys)
    chunk = F.floor(F.col(order_col) / F.lit(chunk_width)).cast("bigint")
    staged = df.withColumn("__chunk", chunk)
    w = Window.partitionBy(*keys, "__chunk").orderBy(order_col)
    ranked = staged.withColumn("__rn_in", F.row_number().over(w))
    # from the window's output, so the input is computed once (the exchange is reused)
    # always 0, but references every column: this branch keeps the window branch's shuffle, which
    # Spark then reuses instead of computing the input twice
    keep = F.coalesce(F.max(F.when(F.col("__rn_in") < 0, F.length(F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in ranked.columns]))))), F.lit(0))
    per_chunk = ranked.groupBy(*keys, "__chunk").agg((F.max("__rn_in") + keep).alias("__n"))
    wc = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    names = {c: f"__p_{i}" for i, c in enumerate([*keys, "__chunk"])}
    prefix = per_chunk.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()],
                              F.coalesce(F.sum("__n").over(wc), F.lit(0)).alias("__before"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in names.items()]
    out = ranked.join(prefix, reduce(lambda a, b: a & b, same))
    return out.withColumn(out_col, (F.col("__before") + F.col("__rn_in")).cast("bigint")).drop(
        "__chunk", "__rn_in", "__before", *names.values())
