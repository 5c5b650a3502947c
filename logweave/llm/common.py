"""What several operators share: cutting lineage, joining a small table, extra columns."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.session import checkpoint_dir

#: A table is broadcast only after its rows were counted and are no more than this (a few MB).
BROADCAST_ROWS = 50_000
#: Copies of the small table in the join that does not broadcast, so that one key is many tasks.
SALTS = 16
#: What separates words; a word is a run of anything else.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder of ``spark.checkpoint.dir``: a lost
    executor costs no recomputation, and later uses read the rows back."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()
#: Rows of an Arrow batch of whole texts, where the session has not set its own number.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), as ``--py-files`` would.  The archive
    lies on the driver, from where Spark serves it; no data is kept there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="py-files-"), "logweave_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, with batches that fit whole texts."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's own default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that carry one of ``names`` (in any case), to make room for new ones."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def extended(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` followed by new nullable ``fields`` (name=type)."""
    new = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    return T.StructType(list(df.schema.fields) + list(new.fields))


def attach(left: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "left", rows: int | None = None) -> DataFrame:
    """Null-safe join of a cut, much smaller table.  Up to ``BROADCAST_ROWS`` counted rows are
    broadcast; a larger table is joined by shuffle, with ``spread`` (any hash of the left row) as
    salt, so that a key with a third of the rows still reaches many tasks.  ``rows`` is the count of
    ``small``, where it is known."""
    if (small.count() if rows is None else rows) <= BROADCAST_ROWS:
        salted, right, extra = left, small, []
        hint = F.broadcast
    else:
        salted = left.withColumn("_salt", F.pmod(spread, F.lit(SALTS)).cast("int"))
        right = small.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        extra = ["_salt"]
        hint = lambda d: d
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[F.col("_salt_r").alias("_r__salt") for _ in extra],
                         *[c for c in small.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys + extra]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return salted.join(hint(right), cond, how).drop(*[f"_r_{k}" for k in keys + extra], *extra)


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (null: 0): every word becomes one letter, separators go."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.translate(marks, SPACES, "")).cast("long")
