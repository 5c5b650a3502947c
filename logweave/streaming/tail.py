"""Follow growing files (T2) and flush open multi-line records of idle files (T3).

The streaming file source never re-reads a file that grew, so tailing is an incremental batch
job over a table of what was read of each file, kept in the shared state folder:

* every run lists the matching files; those with another size or time than stored, and new ones, are
  looked at.  A file whose first block and whose last consumed block are still what they were has
  grown: it is read on from its byte position, nothing before it is opened.  Otherwise its name now
  belongs to another file, which is read from its start, whatever its size;
* what was read of a file that is gone from its name is looked up among the new files by the same
  hashes: a file that was renamed (``a.log`` to ``a.log.1``), or copied before it was cut, is read on
  from its position and not again.  For lines written just before a rotation, ``match`` has to include the
  new name;
* only lines that end in a separator are taken: a partly written last line waits for the next run;
* for multi-line jobs the open record at the end of a file (after its last START) is held back
  until a later run sees the next record start, or the file has not changed for ``idle_seconds``;
  then it is emitted (the reference never emits it in tail mode; we flush on idle).  Its position is
  stored, so only the record itself is read and classified again.  :mod:`logweave.streaming.records` keeps
  open records in streaming state instead;
* the limits of a run are written before its job sees a line, and become the new version of the
  table only after the job's sink returned, so a failed run is simply repeated (at-least-once, with
  stable ids).

Listings, limits and positions stay tables; nothing is gathered on the driver.  Schedule ``tail_once`` every few
seconds (a loop, or a ``rate`` stream with ``foreachBatch``)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.multiline import START
from ..session import checkpoint_dir, scratch_path
from ..sources import ranges
from ..sources.files import DEFAULT_MATCH, _per_file, delete_path, latest_version, list_sources

OFFSETS_SCHEMA = ("file string, last_line bigint, size bigint, mtime timestamp, open boolean, "
                  "position bigint, prefix int, head string, tail string")
_STATE = [c.split()[0] for c in OFFSETS_SCHEMA.split(", ")]
#: Versions of the table that stay, the newest included.
KEEP_VERSIONS = 3


def read_offsets(spark: SparkSession, state_dir: str) -> tuple[DataFrame, int]:
    v = latest_version(spark, state_dir)
    if v is None:
        return spark.createDataFrame([], OFFSETS_SCHEMA), 0
    return spark.read.schema(OFFSETS_SCHEMA).parquet(f"{state_dir}/v={v}"), v


def identify(files: DataFrame, known: DataFrame, opener: ranges.Opener | None = None) -> DataFrame:
    """What has been read of each of ``files`` (file, uri, size, mtime): those columns with ``same`` (size and time are
    as stored) and the stored ``position``, ``last_line``, ``open`` and ``was`` (the name under which it was read),
    null for a file of which nothing was read.

    A stored position belongs to the file of the stored name, if size and time, or else the hashes agree; if not, to a
    file that is new or was replaced and has the hashes, the one read farthest first.  One stored position is
    used for one file, and one file uses one."""
    old = known.select(*[F.col(c).alias(f"k_{c}") for c in _STATE])
    alike = F.coalesce((F.col("size") == F.col("k_size")) & (F.col("mtime") == F.col("k_mtime")), F.lit(False))
    both = files.join(old, F.col("file") == F.col("k_file"), "left").withColumn("same", alike).checkpoint()
    named = F.col("k_file").isNotNull()
    n_same, n_named, n_all = both.agg(F.coalesce(F.sum(F.col("same").cast("int")), F.lit(0)), F.coalesce(F.sum(named.cast("int")), F.lit(0)), F.count("*")).first()
    facts = ["file", "uri", "size", "mtime"]
    taken = [F.col("k_position").alias("position"), F.col("k_last_line").alias("last_line"), F.col("k_open").alias("open"), F.col("k_file").alias("was")]
    kept = both.filter("same").select(*facts, "same", *taken)
    if n_same == n_all:
        return kept
    fresh = both.filter(~named).select(*facts)
    replaced = None
    if n_named > n_same:
        judged = ranges.with_prints(both.filter(~F.col("same") & named).withColumn("position", F.col("k_position")), opener)
        agrees = F.coalesce((F.col("prefix") == F.col("k_prefix")) & (F.col("head") == F.col("k_head")) & (F.col("tail") == F.col("k_tail")), F.lit(False))
        judged = judged.withColumn("grown", agrees).drop("position", "prefix", "head", "tail").checkpoint()
        kept = kept.unionByName(judged.filter("grown").select(*facts, "same", *taken))
        replaced = judged.filter("not grown")
        fresh = fresh.unionByName(replaced.select(*facts))
    # positions without a file under their name
    lost = old.join(files.select(F.col("file").alias("f")), F.col("k_file") == F.col("f"), "left_anti")
    lost = (lost if replaced is None else lost.unionByName(replaced.select(*lost.columns))).filter("k_prefix > 0").checkpoint()
    if lost.isEmpty():
        return kept.unionByName(_unread(fresh))
    moved = ranges.beginnings(fresh, opener).withColumnsRenamed({"prefix": "b_prefix", "head": "b_head"})
    moved = moved.join(lost, (F.col("b_prefix") == F.col("k_prefix")) & (F.col("b_head") == F.col("k_head")) & (F.col("size") >= F.col("k_position")))
    moved = ranges.with_prints(moved.drop("b_prefix", "b_head").withColumn("position", F.col("k_position")), opener)
    moved = moved.filter((F.col("tail") == F.col("k_tail")) & (F.col("head") == F.col("k_head"))).select(F.col("file").alias("m_file"), *lost.columns)
    far = Window.partitionBy("m_file").orderBy(F.desc("k_position"), "k_file")
    once = Window.partitionBy("k_file").orderBy("m_file")
    moved = moved.withColumn("r", F.row_number().over(far)).filter("r = 1").withColumn("r", F.row_number().over(once)).filter("r = 1").drop("r")
    fresh = fresh.join(moved, F.col("file") == F.col("m_file"), "left")
    return kept.unionByName(fresh.select(*facts, F.lit(False).alias("same"), *taken))


def _unread(files: DataFrame) -> DataFrame:
    """Files of which nothing was read, with the columns of :func:`identify`."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("position", "bigint"), ("last_line", "bigint"), ("open", "boolean"), ("was", "string"))]
    return files.select("file", "uri", "size", "mtime", F.lit(False).alias("same"), *nothing)


def tail_once(spark: SparkSession, path: str, handler: Callable[[DataFrame], None], state_dir: str | None = None,
              match: str | None = DEFAULT_MATCH, classify: Callable[[DataFrame], DataFrame] | None = None,
              idle_seconds: float = 120.0, now: float | None = None, charset: str = "UTF-8",
              line_sep: str = "\n", opener: ranges.Opener | None = None) -> DataFrame:
    """One tailing step.  ``handler(new_lines)`` receives ``(file, line_num, line)`` of the new
    complete lines; with ``classify`` (a function adding a ``state`` column to lines, as the
    multi-line jobs do) lines of a still-open record are held back as described above.
    ``charset`` is one whose lines can be found from any place (:func:`logweave.sources.ranges.supported`), else
    ``ValueError``; gzip files cannot be tailed and are passed over.  ``opener`` opens files of other stores.
    Returns the new table (``OFFSETS_SCHEMA``)."""
    if not ranges.supported(charset, line_sep):
        raise ValueError(f"lines in {charset!r} with separator {line_sep!r} cannot be found from the middle of a file; use read_log_lines")
    checkpoint_dir(spark)
    state_dir = (state_dir or scratch_path(spark, "tail-offsets")).rstrip("/")
    offsets, version = read_offsets(spark, state_dir)
    now_ts = F.lit(now if now is not None else time.time())
    files = list_sources(spark, path, match).filter(~F.col("uri").endswith(".gz")).checkpoint()
    files = identify(files, offsets, opener) if version else _unread(files)
    files = files.withColumn("idle", (now_ts - F.col("mtime").cast("double")) >= F.lit(idle_seconds))
    due = ~F.col("same")
    if classify is not None:
        due = due | (F.coalesce("open", F.lit(False)) & F.col("idle"))
    files = files.withColumn("due", due).withColumn("start", F.coalesce("position", F.lit(0).cast("bigint"))).checkpoint()
    if files.filter("due").isEmpty():
        return offsets
    asked = files.filter("due").select("file", "uri", "size", "start", F.coalesce("last_line", F.lit(0)).cast("bigint").alias("base"))
    cells = ranges.cut_cells(asked.filter("start < size"), line_sep).checkpoint()
    total = cells.agg(F.count("*"), F.coalesce(F.sum(F.least("stop", "size") - F.col("start")), F.lit(0))).first()
    tasks = max(1, ranges._tasks(spark, total[0], total[1]))
    counts = ranges.count_cells(cells, charset, line_sep, opener, tasks).withColumnsRenamed({"file": "cf", "start": "cs"})
    counted = cells.join(counts, (F.col("file") == F.col("cf")) & (F.col("start") == F.col("cs"))).drop("cf", "cs")
    numbered = ranges.number_cells(counted, F.col("base")).checkpoint()
    # a last line without its separator waits
    ends = numbered.groupBy("file").agg((F.max(F.col("before") + F.col("n") - F.when(F.col("ended"), 0).otherwise(1))).alias("n_line"), F.max("upto").alias("upto"))
    limit = asked.join(ends.withColumnRenamed("file", "ef"), F.col("file") == F.col("ef"), "left")
    limit = limit.select("file", "base", F.coalesce("n_line", "base").alias("last"), F.coalesce("upto", "start").alias("position"))
    limit = limit.join(files.select(F.col("file").alias("ff"), "uri", "size", "mtime", "idle"), F.col("file") == F.col("ff")).drop("ff")
    held = F.lit(False)
    if classify is not None:
        whole = numbered.join(limit.select(F.col("file").alias("lf"), "last"), F.col("file") == F.col("lf")).drop("lf").filter("n > 0")
        lines = ranges.read_cells(whole, charset, line_sep, opener, tasks)
        starts = classify(lines).where(F.col("state") == START)
        if "pos" not in starts.columns:
            starts = starts.select("file", "line_num").join(lines.select(F.col("file").alias("pf"), F.col("line_num").alias("pl"), "pos"),
                                                            (F.col("file") == F.col("pf")) & (F.col("line_num") == F.col("pl")))
        starts = starts.groupBy(F.col("file").alias("sf")).agg(F.max(F.struct("line_num", "pos")).alias("s"))
        limit = limit.join(starts, F.col("file") == F.col("sf"), "left").drop("sf")
        # hold back the open record (from the last START) unless the file is idle
        held = ~F.col("idle") & F.col("s").isNotNull()
        limit = limit.withColumn("last", F.when(held, F.col("s.line_num") - 1).otherwise(F.col("last")))
        limit = limit.withColumn("position", F.when(held, F.col("s.pos")).otherwise(F.col("position")))
    limit = ranges.with_prints(limit.select("file", "uri", "base", "last", "size", "mtime", held.alias("open"), "position"), opener)
    # the limits are fixed before the handler runs: what it gets and what is stored next are the same
    run = f"{state_dir}/limits/{version + 1}-{uuid.uuid4().hex}"
    limit.write.parquet(f"{run}/limits")
    limits = spark.read.parquet(f"{run}/limits")
    mine = limits.select(F.col("file").alias("lf"), F.col("base").alias("after"), "last")
    wanted = numbered.join(_per_file(mine), F.col("file") == F.col("lf")).drop("lf").filter("before < last and before + n > after")
    handler(ranges.read_cells(wanted, charset, line_sep, opener, tasks).select("file", "line_num", "line"))
    stored = limits.withColumn("last_line", F.col("last")).select(*_STATE)
    rest = files.filter("not due").select("file", "size", "mtime", "was")
    rest = rest.join(offsets.select(F.col("file").alias("of"), *[c for c in _STATE if c not in ("file", "size", "mtime")]), F.col("was") == F.col("of")).select(*_STATE)
    stored.unionByName(rest).write.mode("overwrite").parquet(f"{state_dir}/v={version + 1}")
    delete_path(spark, run)
    if version + 1 > KEEP_VERSIONS:
        delete_path(spark, f"{state_dir}/v={version + 1 - KEEP_VERSIONS}")
    return spark.read.schema(OFFSETS_SCHEMA).parquet(f"{state_dir}/v={version + 1}")
