"""Directory of log files → ``lines(file, line_num, line)``.

Line numbers are exact and 1-based even when a plain text file is split over many tasks, and the
line text is never shuffled:

* ``m = monotonically_increasing_id()`` is taken right after the scan.  Inside one file split it
  is consecutive, because a task reads its splits one after the other.
* A small table with one row per split ``(file, block_start) → (rows, min m)`` is computed and
  written to the shared checkpoint folder, and the rows of earlier splits of the same file are prefix-summed over that
  small table only.
* ``line_num = m − min_m + 1 + rows in earlier splits``.  The split table holds numbers only
  (file hash, block, id range, offset; about 40 bytes a split) and is joined back with a
  broadcast when its counted size is below ``broadcast_rows``; beyond that a shuffle join is used
  instead, so the plan never broadcasts a table whose size is unchecked.

The two passes must see the same splits.  The split settings that follow the number of cores are
pinned for the session when lines are numbered, and a line whose split is not in the table (because
the settings or the files changed in between) raises an error: it is never left out.

Gzip files are read by the text source's codec (one task per file, as gzip cannot be split).
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from . import ranges

DEFAULT_MATCH = "*.log"
SPLIT_BROADCAST_ROWS = 1_000_000
# per-file tables (manifest, offsets) are broadcast after counting no more rows than this
PER_FILE_ROWS = 100_000
# a micro-batch of no more files than this is numbered by a split table that passes through the driver
FEW_FILES = 1_000
# Charsets whose bytes 0x00-0x7F are ASCII: lines can be split on b"\n" before decoding.
_ASCII_COMPATIBLE = re.compile(r"^(utf-?8|us-ascii|ascii|iso-8859-\d+|latin-?1|windows-125\d|cp125\d)$", re.I)


_split_tables: dict[str, list[str]] = {}


class NoInputFiles(FileNotFoundError):
    pass


def match_regex(match: str | None) -> str | None:
    """The file-name rule of the reference: ``*`` matches all, ``*.x`` becomes ``^.*?\\.x$``
    (``x`` itself is used as regex), anything else is a regex over the whole name."""
    if match is None or match == "*":
        return None
    if match.startswith("*."):
        return r"^.*?\." + match[2:] + "$"
    return "^(?:" + match + ")$"


def _simple_glob(match: str | None) -> str | None:
    if match and match.startswith("*.") and re.fullmatch(r"[A-Za-z0-9_-]+", match[2:]):
        return match
    return None


_RULE_PART = re.compile(r"(?P<text>[A-Za-z0-9_ -]|\\[.+()$%-])(?P<many>[*+?]?)|(?P<set>\[[A-Za-z0-9]+\])(?P<more>[*+?]?)|(?:\.|\\[dDwWsS])[*+?]?")


def listing_glob(match: str | None) -> str | None:
    """A glob that every name which fits the rule also fits, so that a listing passes over most of the others; None
    where the rule has more than characters, ``.``, classes, plain sets and ``* + ?``."""
    if match is None or match == "*" or match.startswith("*."):
        return _simple_glob(match)
    out, at = [], 0
    while at < len(match):
        part = _RULE_PART.match(match, at)
        if not part:
            return None
        text = part["set"] or (part["text"] or "")[-1:]
        out.append("*" if not text or part["many"] or part["more"] else text)
        at = part.end()
    return re.sub(r"\*+", "*", "".join(out)) or None


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def listed_paths(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """The paths below ``folder`` that fit ``glob``, from one call of the driver's: for names without line breaks."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(re.sub(r"([\\*?\[\]{}])", r"\\\1", folder.rstrip("/")) + "/" + glob)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(fs, hpath).mkString("\n").splitlines()


def scan_lines(spark: SparkSession, paths: str | list[str], match: str | None = DEFAULT_MATCH,
               charset: str = "UTF-8", line_sep: str = "\n", processed: DataFrame | None = None,
               line_sep_regex: str | None = None) -> DataFrame:
    """Raw scan by Spark's own readers: ``(file, block, m, line)`` with ``m`` consecutive inside each split.

    Files are filtered by name at listing time (``pathGlobFilter``) when the rule is a plain
    extension, otherwise by a ``_metadata.file_name`` predicate, which Spark also applies while
    listing files.  A manifest of processed files is applied to the lines here; :func:`read_log_lines`
    applies it to the listing wherever tasks can open the files.
    """
    paths = _existing(spark, paths)
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", line_sep)
    glob = _simple_glob(match)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if line_sep_regex is not None or not _cut_before_decoding(charset):
        out = _scan_whole_files(spark, paths, match, charset, line_sep, line_sep_regex)
        return skip_processed(out, processed) if processed is not None else out
    df = reader.text(paths)
    rx = match_regex(match) if not glob else None
    if rx:
        df = df.filter(_file_col(F.col("_metadata.file_name")).rlike(rx))
    text = F.col("value")
    if charset.lower().replace("-", "") not in ("utf8", "usascii", "ascii"):
        # the text source keeps the raw bytes of each line; decode them with the file's charset
        text = F.decode(F.col("value").cast("binary"), charset)
    out = df.select(
        _file_col(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("m"),
        text.alias("line"),
    )
    return skip_processed(out, processed) if processed is not None else out


def _cut_before_decoding(charset: str) -> bool:
    return bool(_ASCII_COMPATIBLE.match(charset)) or charset.lower().replace("-", "") == "utf8"


def _existing(spark: SparkSession, paths: str | list[str]) -> list[str]:
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        if not path_exists(spark, p):
            raise FileNotFoundError(f"log directory does not exist: {p}")
    return paths


def latest_version(spark: SparkSession, state_dir: str) -> int | None:
    """The newest complete version of a table kept as ``v=1``, ``v=2``, ... below ``state_dir``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    versions = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            versions.append(int(name[2:]))
    return max(versions) if versions else None


def list_sources(spark: SparkSession, paths: str | list[str], match: str | None = DEFAULT_MATCH) -> DataFrame:
    """``(file, uri, size, mtime)`` of the matching files that are not empty, as Spark lists them: a table
    that stays on the executors.  Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    glob = _simple_glob(match)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(paths)
    rx = match_regex(match) if not glob else None
    if rx:
        df = df.filter(_file_col(F.col("_metadata.file_name")).rlike(rx))
    uri = F.col("_metadata.file_path")
    return df.select(_file_col(uri).alias("file"), uri.alias("uri"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")).filter("size > 0")


def _opened_by_tasks(spark: SparkSession, paths: list[str]) -> bool:
    """Whether tasks can open the files below ``paths`` by themselves (see :mod:`logweave.sources.ranges`)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return all(jvm.org.apache.hadoop.fs.Path(p).getFileSystem(conf).getUri().getScheme() in ranges.SCHEMES for p in paths)


def _file_col(uri):
    """The file's path as the reference reports it: percent-escapes of the URI decoded ('+' is a
    literal plus in a URI, so it is protected from form decoding), and for local files without
    the ``file:`` scheme.  Other schemes keep their scheme and authority."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^file:(//)?(?=/)", "")


#: :func:`_file_col` in SQL.
FILE_OF = "regexp_replace(url_decode(replace({}, '+', '%2B')), '^file:(//)?(?=/)', '')"


def _scan_whole_files(spark, paths, match, charset, line_sep, line_sep_regex=None) -> DataFrame:
    """Charsets that are not ASCII-compatible (e.g. UTF-16), or a delimiter given as a regex (the
    reference's delimiter is a regex): decompress ``.gz``, decode each file whole, then split.  A
    file is one row here, so this path is bounded by the largest file (2 GB per value, in full)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    glob = _simple_glob(match)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(paths)
    rx = match_regex(match) if not glob else None
    if rx:
        df = df.filter(_file_col(F.col("_metadata.file_name")).rlike(rx))
    packed = F.col("path").endswith(".gz")
    df = df.select("path", "content")
    # two branches: the contents of plain files do not pass through Python
    df = df.filter(~packed).unionByName(df.filter(packed).withColumn("content", _gunzip()(F.col("content"))))
    text = F.decode(F.col("content"), charset)
    parts = F.split(text, line_sep_regex if line_sep_regex is not None else re.escape(line_sep), -1)
    # a trailing separator does not start another line
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    exploded = df.select(_file_col(F.col("path")).alias("file"),
                         F.posexplode(parts).alias("pos", "line"))
    return exploded.select("file", F.lit(0).cast("bigint").alias("block"),
                           F.col("pos").cast("bigint").alias("m"), "line")


def _gunzip():
    @F.udf("binary")
    def gunzip(content):  # once for each compressed file, which is one row
        import gzip

        return gzip.decompress(bytes(content))

    return gunzip


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote (e.g. a split table once its job has finished)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def number_lines(raw: DataFrame, broadcast_rows: int = SPLIT_BROADCAST_ROWS,
                 written: list[str] | None = None, require_input: str | None = None) -> DataFrame:
    """``(file, block, m, line)`` → ``(file, line_num, line)`` with exact 1-based line numbers.
    ``written`` collects the folder of the split table, for callers that delete it after their
    action (long-running streams do).  Columns ``uri``, ``size`` and ``mtime`` of ``raw`` are kept in that table
    (:func:`files_of_splits`)."""
    spark = raw.sparkSession
    checkpoint_dir(spark)
    pin_splits(spark)
    facts = [c for c in ("uri", "size", "mtime") if c in raw.columns]
    splits = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("rows"), F.min("m").alias("m0"), *[F.min(c).alias(c) for c in facts])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # numbers only (about 40 bytes per split): the file is keyed by its 64-bit hash, and the id
    # range [m0, m0 + rows) of the split -- disjoint from every other split's -- keeps the join
    # exact even if two paths shared a hash
    splits = splits.select(F.xxhash64("file").alias("__fh"), F.col("block").alias("__blk"), "m0", "rows",
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), *facts)
    # small table, written once to the shared folder (cuts the lineage; a retried task never
    # recomputes it) and counted before deciding how to join it
    path = scratch_path(spark, f"splits-{uuid.uuid4().hex}")
    splits.write.parquet(path)
    _delete_at_end(spark, path)
    if written is not None:
        written.append(path)
    splits = spark.read.schema(splits.schema).parquet(path).drop(*facts)
    n_splits = splits.count()
    if require_input and n_splits == 0:
        raise NoInputFiles(require_input)
    return _with_numbers(raw, F.broadcast(splits) if n_splits <= broadcast_rows else splits)


def _with_numbers(raw: DataFrame, side: DataFrame) -> DataFrame:
    cond = ((F.xxhash64(raw["file"]) == F.col("__fh")) & (raw["block"] == F.col("__blk"))
            & (raw["m"] >= F.col("m0")) & (raw["m"] < F.col("m0") + F.col("rows")))
    number = F.col("m") - F.col("m0") + 1 + F.col("offset")
    lost = F.raise_error(F.concat(F.lit("the file splits changed after the lines were numbered (files or "
                                        "spark.sql.files.* settings); read the lines again: "), F.col("file")))
    return (raw.join(side, cond, "left")
            .select("file", F.coalesce(number, lost.cast("bigint")).alias("line_num"), "line"))


def number_few(raw: DataFrame) -> tuple[DataFrame, pa.Table]:
    """:func:`number_lines` for a micro-batch of no more than ``FEW_FILES`` files: the split table, numbers only, comes
    to the driver in one job and goes out with the plan that reads it.  Also returns the files that have lines: ``(file, uri, size, mtime)``."""
    spark = raw.sparkSession
    pin_splits(spark)
    facts = [c for c in ("uri", "size", "mtime") if c in raw.columns]
    splits = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("rows"), F.min("m").alias("m0"), *[F.min(c).alias(c) for c in facts])
    found = splits.withColumn("__fh", F.xxhash64("file")).toArrow().sort_by([("file", "ascending"), ("block", "ascending")]).combine_chunks()
    rows = found["rows"].to_numpy()
    name = found["file"].to_pylist()
    first = np.array([i == 0 or name[i] != name[i - 1] for i in range(len(name))], bool)
    before = np.cumsum(rows) - rows
    start = before[np.maximum.accumulate(np.where(first, np.arange(len(name)), 0))] if len(name) else before
    numbers = pa.table({"__fh": found["__fh"], "__blk": found["block"], "m0": found["m0"], "rows": found["rows"], "offset": pa.array(before - start, pa.int64())})
    files = found.filter(pa.array(first)).select(["file", *facts])
    return _with_numbers(raw, F.broadcast(spark.createDataFrame(numbers))), files


class SmallBatches:
    """Micro-batches whose files are small: listed from the scan's plan on the driver, read and numbered by one task.  What is
    asked of the JVM is asked once, as every batch would wait for it."""

    def __init__(self, spark: SparkSession, rx: str | None):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        made, factory = jvm.org.apache.hadoop.util.ReflectionUtils.newInstance, jvm.org.apache.hadoop.io.compress.CompressionCodecFactory
        self.packed = tuple(made(kind, conf).getDefaultExtension() for kind in factory(conf).getCodecClasses(conf))
        self.rule = jvm.java.util.regex.Pattern.compile(rx) if rx else None
        self.most = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.openCostInBytes"))

    def files(self, batch: DataFrame) -> tuple[pa.Table, bool] | None:
        """``(file, uri, size, mtime)`` of the files whose names fit the rule, and whether these are all, if all of the batch is no
        more than Spark counts for opening one file and every file has lines; else, or where there is no such plan, None."""
        seen, left = {}, self.most
        try:
            rdd = batch._jdf.queryExecution().logical().rdd()
            while rdd.getClass().getSimpleName() != "FileScanRDD":
                of = rdd.dependencies()
                if of.size() != 1:
                    return None
                rdd = of.apply(0).rdd()
            parts = rdd.filePartitions()
            for i in range(parts.size()):
                for split in parts.apply(i).files():
                    uri = split.urlEncodedPath()
                    if uri not in seen:
                        seen[uri] = split.fileSize(), split.modificationTime()
                        left -= seen[uri][0]
                    # what is packed, or no longer than a mark of the byte order, may have no line
                    if left < 0 or seen[uri][0] <= 3 or uri.endswith(self.packed):
                        return None
        except Py4JError:  # another kind of plan
            return None
        rows = []
        for uri, (size, ms) in seen.items():
            file = re.sub(r"^file:(//)?(?=/)", "", unquote(uri))
            if self.rule is None or self.rule.matcher(file.rsplit("/", 1)[-1]).find():
                rows.append({"file": file, "uri": uri, "size": size, "mtime": ms * 1000})
        kinds = {"file": pa.string(), "uri": pa.string(), "size": pa.int64(), "mtime": pa.int64()}
        found = pa.Table.from_pylist(rows, schema=pa.schema(kinds))
        return found.set_column(3, "mtime", found["mtime"].cast(pa.timestamp("us", "UTC"))), len(rows) == len(seen)


def number_small(raw: DataFrame) -> DataFrame:
    """:func:`number_lines` for a micro-batch of :class:`SmallBatches`: nothing is shuffled."""
    return raw.coalesce(1).selectExpr("file", "CAST(row_number() OVER (PARTITION BY file ORDER BY block, m) AS BIGINT) AS line_num", "line")


def files_of_splits(spark: SparkSession, path: str) -> DataFrame:
    """``(file, uri, size, mtime)`` of the files that have lines, from a split table."""
    return spark.read.parquet(path).select(_file_col(F.col("uri")).alias("file"), "uri", "size", "mtime").distinct()


def pin_splits(spark: SparkSession) -> None:
    """Fix the split size for the session: unless set, the wanted number of splits is that of the
    cores there are now, so that executors that come or go do not change how files are cut."""
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system remove ``path`` when the application ends."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    _split_tables.setdefault(spark.sparkContext.applicationId, []).append(path)


def release_split_tables(spark: SparkSession) -> int:
    """Remove the split tables of all reads so far, for when their lines are no longer needed; what is
    left goes when the application ends.  Returns how many there were."""
    paths = _split_tables.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def list_files(spark: SparkSession, paths: str | list[str], match: str | None = DEFAULT_MATCH) -> DataFrame:
    """``(file, size, mtime)`` of the matching files; contents are not read.  Empty files, which a scan
    passes over, come from the reader's file index (size 0, no time)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    glob = _simple_glob(match)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(paths)
    names = spark.createDataFrame([(uri,) for uri in df.inputFiles()], "uri string").select(_file_col(F.col("uri")).alias("file"))
    rx = match_regex(match) if not glob else None
    if rx:
        names = names.filter(F.regexp_extract("file", r"([^/]*)$", 1).rlike(rx))
    known = df.select(_file_col(F.col("path")).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    return names.distinct().join(known, "file", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("bigint")))


def read_log_lines(spark: SparkSession, paths: str | list[str], match: str | None = DEFAULT_MATCH,
                   charset: str = "UTF-8", line_sep: str = "\n", processed: DataFrame | None = None,
                   offsets: DataFrame | None = None, broadcast_rows: int = SPLIT_BROADCAST_ROWS,
                   allow_empty: bool = False, rebalance: int | None = None,
                   line_sep_regex: str | None = None, index_dir: str | None = None,
                   opener: ranges.Opener | None = None, files: DataFrame | None = None) -> DataFrame:
    """All lines of the matching files below ``paths`` (sub-directories always descended).

    ``processed``: a manifest ``(file)`` of files to skip; it is applied to the listing, whatever its
    size, so a listed file is not opened.
    ``offsets``: ``(file, last_line)``; only lines after ``last_line`` are returned (tailing), and parts
    of files before it are not read.
    ``index_dir``: keep the line index there (:mod:`logweave.sources.ranges`): later reads of the same files
    number their lines in one pass, and count only what is new in files that have grown.
    ``line_sep_regex``: split lines on a regular expression instead of ``line_sep`` (whole-file
    decoding, see :func:`_scan_whole_files`).
    ``rebalance``: spread the numbered lines round-robin over that many partitions (for inputs of
    a few large gzip files, which are read one task per file).
    ``files``: a listing (:func:`list_sources`) of which to read the files, as long as they were then; files that have
    come since are not read.
    ``opener``: opens files of stores that the tasks cannot reach by ``pyarrow.fs``; without it such files
    are read by Spark, the manifest and the offsets applied to lines.
    Raises when the directory is missing, or when no file matches and ``allow_empty`` is false.
    """
    paths = _existing(spark, paths)
    none = None if allow_empty else f"no file matching {match!r} below {paths}"
    by_ranges = files is not None or processed is not None or offsets is not None or index_dir is not None or opener is not None or not _cut_before_decoding(charset)
    by_ranges = by_ranges and line_sep_regex is None and ranges.supported(charset, line_sep) and (opener is not None or _opened_by_tasks(spark, paths))
    if index_dir is not None and not by_ranges:
        raise ValueError("a line index needs files that the tasks open by themselves, a known charset and a plain separator")
    if by_ranges:
        lines = _read_ranges(spark, paths, match, charset, line_sep, processed, offsets, index_dir, opener, none, files)
    else:
        raw = scan_lines(spark, paths, match, charset, line_sep, processed=processed, line_sep_regex=line_sep_regex)
        # the split table's count doubles as the "nothing matched" check (no extra job)
        lines = number_lines(raw, broadcast_rows=broadcast_rows, require_input=none)
        if files is not None:
            lines = lines.join(_per_file(files.select(F.col("file").alias("__listed"))), F.col("file") == F.col("__listed"), "left_semi")
        if offsets is not None:
            lines = after_offsets(lines, offsets)
    if rebalance:
        lines = lines.repartition(rebalance)
    return lines


def _read_ranges(spark, paths, match, charset, line_sep, processed, offsets, index_dir, opener, none, files) -> DataFrame:
    checkpoint_dir(spark)
    files = files if files is not None else list_sources(spark, paths, match)
    if processed is not None:
        files = skip_processed(files, processed)
    index = ranges.update_index(spark, files, index_dir, charset, line_sep, opener=opener)
    total = index.agg(F.count("*"), F.coalesce(F.sum(F.least("stop", "size") - F.col("start")), F.lit(0))).first()
    if none and not total[0]:
        raise NoInputFiles(none)
    cells = index.filter("n > 0").select("file", "uri", "start", "stop", "size", "before", "n")
    if offsets is not None:
        o = offsets.select(F.col("file").alias("__of"), F.col("last_line").cast("bigint").alias("after"))
        cells = cells.join(_per_file(o), F.col("file") == F.col("__of"), "left").drop("__of").filter("after is null or before + n > after")
    return ranges.read_cells(cells, charset, line_sep, opener, ranges._tasks(spark, total[0], total[1])).select("file", "line_num", "line")


def skip_processed(df: DataFrame, manifest: DataFrame, file_col: str = "file") -> DataFrame:
    """Drop rows whose file is listed in ``manifest(file)`` (paths trimmed).  Left-anti join with the
    manifest, broadcast when counted small, so that lines are not moved by file."""
    m = manifest.select(F.trim(F.col(manifest.columns[0])).alias("__file")).where(F.col("__file") != "")
    return df.join(_per_file(m.distinct()), F.col(file_col) == F.col("__file"), "left_anti")


def _per_file(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.limit(PER_FILE_ROWS + 1).count() <= PER_FILE_ROWS else side


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The processed-files list: one path per line."""
    return spark.read.text(path).select(F.trim("value").alias("file")).where(F.col("file") != "")


def from_line(lines: DataFrame, start: int) -> DataFrame:
    """Skip lines numbered below ``start`` (the reference's skip-over offset)."""
    return lines.where(F.col("line_num") >= F.lit(start))


def after_offsets(lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """Lines after each file's ``last_line``; files without an offset start at line 1."""
    o = offsets.select(F.col("file").alias("__of"), F.col("last_line").alias("__last"))
    joined = lines.join(_per_file(o), F.col("file") == F.col("__of"), "left")
    return joined.where(F.col("line_num") > F.coalesce(F.col("__last"), F.lit(0))).drop("__of", "__last")
