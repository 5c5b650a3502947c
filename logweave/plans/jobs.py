"""The reference's one-shot directory mode as one composed job.

``index_directory`` = read (skipping files listed in the manifest) → normalise → parse → documents
→ write and/or deliver → append the processed files to the manifest (only after the sink
committed) → statistics.  Each step is one of the library's DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import java_trim
from ..operators.documents import to_documents
from ..operators.normalize import normalize_lines
from ..session import prepare, release
from ..sinks.deliver import deliver, update_manifest, write_documents
from ..sinks.tombstones import apply_tombstones, write_tombstones
from ..sources.files import DEFAULT_MATCH, list_files, list_sources, path_exists, read_log_lines, read_manifest, skip_processed
from ..streaming.progress import ProgressLog


def index_directory(spark: SparkSession, path: str, parse: Callable[[DataFrame], DataFrame], *,
                    match: str | None = DEFAULT_MATCH, manifest: str | None = None,
                    write_to: str | None = None, endpoints: list[str] | None = None,
                    post: Callable[[str, str], int] | None = None, batch_size: int = 100,
                    id_field: str = "id", delivery_log: str | None = None, delete_after: bool = False,
                    archive_dir: str | None = None, files_per_pass: int | None = None,
                    progress: ProgressLog | None = None) -> DataFrame:
    """Run one indexing pass over ``path``.

    ``parse``: a job over non-blank trimmed lines returning records (e.g. ``grok_job``,
    ``json_lines(...).where("_matched")``, ``xml_field_docs``, ``solr_log``).  Documents go to
    ``write_to`` (Parquet, appended) and/or are delivered to ``endpoints`` with ``post``.  With
    ``manifest`` the files listed there are skipped and the files read are appended after the
    sink committed.  ``delete_after`` removes the files that were read (or moves them below ``archive_dir``) after the
    sink and the manifest have them, if they have not changed since they were listed; a pass that crashed before that
    leaves it to the next one.  The log of deliveries, for per-endpoint counts, goes to ``delivery_log``.
    ``files_per_pass`` cuts the pass into groups of so many files, each written and put into the manifest before the
    next begins (it needs ``manifest`` and ``write_to``); ``progress`` gets the counts of each group, taken while it is written.
    Returns per-file document counts: of the whole output table when writing,
    else of this pass.
    """
    if files_per_pass or progress:
        if not (manifest and write_to) or (endpoints and post):
            raise ValueError("files_per_pass and progress need manifest and write_to, and no endpoints")
        return _in_groups(spark, path, parse, match, manifest, write_to, id_field, files_per_pass, progress, delete_after, archive_dir)
    prepare(spark)
    if delete_after and not manifest:
        raise ValueError("delete_after needs a manifest, to know what was done")
    ledger = f"{manifest.rstrip('/')}_tombstones" if manifest else ""
    processed = files = listed = None
    if delete_after:
        apply_tombstones(spark, ledger, archive_dir=archive_dir)  # what a pass before has left
    if manifest:
        processed = read_manifest(spark, manifest) if path_exists(spark, manifest) else None
        # the files of this pass are listed once: what comes later is for the next pass
        files = list_sources(spark, path, match)
        if processed is not None:
            files = skip_processed(files, processed)
        files = files.checkpoint()
        # files without lines are done, too
        empty = list_files(spark, path, match).filter("size = 0").select("file")
        if processed is not None:
            empty = skip_processed(empty, processed)
        listed = files.select("file").unionByName(empty).distinct().checkpoint()
    # every file already processed is not an error (only "nothing matches at all" is)
    lines = read_log_lines(spark, path, match=match, files=files, allow_empty=processed is not None)
    records = parse(normalize_lines(lines))
    docs = to_documents(records, id_field=id_field)
    if write_to is None and not (endpoints and post):
        raise ValueError("give write_to, or endpoints and post")
    if write_to is not None:
        write_documents(docs, write_to)
    if endpoints and post:
        deliver(docs, endpoints, post, batch_size=batch_size, log_path=delivery_log)
    if delete_after:
        write_tombstones(files, ledger)  # the sink has them
    if manifest:
        update_manifest(listed, manifest)
    if delete_after:
        apply_tombstones(spark, ledger, archive_dir=archive_dir)
    if write_to is not None:
        written = spark.read.parquet(write_to)
        return written.groupBy("file").agg(F.count(F.lit(1)).alias("docs"))
    return docs.groupBy("file").agg(F.count(F.lit(1)).alias("docs"))


def _in_groups(spark, path, parse, match, manifest, write_to, id_field, files_per_pass, progress, delete_after, archive_dir) -> DataFrame:
    prepare(spark)
    ledger = f"{manifest.rstrip('/')}_tombstones"
    if delete_after:
        apply_tombstones(spark, ledger, archive_dir=archive_dir)
    found = list_sources(spark, path, match)
    if path_exists(spark, manifest):
        found = skip_processed(found, read_manifest(spark, manifest))
    found = found.checkpoint()
    n = found.count()
    groups = -(-n // files_per_pass) if files_per_pass else min(n, 1)
    # groups of nearly the same number of files, by a hash of the path
    found = found.withColumn("__group", F.pmod(F.xxhash64("file"), F.lit(max(1, groups)))).checkpoint()
    for group in range(groups):
        files = found.filter(F.col("__group") == group).drop("__group")
        if files.isEmpty():
            continue
        lines = read_log_lines(spark, path, match=match, files=files)
        read, made = Observation(), Observation()
        lines = lines.observe(read, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum((java_trim(F.col("line")) == "").cast("int")), F.lit(0)).alias("blank"))
        records = parse(normalize_lines(lines))
        used = F.col("n_lines") if "n_lines" in records.columns else F.lit(1)
        records = records.observe(made, F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(used), F.lit(0)).alias("lines"))
        write_documents(to_documents(records, id_field=id_field), write_to)
        if progress is not None:
            parsed = read.get["blank"] + made.get["lines"]
            progress.add(files=files.count(), lines_read=read.get["lines"], lines_parsed=parsed, lines_skipped=read.get["lines"] - parsed, docs=made.get["docs"])
        if delete_after:
            write_tombstones(files, ledger)
        update_manifest(files, manifest)
        if delete_after:
            apply_tombstones(spark, ledger, archive_dir=archive_dir)
        release(spark)
    written = spark.read.parquet(write_to) if path_exists(spark, write_to) else None
    counts = spark.createDataFrame([], "file string, docs bigint") if written is None else written.groupBy("file").agg(F.count(F.lit(1)).alias("docs"))
    if progress is not None:
        progress.close()
    return counts
