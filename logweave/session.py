"""Session helpers: UTC time zone, checkpoint folder, sensible defaults."""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def get_session(master: str = "local[*]", app: str = "logweave", shuffle_partitions: int = 8,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured the way the jobs expect.

    On a cluster the session normally exists already; call :func:`prepare` on it instead.
    """
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # parsing is CPU-bound: do not let AQE merge small post-shuffle partitions into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # generated code for wide grok projections can pass HotSpot's 8 KB JIT limit
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Force the session time zone to UTC (timestamps are parsed and written in UTC), let a
    repeated map key keep its last value (the reference's "later pair wins"), and make sure a
    checkpoint folder is known.

    This changes the caller's session for good: ``spark.sql.session.timeZone``,
    ``spark.sql.mapKeyDedupPolicy`` and, if unset, the checkpoint folder."""
    ensure_utc(spark)
    ensure_last_win(spark)
    checkpoint_dir(spark)
    return spark


def ensure_last_win(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.mapKeyDedupPolicy", None) != "LAST_WIN":
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the session.  Where
    neither is set, a local master (as in tests) gets a fresh temporary folder; on a cluster,
    whose machines do not see each other's folders, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="logweave-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for tables this library writes itself."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/logweave/{name}"


_kept: dict[str, list[DataFrame]] = {}


def keep(df: DataFrame) -> DataFrame:
    """Have Spark hold ``df`` (in memory, else on the executors' disks) once it is computed, for plans that read it more
    than once.  What a lost executor held is computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    _kept.setdefault(df.sparkSession.sparkContext.applicationId, []).append(df)
    return df


def release(spark: SparkSession) -> int:
    """Let go of everything that :func:`keep` holds, for when the results that read it are written.  Returns how many
    tables there were."""
    held = _kept.pop(spark.sparkContext.applicationId, [])
    for df in held:
        df.unpersist()
    return len(held)
