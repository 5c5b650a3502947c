"""Delivery that survives a crash without sending again what was sent (K2).

``deliver_once`` first writes the batches of a run to a table, the *outbox*: from then on a batch has a fixed
id and payload, whatever is computed again.  Tasks then send the batches that the *ledger* does not have, and
write a ledger entry after each answer, before the next batch is sent.  A retried task reads what its
partition's earlier attempts have entered; a run that is started again after a crash leaves out everything entered.
So at most the batch whose answer was not yet written when the task died is sent twice.

Sending is the write of a Python data source: each task returns a commit message with its totals, the driver's
``commit`` checks them against the outbox and marks the run as done; ``abort`` leaves outbox and ledger for the next
attempt.  Nothing but the totals comes to the driver."""

from __future__ import annotations

import base64
import json
import random
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import checkpoint_dir
from ..sources.files import path_exists
from .batches import BATCH_SCHEMA, DEFAULT_BATCH_SIZE, batch_documents
from .deliver import DELIVERY_SCHEMA, DeliveryError, send_batch
from .tombstones import _store


@dataclass
class Sent(WriterCommitMessage):
    batches: int
    docs: int


class _Ledger:
    """The entries of one partition of a run: small files, each written whole, so any store will do."""

    def __init__(self, folder: str, partition: int):
        self.fs, base = _store(folder)
        self.base = f"{base.rstrip('/')}/part={partition}"
        self.fs.create_dir(self.base, recursive=True)

    def sent(self) -> set[str]:
        from pyarrow import fs as pafs

        ids: set[str] = set()
        for info in self.fs.get_file_info(pafs.FileSelector(self.base)):
            if info.is_file and info.base_name.endswith(".json"):
                with self.fs.open_input_stream(info.path) as f:
                    ids.update(json.loads(line)["batch_id"] for line in f.read().decode().splitlines())
        return ids

    def enter(self, rows: list[dict]) -> None:
        name = f"{self.base}/{uuid.uuid4().hex}"
        with self.fs.open_output_stream(f"{name}.tmp") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        self.fs.move(f"{name}.tmp", f"{name}.json")


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.ledger, self.expected = options["ledger"], (int(options["batches"]), int(options["docs"]))
        self.endpoints = json.loads(options["endpoints"])
        self.post = cloudpickle.loads(base64.b64decode(options["post"]))
        self.retry_wait_s, self.seed = float(options["wait"]), json.loads(options["seed"])
        self.every = int(options["every"])

    def write(self, iterator) -> Sent:
        from pyspark import TaskContext

        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        ledger = _Ledger(self.ledger, partition)
        sent = ledger.sent()
        rng = random.Random(None if self.seed is None else self.seed * 1_000_003 + partition)
        total, entries = Sent(0, 0), []
        for batch in iterator:
            for row in batch.to_pylist():
                total.batches, total.docs = total.batches + 1, total.docs + row["n_docs"]
                if row["batch_id"] in sent:
                    continue
                try:
                    endpoint, status, attempts = send_batch(self.post, self.endpoints, row["batch_id"], row["payload"], rng, self.retry_wait_s)
                except DeliveryError:
                    if entries:
                        ledger.enter(entries)
                    raise
                entries.append({"batch_id": row["batch_id"], "endpoint": endpoint, "n_docs": row["n_docs"], "status": status, "attempts": attempts})
                if len(entries) >= self.every:
                    ledger.enter(entries)
                    entries = []
        if entries:
            ledger.enter(entries)
        return total

    def commit(self, messages) -> None:
        done = [m for m in messages if m is not None]
        got = (sum(m.batches for m in done), sum(m.docs for m in done))
        if got != self.expected:
            raise DeliveryError(f"{got} batches and documents were handled, the outbox had {self.expected} left")
        fs, base = _store(self.ledger)
        with fs.open_output_stream(f"{base.rstrip('/')}/_COMMITTED") as f:
            f.write(json.dumps({"batches": got[0], "docs": got[1]}).encode())

    def abort(self, messages) -> None:
        """What was sent is in the ledger; the next attempt goes on from there."""


class DeliverySource(DataSource):
    """``df.write.format("logweave_delivery")``, used by :func:`deliver_once`."""

    @classmethod
    def name(cls) -> str:
        return "logweave_delivery"

    def schema(self) -> str:
        return BATCH_SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def delivery_log(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's entries: ``DELIVERY_SCHEMA``."""
    return spark.read.schema(DELIVERY_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(ledger)


def deliver_once(docs: DataFrame, endpoints: list[str], post: Callable[[str, str], int], run_dir: str,
                 batch_size: int = DEFAULT_BATCH_SIZE, retry_wait_s: float = 1.0, seed: int | None = None,
                 max_parallel: int | None = None, ledger_every: int = 1) -> DataFrame:
    """Deliver ``docs`` as :func:`logweave.sinks.deliver.deliver` does, with outbox and ledger in ``run_dir`` (a folder
    that tasks and driver share, one for each run).  Called again with the same folder after a failure, it sends
    what is missing: ``docs`` are not computed again once the outbox is whole, and nothing is sent once the run
    is committed.  ``ledger_every`` batches share a ledger entry; with more than one, as many may be sent twice
    after a crash.  Returns the log, ``DELIVERY_SCHEMA``, one row for each batch sent."""
    if not endpoints:
        raise ValueError("at least one endpoint is required")
    spark = docs.sparkSession
    checkpoint_dir(spark)
    base = run_dir.rstrip("/")
    outbox, ledger = f"{base}/outbox", f"{base}/ledger"
    if not path_exists(spark, f"{outbox}/_SUCCESS"):
        src = docs.repartition(max_parallel) if max_parallel else docs
        batch_documents(src, batch_size).write.mode("overwrite").parquet(outbox)
    if path_exists(spark, f"{ledger}/_COMMITTED"):
        return delivery_log(spark, ledger)
    batches = spark.read.schema(BATCH_SCHEMA).parquet(outbox)
    attempt = f"{ledger}/attempt={uuid.uuid4().hex}"
    if path_exists(spark, ledger):
        sent = delivery_log(spark, ledger).select(F.col("batch_id").alias("__sent")).distinct()
        batches = batches.join(sent, F.col("batch_id") == F.col("__sent"), "left_anti")
    batches = batches.checkpoint()  # the same partitions for every attempt of a task
    left = batches.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    spark.dataSource.register(DeliverySource)
    if max_parallel:
        batches = batches.coalesce(max_parallel)
    options = {"ledger": attempt, "batches": left[0], "docs": left[1], "endpoints": json.dumps(list(endpoints)), "wait": retry_wait_s, "seed": json.dumps(seed),
               "every": max(1, ledger_every), "post": base64.b64encode(cloudpickle.dumps(post)).decode()}
    batches.write.format(DeliverySource.name()).options(**options).mode("append").save()
    _mark(spark, ledger)
    return delivery_log(spark, ledger)


def _mark(spark: SparkSession, ledger: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_COMMITTED")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True).close()


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed
