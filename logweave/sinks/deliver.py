"""Delivery of document batches to endpoints (K2) and table sinks (K3-K5)."""

from __future__ import annotations

import random
import sys
import time
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .batches import DEFAULT_BATCH_SIZE, batch_documents

DELIVERY_SCHEMA = "batch_id string, endpoint string, n_docs int, status int, attempts int"
OK_STATUS = (200, 204)


class DeliveryError(RuntimeError):
    pass


def send_batch(post: Callable[[str, str], int], endpoints: list[str], batch_id: str, payload: str, rng: random.Random,
               retry_wait_s: float) -> tuple[str, int, int]:
    """Post one batch: ``(endpoint, status, attempts)``, or :class:`DeliveryError` when no endpoint took it."""
    live = list(endpoints)
    attempts, waited = 0, False
    while True:
        endpoint = live[rng.randrange(len(live))]
        attempts += 1
        try:
            status = int(post(endpoint, payload))
        except Exception:  # network error: same as a failed status
            status = -1
        if status in OK_STATUS:
            return endpoint, status, attempts
        if len(live) > 1:
            live.remove(endpoint)  # only for this batch
        elif not waited:  # last endpoint: wait, retry once, then fail the task (Spark retries it)
            time.sleep(retry_wait_s)
            waited = True
        else:
            raise DeliveryError(f"batch {batch_id} could not be delivered (last status {status})")


def _sender(post: Callable[[str, str], int], endpoints: list[str], retry_wait_s: float, seed: int | None):
    def run(batches):
        import pandas as pd

        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        rng = random.Random(None if seed is None else seed * 1_000_003 + task)
        for pdf in batches:
            rows = []
            for batch_id, n_docs, payload in zip(pdf["batch_id"], pdf["n_docs"], pdf["payload"]):
                endpoint, status, attempts = send_batch(post, endpoints, batch_id, payload, rng, retry_wait_s)
                rows.append((batch_id, endpoint, int(n_docs), status, attempts))
            yield pd.DataFrame(rows, columns=["batch_id", "endpoint", "n_docs", "status", "attempts"])

    return run


def deliver(docs: DataFrame, endpoints: list[str], post: Callable[[str, str], int],
            batch_size: int = DEFAULT_BATCH_SIZE, retry_wait_s: float = 1.0, seed: int | None = None,
            max_parallel: int | None = None, log_path: str | None = None) -> DataFrame:
    """Send batches to random endpoints; a failing endpoint is dropped for that batch and another
    tried; on the last one wait ``retry_wait_s``, retry once, then fail.  ``post(endpoint,
    json_payload) -> HTTP status`` is the user's client (it must be picklable); 200/204 = success.

    Runs at once: the batches are posted by one job, which appends the delivery log ``(batch_id,
    endpoint, n_docs, status, attempts)`` to ``log_path`` (a new table in the shared folder by
    default); the log of this run is returned as read back, so using it posts nothing again.  A
    failed batch fails its task, and Spark's retry re-sends the partition: delivery is
    at-least-once, made idempotent by the stable ids.  ``max_parallel`` bounds concurrent
    connections; the documents are made with full parallelism and dealt out to that many tasks.
    """
    if not endpoints:
        raise ValueError("at least one endpoint is required")
    spark = docs.sparkSession
    src = docs.repartition(max_parallel) if max_parallel else docs
    log = batch_documents(src, batch_size).mapInPandas(_sender(post, list(endpoints), retry_wait_s, seed),
                                                       DELIVERY_SCHEMA)
    run = uuid.uuid4().hex
    path = (log_path or scratch_path(spark, "delivery")).rstrip("/")
    log.write.parquet(f"{path}/run={run}")
    return spark.read.schema(DELIVERY_SCHEMA).parquet(f"{path}/run={run}")


def write_documents(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                    partition_by: list[str] | None = None) -> None:
    w = docs.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def update_manifest(done: DataFrame, manifest_path: str) -> None:
    """Append the distinct files of ``done`` (after its sink committed) to the processed-files
    list, one path per line.  ``done`` may be a listing (:func:`logweave.sources.files.list_files`),
    which also names files without lines."""
    done.select("file").distinct().write.mode("append").text(manifest_path)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed
