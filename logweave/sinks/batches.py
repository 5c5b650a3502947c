"""Documents → batches of at most ``n`` documents, each one JSON array (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import chunked_row_number

DEFAULT_BATCH_SIZE = 100
BATCH_SCHEMA = "batch_id string, n_docs int, payload string"


def document_json(docs: DataFrame) -> DataFrame:
    return docs.select(F.to_json(F.struct("id", "fields")).alias("doc"))


def _batcher(n: int):
    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        buf: list[str] = []
        k = 0
        out_ids, out_n, out_payload = [], [], []

        def flush():
            nonlocal k, buf
            out_ids.append(f"{pid}-{k}")
            out_n.append(len(buf))
            out_payload.append("[" + ",".join(buf) + "]")
            k += 1
            buf = []

        for pdf in batches:
            for doc in pdf["doc"].tolist():
                buf.append(doc)
                if len(buf) == n:
                    flush()
            if out_ids:
                yield pd.DataFrame({"batch_id": out_ids, "n_docs": out_n, "payload": out_payload})
                out_ids, out_n, out_payload = [], [], []
        if buf:
            flush()
            yield pd.DataFrame({"batch_id": out_ids, "n_docs": out_n, "payload": out_payload})

    return run


def batch_documents(docs: DataFrame, n: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Batches formed inside each partition, in partition order, like one sender per partition:
    every partition ends with at most one short batch.  No shuffle; JSON is encoded JVM-side
    and only joined into arrays in the Arrow-batched Python step."""
    if n < 1:
        raise ValueError("batch size must be positive")
    return document_json(docs).mapInPandas(_batcher(n), BATCH_SCHEMA)


def batch_documents_by_key(docs: DataFrame, key: str, order_col: str, n: int = DEFAULT_BATCH_SIZE,
                           chunk_width: int = 1 << 16) -> DataFrame:
    """Deterministic batches: documents of one ``key`` value in ``order_col`` order, cut every
    ``n``.  Positions come from :func:`chunked_row_number`, so a key holding most documents is
    still numbered by many tasks; each batch (≤ n documents) is assembled by one group."""
    numbered = chunked_row_number(docs.withColumn("__doc", F.to_json(F.struct("id", "fields"))),
                                  [key], order_col, chunk_width=chunk_width)
    numbered = numbered.withColumn("batch_no", F.floor((F.col("rn") - 1) / n).cast("bigint"))
    items = F.array_sort(F.collect_list(F.struct(F.col("rn").alias("k"), F.col("__doc").alias("d"))))
    return numbered.groupBy(key, "batch_no").agg(
        F.count(F.lit(1)).cast("int").alias("n_docs"),
        F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.min(order_col).alias("first_order"), F.max(order_col).alias("last_order"),
        F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: x["d"]), ","), F.lit("]")).alias("payload"),
    )
