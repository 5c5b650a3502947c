"""Token ids as packed matrices: best-fit-decreasing packing.

Each task gathers about ``buffer_ids`` ids, splits documents longer than a row without loss, sorts the
pieces by length and puts each into the fullest row that still takes it, found in a segment tree over
the free capacity of open rows.  Then the rows leave: ids padded to the capacity, cumulative segment
lengths, and positions that start at 0 in every segment.  Nothing is shuffled; memory is bounded by
the buffer and the longest document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm import tokens
from logweave.llm.common import map_arrow, table
from logweave.llm.packing import TASK_IDS, default_tokenizer

CAPACITY = 1024
BUFFER_IDS = 2_000_000
END_ID = PAD_ID = 0
ROWS_AT_ONCE = 512


class FreeSpace:
    """Open rows by free capacity: a segment tree of counts over the capacities 0..``capacity``."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def _change(self, free: int, by: int) -> None:
        node = free + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._change(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least free capacity of at least ``need``, as (free, row)."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        free = node - self.size
        self._change(free, -1)
        return free, self.rows[free].pop()


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of piece numbers; every length is at most ``capacity``."""
    space, rows = FreeSpace(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = space.take(lengths[i])
        free, row = found if found else (capacity, len(rows))
        if not found:
            rows.append([])
        rows[row].append(i)
        space.put(free - lengths[i], row)
    return rows


def token_matrix(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, pad_id: int = PAD_ID, buffer_ids: int = BUFFER_IDS) -> DataFrame:
    """One row per packed row: ``sequence_id``, ``input_ids`` (``capacity`` long), ``cu_seqlens`` (0 and
    the end of every segment), ``position_ids`` (padding: 0), ``doc_ids`` and ``starts`` (document
    and first id of every segment).

    Each document ends with ``end_id``; a null or empty text is that id alone.  Repeated rows and null
    ids are packed each for itself; other columns are not carried; an empty table gives no rows."""
    kind = docs.schema[doc_id].dataType
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("input_ids", ints), T.StructField("cu_seqlens", ints),
                           T.StructField("position_ids", ints), T.StructField("doc_ids", T.ArrayType(kind)),
                           T.StructField("starts", T.ArrayType(T.LongType()))])

    def pack(batches):
        enc, held, size = tokens.encoder(tokenizer), [], 0
        next_id, id_type = TaskContext.get().partitionId() * TASK_IDS, None

        def flush():
            nonlocal next_id
            rows = best_fit([len(ids) for _, _, ids in held], capacity)
            for lo in range(0, len(rows), ROWS_AT_ONCE):
                part = rows[lo: lo + ROWS_AT_ONCE]
                matrix = np.full((len(part), capacity), pad_id, np.int32)
                places = np.zeros((len(part), capacity), np.int32)
                ends = []
                for r, row in enumerate(part):
                    at, cu = 0, [0]
                    for i in row:
                        ids = held[i][2]
                        matrix[r, at: at + len(ids)] = ids
                        places[r, at: at + len(ids)] = np.arange(len(ids))
                        at += len(ids)
                        cu.append(at)
                    ends.append(cu)
                edges = pa.array(np.arange(0, capacity * len(part) + 1, capacity, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(next_id, next_id + len(part))), pa.ListArray.from_arrays(edges, pa.array(matrix.ravel())),
                    pa.array(ends, pa.list_(pa.int32())), pa.ListArray.from_arrays(edges, pa.array(places.ravel())),
                    pa.array([[held[i][0] for i in row] for row in part], pa.list_(id_type)),
                    pa.array([[held[i][1] for i in row] for row in part], pa.list_(pa.int64()))], names=[f.name for f in schema])
                next_id += len(part)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(enc.ids(value.as_py()), np.uint32(end_id)).astype(np.int32)
                held += [(key, at, ids[at: at + capacity]) for at in range(0, len(ids), capacity)]
                size += len(ids)
                if size >= buffer_ids:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return map_arrow(docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")), pack, schema)


def write_matrix(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet files of fixed-width id arrays."""
    packed.write.parquet(path)


def op6_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrix(table(spark, sf_dir, "documents"), default_tokenizer())
