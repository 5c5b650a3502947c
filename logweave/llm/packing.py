"""Harmonic packing of token ids into sequences.

Class k holds documents of which exactly k fit into a sequence (lengths in ``(capacity / (k+1),
capacity / k]``), and each bin of class k is closed with exactly k of them, uncut.  Every task packs its
own documents, with one open bin for each class, so nothing is shuffled and no task waits.

What a closed bin of its class leaves free, up to a third of it, is filled exactly with ids of a *filler*: a
document longer than a sequence, which has to be cut anyway.  Fillers also give full sequences of their own; the
last ``RESERVE`` sequences of their ids are kept for gaps.  While more than ``WAITING`` closed bins wait for
ids, documents that would fit become fillers too, so only where long documents are rare are others cut.  A gap of
at most a 64th of what the sequence holds stays.

When a task ends, what is in open bins is packed once more, by first fit from the longest, and filled up; bins that
cannot be filled are cut into full sequences, and the last of all into sequences whose length is a power of two,
which need no padding.  A task holds at most ``capacity`` ids for each class, and the reserve."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm import tokens
from logweave.llm.common import map_arrow, table

CAPACITY = 1024
END_ID = 0
#: A gap of one id for so many in the sequence may stay.
WASTE = 64
#: Sequences' worth of filler ids that a task keeps for gaps.
RESERVE = 16
#: Closed bins that wait for filler ids before other documents become fillers.
WAITING = 64
#: Sequences of one task: their ids are the task's number times this, and up.
TASK_IDS = 1 << 33


class Packer:
    """Closes bins as they fill; ``done`` is called with the pieces ``((key, start, ids, total), length)`` of each
    closed sequence."""

    def __init__(self, capacity: int, done):
        self.capacity, self.done = capacity, done
        self.bins: dict[int, list] = {}
        self.waiting: deque = deque()  # (gap, pieces) of bins that want ids
        self.fillers: deque = deque()  # [key, at, ids]
        self.reserve = 0  # ids in fillers

    def add(self, key, ids: np.ndarray) -> None:
        length = len(ids)
        if length == self.capacity:
            self.done([((key, 0, ids, length), length)])
            return
        if length > self.capacity or len(self.waiting) > WAITING:
            self.fillers.append([key, 0, ids])
            self.reserve += length
            self._serve()
            while self.reserve > RESERVE * self.capacity:
                self.done(self._take(self.capacity))
            return
        k = self.capacity // length
        held = self.bins.setdefault(k, [])
        held.append(((key, 0, ids, length), length))
        if len(held) == k:
            self._close(self.bins.pop(k))

    def _close(self, held: list) -> None:
        size = sum(length for _, length in held)
        gap = self.capacity - size
        if gap * WASTE <= size:
            self.done(held)
        elif gap <= self.reserve and not self.waiting:
            self.done(held + self._take(gap))
        else:
            self.waiting.append((gap, held))
            self._serve()

    def _serve(self) -> None:
        while self.waiting and self.waiting[0][0] <= self.reserve:
            gap, held = self.waiting.popleft()
            self.done(held + self._take(gap))

    def _take(self, n: int) -> list:
        """The next ``n`` ids of the fillers."""
        out = []
        self.reserve -= n
        while n:
            filler = self.fillers[0]
            key, at, ids = filler
            part = min(n, len(ids) - at)
            out.append(((key, at, ids[at: at + part], len(ids)), part))
            n -= part
            filler[1] += part
            if filler[1] == len(ids):
                self.fillers.popleft()
        return out

    def finish(self) -> None:
        pieces = [p for held in self.bins.values() for p in held] + [p for _, held in self.waiting for p in held]
        self.bins, self.waiting = {}, deque()
        bins: list[list] = []  # [free, pieces]
        for piece in sorted(pieces, key=lambda p: -p[1]):
            fits = next((b for b in bins if b[0] >= piece[1]), None)
            if fits is None:
                bins.append(fits := [self.capacity, []])
            fits[0] -= piece[1]
            fits[1].append(piece)
        rest = []
        for free, held in sorted(bins, key=lambda b: b[0]):  # small gaps first: the reserve fills more of them
            if free * WASTE <= self.capacity - free:
                self.done(held)
            elif free <= self.reserve:
                self.done(held + self._take(free))
            else:
                rest += held
        for (key, _, ids, _), length in rest:  # whole documents, as all that is in bins
            self.fillers.append([key, 0, ids])
            self.reserve += length
        while self.reserve >= self.capacity:
            self.done(self._take(self.capacity))
        while self.reserve:
            self.done(self._take(1 << (self.reserve.bit_length() - 1)))


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: the id column, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, ``sequence_tokens`` (and ``ids``).  ``capacity`` is a power of two.

    A null or empty text is the closing id alone; repeated rows and rows with a null id are packed
    each for itself; other columns are not carried.  Sequence ids do not repeat, but have gaps."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    kind = docs.schema[doc_id].dataType
    fields = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()),
              ("sequence_id", T.LongType()), ("offset", T.LongType()), ("sequence_tokens", T.LongType())]
    fields += [("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([T.StructField("_id", kind)] + [T.StructField(n, t) for n, t in fields])

    def pack(batches):
        enc = tokens.encoder(tokenizer)
        cols = {f.name: [] for f in schema}
        next_id = TaskContext.get().partitionId() * TASK_IDS
        id_type = None

        def done(held):
            nonlocal next_id
            size, at = sum(length for _, length in held), 0
            for (key, start, ids, total), length in held:
                row = (key, start, length, zlib.crc32(ids.astype("<u4").tobytes()), total, next_id, at, size)
                for c, v in zip(cols.values(), row):
                    c.append(v)
                if with_ids:
                    cols["ids"].append(ids.astype(np.int32))
                at += length
            next_id += 1

        def flush():
            arrays = [pa.array(cols["_id"], id_type)]
            arrays += [pa.array(cols[n], pa.list_(pa.int32()) if n == "ids" else pa.int64()) for n, _ in fields]
            for c in cols.values():
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, names=list(cols))

        packer = Packer(capacity, done)
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(key, np.append(enc.ids(value.as_py()), np.uint32(end_id)))
                if len(cols["_id"]) >= (1000 if with_ids else 10000):
                    yield flush()
        packer.finish()
        if cols["_id"]:
            yield flush()

    rows = map_arrow(docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")), pack, schema)
    return rows.withColumnRenamed("_id", doc_id)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mixed documents as packed pieces."""
    return pack_documents(docs, default_tokenizer())
