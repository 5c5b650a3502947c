"""Token counts by greedy longest match, in time linear in the text.

The vocabulary is a byte trie with failure links.  A node's link leads to the longest text still open
after its own text was cut greedily into pieces, and the number of pieces cut on the way is stored
with it, so an automaton that walks a word byte by byte knows how many pieces the word has without ever
building one.  Each distinct word of a chunk is walked once, all words of the chunk in step.

Words are runs of non-space characters with ``prefix`` before them; pieces that begin with the
prefix match only at the beginning of a word.  A word that the pieces cannot spell counts as one
(unknown) token."""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logweave.llm import texts
from logweave.llm.common import extended, map_arrow, table, without
from logweave.llm.packing import default_tokenizer
from logweave.llm.tokens import byte_letters

PREFIX = b" "
_made: dict[str, "Automaton"] = {}


class Automaton:
    """Rows for the trie's inner nodes only: a leaf is a piece that nothing continues, so reaching it
    means back to the root with one more piece.  Row 0 is the root, the last row is the dead state."""

    def __init__(self, pieces: Iterable[bytes], prefix: bytes = PREFIX):
        children: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    is_piece.append(False)
                node = children[node][b]
            is_piece[node] = bool(piece)
        order, inner = [0], {0: 0}
        for v in order:
            for u in children[v].values():
                if children[u]:
                    inner[u] = len(inner)
                    order.append(u)
        dead = len(inner)
        self.next = np.full((dead + 1, 256), dead, np.int32)
        self.pops = np.zeros((dead + 1, 256), np.int32)
        self.tail = np.zeros(dead + 1, np.int64)  # pieces to cut at a word's end; -1: cannot be spelt
        self.tail[dead] = -1
        link = {0: (dead, 0)}
        for v in order:  # by depth: a link leads to a shallower node, whose row is complete
            to, popped = link[v]
            row = inner[v]
            if to != dead:
                self.next[row] = self.next[to]
                self.pops[row] = self.pops[to] + popped
                self.tail[row] = -1 if self.tail[to] < 0 else self.tail[to] + popped
            elif v:
                self.tail[row] = -1
            for b, u in children[v].items():
                # what the link's automaton does with b is where u's open text goes
                goes, more = int(self.next[row, b]), int(self.pops[row, b])
                if u in inner:
                    link[u] = (0, 1) if is_piece[u] else (goes, more)
            for b, u in children[v].items():
                if u in inner:
                    self.next[row, b], self.pops[row, b] = inner[u], 0
                else:
                    self.next[row, b], self.pops[row, b] = 0, 1
        self.dead = dead
        start, first = 0, 0
        for b in prefix:
            first += int(self.pops[start, b])
            start = int(self.next[start, b])
        self.start, self.first = start, first

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word, all words walked in step."""
        size = ends - starts
        by = np.argsort(-size, kind="stable")
        at, size = starts[by], size[by]
        state = np.full(len(by), self.start, np.int64)
        total = np.full(len(by), self.first, np.int64)
        live = len(by)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size[:live], -step, "left"))
            byte = data[at[:live] + step]
            total[:live] += self.pops[state[:live], byte]
            state[:live] = self.next[state[:live], byte]
        tail = self.tail[state]
        out = np.empty(len(by), np.int64)
        out[by] = np.where((state == self.dead) | (tail < 0), 1, total + tail)
        return out


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file, without its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    letters = byte_letters()
    return [bytes(letters[c] for c in token) for token in spec["model"]["vocab"] if token not in special]


def automaton(path: str) -> Automaton:
    if path not in _made:
        _made[path] = Automaton(vocabulary(path))
    return _made[path]


def count_chunk(auto: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, tokens) of each text."""
    starts, ends, doc = texts.words(data, offsets)
    _, at, back = np.unique(texts.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    n = len(offsets) - 1
    pieces = auto.counts(data, starts[at], ends[at])[back]
    return np.bincount(doc, minlength=n), np.bincount(doc, pieces, n).astype(np.int64)


FIELDS = {"n_words": "long", "n_tokens": "long"}


def token_counts(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``n_words`` and ``n_tokens`` (columns of these names give way); 0 for
    a null or empty text.  Whole texts are counted; repeated rows each get their counts."""
    docs = without(docs, *FIELDS)
    at = docs.columns.index(text)

    def count(batches):
        auto = automaton(vocab_path)
        for batch in batches:
            parts = [count_chunk(auto, data, off) for _, _, data, off in texts.chunks(batch.column(at))]
            made = [pa.array(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *FIELDS])

    return map_arrow(docs, count, extended(docs, **FIELDS))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, default_tokenizer()).select("doc_id", "n_words", "n_tokens")
