"""N-gram Jaccard join: linked documents and their components, by prefix trees.

1. Sets.  A document is its set of distinct word shingles as 64-bit numbers in one global order: first
   by a bound of how common the shingle is (the count of its rarest word, from a table of hashed word
   counts over all documents), then by hash.  Documents with equal sets are one class.
2. Candidates.  Two linked sets share a shingle within the first ``n - ceil(t * n) + 1`` of either.  In
   this order these are rare ones, so few classes meet at a shingle.  Where some do, parity sketches (a
   bit per set element, folded) bound the size of the symmetric difference from below; classes that may
   be linked, directly or through others of the group, form the cluster of their smallest one, the pivot.
   Equal groups are looked at once, and a class may be in several clusters.
3. Trie join.  Each cluster's sets are stored in a prefix tree, common shingles first, so near copies
   share their path.  A set walks the tree with the overlap so far; subtrees are left out when the
   shingles that remain on either side cannot reach the threshold, or when all their sets are already
   in the walker's component.  A cluster over ``CLUSTER_BLOCK`` sets is dealt into blocks: each set
   meets the cluster's pivot first, and only sets that the pivot does not link meet all blocks.
4. Components of the links, by minimum labels with pointer jumping.

No pairs of a group are emitted anywhere, equal sets least of all; every link between different texts
is either checked or follows from links that are in the component already."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import texts
from logweave.llm.common import attach, cut, extended, map_arrow, ship, table

SHINGLE = 4
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 85
COUNT_BITS = 20
GROUP_BLOCK = 1024
CLUSTER_BLOCK = 256
U = np.uint64


def word_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Counts of hashed words over all documents, ``2 ** COUNT_BITS`` numbers; words that share a number
    only look more common."""
    def count(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for _, _, data, off in texts.chunks(batch.column(0)):
                data = texts.LOWER[data]
                starts, ends, _ = texts.words(data, off)
                h = (texts.hash_spans(data, starts, ends) >> U(64 - COUNT_BITS)).astype(np.int64)
                total += np.bincount(h, minlength=len(total))
        at = np.flatnonzero(total)
        for i in range(0, len(at), 65536):
            yield pa.record_batch([pa.array(at[i: i + 65536]), pa.array(total[at[i: i + 65536]])], names=["w", "n"])

    rows = map_arrow(docs.select(F.col(text).cast("string")), count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    t = rows.toArrow()  # at most 2 ** COUNT_BITS rows
    out = np.zeros(1 << COUNT_BITS, np.int64)
    out[t["w"].to_numpy()] = t["n"].to_numpy()
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, counts: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, offsets): each text's distinct shingles in the global order."""
    n = len(offsets) - 1
    data = texts.LOWER[data]
    starts, ends, doc = texts.words(data, offsets)
    h = texts.hash_spans(data, starts, ends)
    common = counts[(h >> U(64 - COUNT_BITS)).astype(np.int64)]
    g, at = texts.windows(h, doc, k)
    least = common[at]
    for i in range(1, k):
        least = np.minimum(least, common[at + i])
    who = doc[at]
    # texts of fewer words: the whole sequence, told apart by its length
    size = np.bincount(doc, minlength=n)
    first = np.cumsum(size) - size
    for words in range(1, k):
        short = np.flatnonzero(size == words)
        if len(short):
            s = np.zeros(len(short), U)
            low = np.full(len(short), np.iinfo(np.int64).max)
            for i in range(words):
                s = texts.mix(s * U(31) + h[first[short] + i] + U(1000 * words + i))
                low = np.minimum(low, common[first[short] + i])
            g, who, least = np.concatenate([g, s]), np.concatenate([who, short]), np.concatenate([least, low])
    level = np.frexp(least.astype(np.float64))[1].astype(U)
    token = (level << U(58)) | (g >> U(6))
    by = np.lexsort((token, who))
    token, who = token[by], who[by]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (who[1:] != who[:-1])
    token, who = token[new], who[new]
    return token, np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the set in as many bits as the power of two from its size on (64 to 65,536)."""
    bits = min(max(64, 1 << (max(len(tokens), 1) - 1).bit_length()), 65536)
    at = (texts.mix(tokens) & U(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def fold(bits: bytes, size: int) -> np.ndarray:
    """A sketch in ``size`` bytes; halves of a longer one are folded by exclusive or."""
    a = np.frombuffer(bits, np.uint8)
    while len(a) > size:
        half = len(a) // 2
        a = a[:half] ^ a[half:]
    return a.view(U)


class Sketches:
    """The sketches of a group, by length.  Sets that can be linked differ in size by less than a factor
    of two, so each sketch is compared at its own length and at half of it."""

    def __init__(self, n: np.ndarray, bits: list[bytes], percent: int):
        self.n, self.percent = n, percent
        self.length = np.array([len(b) for b in bits])
        self.row = np.zeros(len(bits), np.int64)
        self.whole, self.half = {}, {}
        for size in set(self.length.tolist()):
            at = np.flatnonzero(self.length == size)
            self.row[at] = np.arange(len(at))
            self.whole[size] = np.stack([fold(bits[i], size) for i in at])
            self.half[size] = np.stack([fold(bits[i], size // 2) for i in at]) if size > 8 else None

    def may_link(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` can be linked with ``one``: sizes fit, and the sketches differ in no more
        bits than the sets may in elements."""
        n, m = self.n[one], self.n[others]
        ok = 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        size = int(self.length[one])
        for other in (size // 2, size, 2 * size):
            at = np.flatnonzero(ok & (self.length[others] == other))
            if not len(at):
                continue
            mine = (self.half if other < size else self.whole)[size][self.row[one]]
            theirs = (self.half if other > size else self.whole)[other][self.row[others[at]]]
            apart = np.bitwise_count(theirs ^ mine).sum(1).astype(np.int64)
            ok[at] = apart * (100 + self.percent) <= (100 - self.percent) * (n + m[at])
        return ok


def group_edges(fp: np.ndarray, n: np.ndarray, bits: list[bytes], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Star edges of the candidate components of one group of classes."""
    sketches = Sketches(n, bits, percent)
    rest, out = np.arange(len(fp)), []
    while len(rest) > 1:
        pivot, rest = rest[0], rest[1:]
        stack = [pivot]
        while stack and len(rest):
            v = stack.pop()
            hit = sketches.may_link(v, rest)
            found, rest = rest[hit], rest[~hit]
            out += [(int(fp[pivot]), int(fp[u])) for u in found]
            stack += found.tolist()
    return out


class Trie:
    """A prefix tree of sorted number sets, with chains as one node."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.sets, self.sizes = sets, sizes
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.seg, self.kids, self.ends, self.low, self.rest, self.comp = [], [], [], [], [], []
        self._node(np.zeros(0, np.int64))
        todo = [(0, order, 0)]
        while todo:
            node, members, depth = todo.pop()
            self.ends[node] = [i for i in members if len(sets[i]) == depth]
            members = [i for i in members if len(sets[i]) > depth]
            at = 0
            while at < len(members):
                head = sets[members[at]]
                end = at + 1
                while end < len(members) and sets[members[end]][depth] == head[depth]:
                    end += 1
                part = members[at:end]
                last = sets[part[-1]]
                m = min(min(len(sets[i]) for i in part), len(last))
                differ = np.flatnonzero(head[depth:m] != last[depth:m])
                stop = depth + int(differ[0]) if len(differ) else m
                kid = self._node(head[depth:stop])
                self.kids[node].append(kid)
                self.low[kid] = int(min(sizes[i] for i in part))
                self.rest[kid] = max(len(sets[i]) for i in part) - stop
                todo.append((kid, part, stop))
                at = end

    def _node(self, seg: np.ndarray) -> int:
        for column, value in ((self.seg, seg), (self.kids, []), (self.ends, []), (self.low, 0), (self.rest, 0), (self.comp, None)):
            column.append(value)
        return len(self.seg) - 1

    def link(self, parent: list[int], x: int, percent: int = PERCENT) -> None:
        """Join set ``x`` with the linked sets outside its component; ``parent`` is a union-find forest."""
        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        mine, size = self.sets[x], int(self.sizes[x])
        least = -(-percent * size // 100)
        todo = [(0, 0, False)]
        while todo:
            node, overlap, done = todo.pop()
            if done:  # all below were visited: is it one component now?
                below = {root(self.comp[k]) if self.comp[k] is not None else None for k in self.kids[node]}
                below |= {root(i) for i in self.ends[node]}
                self.comp[node] = below.pop() if len(below) == 1 else None
                continue
            if self.comp[node] is not None and root(self.comp[node]) == root(x):
                continue
            seg = self.seg[node]
            left = len(mine)
            if len(seg):
                at = np.searchsorted(mine, seg)
                overlap += int((mine[np.minimum(at, len(mine) - 1)] == seg).sum()) if len(mine) else 0
                left -= int(np.searchsorted(mine, seg[-1], "right"))
                most = overlap + min(left, self.rest[node])
                if (100 + percent) * most < percent * (size + max(self.low[node], least)):
                    continue
            for i in self.ends[node]:
                if root(i) != root(x) and (100 + percent) * overlap >= percent * (size + int(self.sizes[i])):
                    parent[root(i)] = root(x)
            todo.append((node, 0, True))
            todo += [(k, overlap, False) for k in self.kids[node]]


def block_links(sets: list[np.ndarray], queries: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """The links between ``queries`` (a mask) and all sets of a block, as stars: pairs (first of a
    component, another of it)."""
    sizes = np.array([len(s) for s in sets])
    u, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(u), np.int64)
    rank[np.lexsort((u, -count))] = np.arange(len(u))
    shared = count[back] > 1  # what only one set has overlaps with nothing
    ends = np.cumsum(sizes)
    ranked = [np.sort(rank[back[e - s: e]][shared[e - s: e]]) for s, e in zip(sizes, ends)]
    trie, parent = Trie(ranked, sizes), list(range(len(sets)))
    for x in np.flatnonzero(queries).tolist():
        trie.link(parent, x, percent)
    first, out = {}, []
    for i in range(len(sets)):
        r = i
        while parent[r] != r:
            r = parent[r]
        if first.setdefault(r, i) != i:
            out.append((first[r], i))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(v, c): the smallest number reachable over ``edges`` (a, b), for every number in them."""
    ends = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
                             F.struct(F.col("a"), F.col("a").alias("b")), F.struct(F.col("b").alias("a"), F.col("b"))))
    both = cut(edges.select(ends.alias("e")).select("e.*").distinct())  # either way, and each number with itself
    labels = cut(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("c")))
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v"))
        near = near.agg(F.min("c").alias("c"), F.max(F.when(F.col("a") == F.col("b"), F.col("c"))).alias("old"))
        step = cut(near.join(labels.select(F.col("v").alias("c"), F.col("c").alias("cc")), "c").select("v", "old", F.least("c", "cc").alias("c")))
        if step.filter("c < old").isEmpty():
            return step.select("v", "c")
        labels = step.select("v", "c")


def _base(docs: DataFrame, counts, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """(rk, doc_id, n, fp, prefix, bits) of each row: set size, fingerprint, first shingles, sketch."""
    def sets(batches):
        common = counts.value
        for batch in batches:
            n, fp, prefix, bits = [], [], [], []
            for _, _, data, off in texts.chunks(batch.column(2)):
                token, at = shingle_sets(data, off, common, k)
                size = np.diff(at)
                sums = np.concatenate([np.zeros(1, U), np.cumsum(texts.mix(token))])
                n.append(size)
                fp.append(texts.mix(sums[at[1:]] - sums[at[:-1]] + size.astype(U)).astype(np.int64))
                for lo, hi in zip(at[:-1], at[1:]):
                    own = token[lo:hi]
                    prefix.append(own[: prefix_length(len(own), percent)].astype(np.int64) if len(own) else own.astype(np.int64))
                    bits.append(sketch(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(n) if n else [], pa.int64()),
                                              pa.array(np.concatenate(fp) if fp else [], pa.int64()),
                                              pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                                             names=["rk", "doc_id", "n", "fp", "prefix", "bits"])

    rows = docs.select(F.xxhash64(doc_id, text).alias("rk"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("t"))
    return map_arrow(rows, sets, extended(rows.drop("t"), n="long", fp="long", prefix="array<long>", bits="binary"))


def _groups(prefix: DataFrame, size: int) -> DataFrame:
    """(token, block, many, members): the classes that share a prefix shingle, in blocks of at most
    ``size``; ``many`` marks groups of several blocks.  Shingles of one class give nothing."""
    def gather(batches):
        held, token, block, out = [], None, 0, []

        def close(many):
            if many or block or len(held) > 1:
                out.append((token, block, many or block > 0, list(held)))

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                                               pa.array([r[2] for r in out], pa.bool_()), pa.array([r[3] for r in out], pa.list_(pa.int64()))],
                                              names=["token", "block", "many", "members"])
            out.clear()
            return made

        for batch in batches:
            t, f = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]]) if len(t) else np.zeros(1, np.int64)
            length = np.diff(edge)
            # runs of one row inside the batch are shingles of one class
            for i in np.flatnonzero((length > 1) | (edge[:-1] == 0) | (edge[1:] == len(t))):
                lo, hi = edge[i], edge[i + 1]
                if t[lo] != token:
                    if token is not None:
                        close(False)
                    held, token, block = [], t[lo], 0
                members = f[lo:hi].tolist()
                while len(held) + len(members) > size:
                    cut_at = size - len(held)
                    held, members = held + members[:cut_at], members[cut_at:]
                    close(True)
                    held, block = [], block + 1
                held = held + members
            if len(out) > 5000:
                yield flush()
        if token is not None:
            close(False)
        if out:
            yield flush()

    rows = prefix.repartition("token").sortWithinPartitions("token", "fp")
    return map_arrow(rows, gather, "token long, block int, many boolean, members array<long>")


def _group_edges(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate edges (a, b) of groups given as rows (gid, fp, n, bits)."""
    def edges(batches):
        held = None

        def of(part):
            fp, n, bits = part
            return group_edges(fp, n, bits, percent) if len(fp) > 1 else []

        def batch_of(found):
            return pa.record_batch([pa.array([e[0] for e in found], pa.int64()), pa.array([e[1] for e in found], pa.int64())], names=["a", "b"])

        last = None
        for batch in batches:
            g, fp, n = (batch.column(i).to_numpy() for i in range(3))
            bits = batch.column(3).to_pylist()
            edge = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]]) if len(g) else np.zeros(1, np.int64)
            found = []
            for lo, hi in zip(edge[:-1], edge[1:]):
                part = (fp[lo:hi], n[lo:hi], bits[lo:hi])
                if g[lo] == last:
                    held = (np.concatenate([held[0], part[0]]), np.concatenate([held[1], part[1]]), held[2] + part[2])
                else:
                    if held is not None:
                        found += of(held)
                    held, last = part, g[lo]
            if found:
                yield batch_of(found)
        if held is not None:
            found = of(held)
            if found:
                yield batch_of(found)

    rows = rows.select("gid", "fp", "n", "bits").repartition("gid").sortWithinPartitions("gid", "fp")
    return map_arrow(rows, edges, "a long, b long")


def _true_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of blocks given as rows (c, b, q, fp, tokens, query)."""
    def links(t):
        fp, at = np.unique(t["fp"].to_numpy(), return_index=True)
        query = np.zeros(len(fp), bool)
        asked = t["query"].to_numpy(zero_copy_only=False)
        np.logical_or.at(query, np.searchsorted(fp, t["fp"].to_numpy()), asked)
        tokens = t["tokens"].combine_chunks()
        flat, off = tokens.flatten().to_numpy().view(U), tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
        found = block_links([flat[off[i]: off[i + 1]] for i in at], query, percent) if len(fp) > 1 and query.any() else []
        return pa.table({"a": pa.array([int(fp[x]) for x, _ in found], pa.int64()), "b": pa.array([int(fp[y]) for _, y in found], pa.int64())})

    ship(rows.sparkSession)
    # dealt by the whole key: after joins on the cluster alone, one task would have all its blocks
    return rows.repartition("c", "b", "q").groupBy("c", "b", "q").applyInArrow(links, "a long, b long")


def _links(docs: DataFrame, clusters: DataFrame, reps: DataFrame, counts, doc_id: str, text: str, k: int, percent: int,
           cluster_block: int) -> DataFrame:
    """The verified links (a, b) of all candidate clusters, given as edges (pivot a, member b)."""
    sizes = clusters.groupBy("a").agg((F.count("*") + 1).alias("size"))
    one = F.struct(F.col("a").alias("c"), F.col("b").alias("v"), F.lit(False).alias("is_pivot"))
    members = clusters.select(one.alias("m")).select("m.*").unionByName(sizes.select(F.col("a").alias("c"), F.col("a").alias("v"), F.lit(True).alias("is_pivot")))
    blocks = F.ceil(F.col("size") / cluster_block).cast("int")
    place = F.struct("c", blocks.alias("blocks"), "is_pivot", F.pmod(F.xxhash64("v"), blocks).cast("int").alias("block"))
    members = members.join(sizes.withColumnRenamed("a", "c"), "c").groupBy("v").agg(F.collect_list(place).alias("places"))
    members = cut(members.join(reps.select(F.col("fp").alias("v"), "rk"), "v").select("rk", F.col("v").alias("cfp"), "places"))
    picked = attach(docs.select(F.xxhash64(doc_id, text).alias("rk"), F.col(text).cast("string").alias("t")), members, ["rk"], F.col("rk"), "inner")
    picked = picked.dropDuplicates(["rk"])

    def sets(batches):
        common = counts.value
        for batch in batches:
            parts = []
            for _, _, data, off in texts.chunks(batch.column(0)):
                token, at = shingle_sets(data, off, common, k)
                parts += [token[lo:hi].astype(np.int64) for lo, hi in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(parts, pa.list_(pa.int64()))], names=[*batch.schema.names[1:], "tokens"])

    picked = picked.select("t", F.col("cfp").alias("fp"), "places")
    rows = cut(map_arrow(picked, sets, extended(picked.drop("t"), tokens="array<long>")))
    rows = rows.select("fp", "tokens", F.explode("places").alias("p")).select("p.*", "fp", "tokens")
    whole = rows.filter("blocks = 1").select("c", F.lit(0).alias("b"), F.lit(0).alias("q"), "fp", "tokens", F.lit(True).alias("query"))
    large = rows.filter("blocks > 1")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    none = F.lit(0).alias("q")
    star = (large.filter("not is_pivot").select("c", F.col("block").alias("b"), none, "fp", "tokens", F.lit(False).alias("query"))
            .unionByName(large.filter("is_pivot").select("c", every.alias("b"), none, "fp", "tokens", F.lit(True).alias("query"))))
    found = cut(_true_links(whole.unionByName(star), percent))
    # sets that their pivot does not link meet all blocks, in blocks of their own
    # (a pivot is the smallest number of its cluster, as is the first of a star)
    linked = found.select(F.col("a").alias("c"), F.col("b").alias("fp")).distinct()
    alone = large.filter("not is_pivot").join(linked, ["c", "fp"], "left_anti")
    askers = cut(alone.groupBy("c").agg(F.ceil(F.count("*") / cluster_block).cast("int").alias("qs")))
    if askers.isEmpty():
        return found
    part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("qs")).cast("int")
    ask = alone.join(askers, "c").select("c", every.alias("b"), part.alias("q"), "fp", "tokens", F.lit(True).alias("query"))
    meet = large.join(askers, "c").select("c", F.col("block").alias("b"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"), "fp", "tokens",
                                          F.lit(False).alias("query"))
    return found.unionByName(_true_links(ask.unionByName(meet), percent))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT,
                       group_block: int = GROUP_BLOCK, cluster_block: int = CLUSTER_BLOCK) -> DataFrame:
    """(rk, doc_id, n_shingles, component_id, group_id): one row for each row of ``docs``; ``rk`` is
    ``xxhash64(doc_id, text)``, ``group_id`` a number of the component that no id can spoil.

    Words are runs without ASCII spaces, A-Z in lower case.  A text of fewer than ``k`` words is one
    shingle; a text without words (or null) has none and is linked with nothing: its component is its own id.
    ``component_id`` is the smallest id of the component (null only if all its ids are null); repeated
    rows are linked like any equal sets.  An empty table gives no rows."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(word_counts(docs, text))
    base = cut(_base(docs, counts, doc_id, text, k, percent))
    reps = cut(base.filter("n > 0").groupBy("fp").agg(F.first("n").alias("n"), F.min("rk").alias("rk"), F.min("doc_id").alias("least"),
                                                      F.first("prefix").alias("prefix"), F.first("bits").alias("bits")))
    groups = cut(_groups(reps.select(F.explode("prefix").alias("token"), "fp"), group_block))
    many = groups.filter("many")
    pairs = (many.alias("x").join(many.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.block") < F.col("y.block")))
             .select(F.concat("x.members", "y.members").alias("members")))
    sets = groups.select("members").unionByName(pairs).withColumn("gid", F.xxhash64("members")).dropDuplicates(["gid"])
    looked = sets.select("gid", F.explode("members").alias("fp")).join(reps.select("fp", "n", "bits"), "fp")
    candidates = cut(_group_edges(looked, percent).distinct())
    labels = reps.select("fp", F.col("fp").alias("group_id"), F.col("least").alias("component_id"))
    if not candidates.isEmpty():
        links = cut(_links(docs, candidates, reps, counts, doc_id, text, k, percent, cluster_block))
        if not links.isEmpty():
            found = components(links).withColumnRenamed("v", "fp")
            linked = reps.select("fp", "least").join(found, "fp")
            least = linked.groupBy("c").agg(F.min("least").alias("l"))
            found = cut(found.join(least, "c").select(F.col("fp").alias("v"), "c", "l"))
            labels = labels.join(found, F.col("fp") == F.col("v"), "left").select(
                "fp", F.coalesce("c", "group_id").alias("group_id"), F.when(F.col("v").isNull(), F.col("component_id")).otherwise(F.col("l")).alias("component_id"))
    labels = cut(labels.withColumnRenamed("fp", "v"))
    rows = base.drop("prefix", "bits").join(labels, (F.col("fp") == F.col("v")) & (F.col("n") > 0), "left")
    return rows.select("rk", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                       F.coalesce("group_id", "rk").alias("group_id"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


OP3_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM t WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 85 * (a.n + b.n - common)),
r AS (SELECT doc_id, doc_id AS id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.id) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when of each component only the smallest id does (of rows that
    share that id, the one with the smallest hash; of fully equal rows one).  Texts without words stay."""
    found = jaccard_components(docs, doc_id, text, **options)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk"))
    found = cut(found)
    stay = found.groupBy("group_id").agg(first.alias("f")).select(F.col("f.rk").alias("rk"))
    gone = cut(found.select("rk").distinct().join(stay.distinct(), "rk", "left_anti").withColumn("gone", F.lit(True)))
    twice = cut(found.groupBy("rk").agg(F.count("*").alias("n")).filter("n > 1").select("rk", F.lit(True).alias("twice")))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.xxhash64(doc_id, text).alias("rk"))
    rows = attach(rows, gone, ["rk"], F.col("rk")).filter("gone is null").drop("gone")
    rows = attach(rows, twice, ["rk"], F.col("rk"))
    rows = rows.filter("twice is null").unionByName(rows.filter("twice").dropDuplicates(["rk"]))
    return rows.select("row.*")


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: five-word shingles, similarity 0.8; one document of each group stays."""
    return keep_one(docs, k=5, percent=80)
