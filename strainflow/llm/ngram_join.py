"""N-gram Jaccard join: sets of word shingles, globally ordered, joined through prefix trees.

1. Each text's set of shingle hashes (64 bits) and its digest: equal sets are one set from here
   on. The same scan counts shingles in a sketch of fixed size, which makes the global order:
   rarest first. Any order gives the same links; this one keeps common passages out of prefixes.
2. If two sets link, their prefixes (the first n - ceil(t * n) + 1 in that order) share a shingle,
   and their sizes are in the same or in neighbouring bands. Prefix entries are reduced to one set
   for each shingle and band before the shuffle, and those that share a shingle and are a band
   apart at most are chained. Chains make clusters: no link leaves a cluster, and sets alone in
   theirs are done. A set's signature has a bit for each of about as many bins as it has shingles: whether
   an odd number of them fall there. Where two signatures differ a shingle of one set only falls, so
   sets with more such bins than a link allows have none. Only the sets of a cluster that some other's
   signature allows go on, in clusters of their own: of sets that merely share a prefix shingle no shingles travel.
3. A cluster's sets go into a prefix tree in the global order, read from its common end so that
   near copies share long paths; a set walks the tree counting overlap once for all sets below,
   a level of the live nodes at a time. An edge is read only where the set's tokens from there on
   and the lengths below can still reach the overlap that a link needs, and where some set below
   isn't known to be of the walking set's component.
4. Clusters beyond BLOCK_SETS sets or BLOCK_TOKENS shingles are split by size band and, within it,
   into blocks; two sets of a band are in all its blocks. Sets outside the cluster's largest component
   so far then go into trees that the sets of their band and its neighbours stream past, in parts in
   which some set shares a shingle of their prefix; sets whose prefixes share shingles with their own
   component only stay away. Sets that are alike below the threshold in great
   numbers are the dear case: a group of g of them costs g * g / 4000 reads of a signature (a 32nd to a 64th of a
   set), and of a set where signatures can't tell them from links. Only links between components are emitted, enough to connect them.

Memory: a task holds one tree, bounded by sets and by shingles. No cluster, bucket or component
is gathered whole. Sets are known by 64 bits of a digest, as shingles are.

Defined cases: null and empty texts, or texts without words, have an empty set (n_shingles 0) and
are their own component; equal texts and repeated rows share a component; a null doc_id takes the
least doc_id of its component, or null. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainflow.llm.common import bounded_batches, delete, materialize, new_path, parts_for, table, written
from strainflow.llm.components import components
from strainflow.llm.words import NOT_SPACE, chunks, words

SKETCH_BITS = 20
SLICE_BITS = 16
#: What a block of a cluster holds at most: sets, and shingles in all.
BLOCK_SETS, BLOCK_TOKENS = 500, 1 << 20
#: Trees of sets that other sets stream past, and these streams, are so many times a block.
TREE_BLOCKS, STREAM_BLOCKS = 4, 8
#: Tables of large clusters or of their blocks with more rows aren't broadcast.
BROADCAST_ROWS = 100_000
#: What a side of a group of signatures holds at most: sets, and bytes in all.
SIGNED_SETS, SIGNED_BYTES = 4000, 8 << 20
#: What a set is to its group: in the tree and walking it, in the tree only, walking only. Of signatures:
#: compared with all, or with those of the other role.
BOTH, STAYS, WALKS = 0, 1, 2
#: Prefix entries that one task groups.
BUCKET_ENTRIES = 400_000


def row_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    w = words(texts, NOT_SPACE)
    whole = w.shingles(width)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            keep, w.hash = w.hash, w.hash[a:b]
            out.append(w.shingles(b - a))
            w.hash = keep
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64(tokens.tobytes()).intdigest() - (1 << 63)


def _level(n: int) -> int:
    """The bits of a signature of n shingles: n to 2 * n, a power of two."""
    return 1 << max(6, (n - 1).bit_length())


def _signature(tokens: np.ndarray) -> bytes:
    """A bit for each bin, 1 where an odd number of the shingles fall: bins in which two sets differ
    are no more than the shingles that only one of them has."""
    bits = _level(len(tokens))
    at = ((tokens >> np.uint64(SKETCH_BITS)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _scan(width: int, schema: pa.Schema):
    """(id, key, n, signature) of each row, and the partition's sketch of shingle counts in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int32)
        for batch in chunks(batches):
            sets = row_sets(batch.column(1), width)
            if sets:
                counts += np.bincount((np.concatenate(sets) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.int32)
            n, k = [len(s) for s in sets], len(sets)
            yield pa.record_batch([batch.column(0), pa.array([_key(s) if len(s) else None for s in sets], pa.int64()), pa.array(n, pa.int32()), pa.array([_signature(s) if len(s) else None for s in sets], pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=schema)
        if counts.any():
            k = 1 << (SKETCH_BITS - SLICE_BITS)
            yield pa.record_batch([pa.nulls(k, schema.field(0).type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array([x.tobytes() for x in np.split(counts, k)], pa.binary())], schema=schema)

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(x.as_buffer(), np.int32).astype(np.int64)
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slice", "counts"])


def _ordered(tokens: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """tokens (sorted) in the global order: by the sketch's count, then by value."""
    return tokens[np.argsort(rank[(tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)], kind="stable")]


def _band_width(percent: int) -> float:
    """Sizes that can link are less than one band apart, so in the same or in neighbouring bands."""
    return 1.001 * max(0.01, math.log(100 / percent))


def _prefixes(width: int, percent: int, buckets: int, rank):
    """Prefix entries of the partition's distinct sets, packed by bucket of the shingle: for each
    shingle and size band one set; the others that have both are tied to it by an edge (a, b)."""
    names = ["bucket", "token", "key", "band", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def flush():
            token = np.concatenate([t for t, _, _ in held])
            lengths = [len(t) for t, _, _ in held]
            key = np.repeat(np.array([k for _, k, _ in held], np.int64), lengths)
            band = np.repeat(np.array([n for _, _, n in held], np.int32), lengths)
            order = np.lexsort((band, token))
            token, key, band = token[order], key[order], band[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (band[1:] != band[:-1])
            first = np.flatnonzero(new)
            head = key[first][np.cumsum(new) - 1]
            tied = np.flatnonzero(head != key)
            pairs = np.unique(np.stack([head[tied], key[tied]]), axis=1)
            token, key, band = token[first], key[first], band[first]
            bucket = ((token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cut))
            packed = [[x[cut[b] : cut[b + 1]].tobytes() for b in full] for x in (token, key, band)]
            none = pa.nulls(len(full), pa.binary())
            yield pa.record_batch([pa.array(full.astype(np.int32)), *(pa.array(p, pa.binary()) for p in packed), none, none], names)
            for k in range(0, pairs.shape[1], 50_000):
                none = pa.nulls(1, pa.binary())
                some = [pa.array([x[k : k + 50_000].tobytes()], pa.binary()) for x in pairs]
                yield pa.record_batch([pa.array([int(pairs[0, k]) % buckets], pa.int32()), none, none, none, *some], names)

        for batch in chunks(batches):
            for tokens in row_sets(batch.column(0), width):
                if len(tokens) and (key := _key(tokens)) not in seen:
                    seen.add(key)
                    part = _ordered(tokens, rank.value)[: _prefix(len(tokens), percent)]
                    held.append((part, key, int(math.log(len(tokens)) / _band_width(percent))))
                    size += len(part)
            if size >= 1_000_000:
                yield from flush()
                seen, held, size = set(), [], 0
        if held:
            yield from flush()

    return run


_PACKED = "bucket int, token binary, key binary, band binary, a binary, b binary"


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sets next to each other by band among those that share a prefix shingle, and the
    edges that were found before the shuffle."""
    held: dict[int, list] = {}

    def out(a: np.ndarray, b: np.ndarray):
        for k in range(0, len(a), 50_000):
            yield pa.record_batch([pa.array(a[k : k + 50_000]), pa.array(b[k : k + 50_000])], ["a", "b"])

    for batch in batches:
        for bucket, *x, a, b in zip(*(batch.column(i) for i in range(6)), strict=True):
            if a.is_valid:
                yield from out(np.frombuffer(a.as_py(), np.int64), np.frombuffer(b.as_py(), np.int64))
            else:
                held.setdefault(bucket.as_py(), []).append(tuple(v.as_py() for v in x))
    for bucket in list(held):
        parts = held.pop(bucket)
        token, key, band = (np.frombuffer(b"".join(p[i] for p in parts), kind) for i, kind in enumerate((np.uint64, np.int64, np.int32)))
        order = np.lexsort((key, band, token))
        token, key, band = token[order], key[order], band[order]
        near = (token[1:] == token[:-1]) & (key[1:] != key[:-1]) & (band[1:] - band[:-1] <= 1)
        yield from out(*np.unique(np.stack([key[:-1][near], key[1:][near]]), axis=1))


def _allowed(percent: int, key: np.ndarray, n: np.ndarray, role: np.ndarray, signs: list[bytes]) -> list[tuple[int, int]]:
    """(root, key) of the sets whose signatures allow links, with the least key that these connect each with."""
    order = np.argsort(n, kind="stable")
    key, n, role, signs = key[order], n[order], role[order], [signs[k] for k in order]
    label = np.arange(len(n))
    reach = np.searchsorted(n * percent, 100 * n, "right")
    levels = np.array([8 * len(x) for x in signs])
    for bits in np.unique(levels).tolist():
        a, b = np.searchsorted(levels, [bits, bits + 1])
        stop = int(reach[b - 1])
        folded = np.empty((stop - a, bits // 64), np.uint64)
        for k in range(a, stop):  # larger signatures are folded to this one's bins
            folded[k - a] = np.bitwise_xor.reduce(np.frombuffer(signs[k], np.uint64).reshape(-1, bits // 64), axis=0)
        for i in range(a, b):
            near = np.arange(i + 1, reach[i])
            near = near[(label[near] != label[i]) & ((role[near] == BOTH) | (role[near] != role[i]))]
            for k in range(0, len(near), 500):
                some = near[k : k + 500]
                differ = np.bitwise_count(folded[some - a] ^ folded[i - a]).sum(axis=1, dtype=np.int64)
                for j in some[differ * (100 + percent) <= (n[some] + n[i]) * (100 - percent)].tolist():
                    if label[i] != label[j]:
                        label[label == label[j]] = label[i]
    sizes, root = np.bincount(label, minlength=len(n)), np.full(len(n), np.iinfo(np.int64).max)
    np.minimum.at(root, label, key)
    return [(int(root[x]), int(k)) for x, k in zip(label.tolist(), key, strict=True) if sizes[x] > 1]


def _signed(percent: int):
    """Rows (group, key, n, role, signature), sorted by group, to the pairs of _allowed(). A set is compared with
    all others (BOTH), or with those of the other role."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out():
            key, n, role, signs = zip(*held, strict=True)
            pairs = _allowed(percent, np.array(key, np.int64), np.array(n, np.int64), np.array(role), list(signs))
            return pa.record_batch([pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for group, *row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if group != now:
                    if held:
                        yield out()
                    now, held = group, []
                held.append(row)
        if held:
            yield out()

    return run


class Tree:
    """A path-compressed prefix tree of ordered sets. A node: [tokens of its edge, children by
    first token, sets that end here, fewest and most tokens below it]."""

    def __init__(self):
        self.root = [np.zeros(0, np.uint64), {}, [], 1 << 60, 0]

    def add(self, tokens: np.ndarray, name: int) -> None:
        node, at = self.root, 0
        while True:
            left = len(tokens) - at
            node[3], node[4] = min(node[3], left), max(node[4], left)
            if not left:
                node[2].append(name)
                return
            begin = int(tokens[at])
            child = node[1].get(begin)
            if child is None:
                node[1][begin] = [tokens[at:], {}, [name], 0, 0]
                return
            edge = child[0]
            most = min(len(edge), left)
            other = edge[:most] != tokens[at : at + most]
            k = int(other.argmax()) if other.any() else most
            if k < len(edge):
                low, high = child[3] + len(edge) - k, child[4] + len(edge) - k
                child[0], rest = edge[k:], child
                child = [edge[:k], {int(edge[k]): rest}, [], low, high]
                node[1][begin] = child
            node, at = child, at + k


class FlatTree:
    """A tree's nodes in arrays, level by level. Shingles are known by their place in the order of
    the paths, so that what a set has left from some place on is a matter of two numbers."""

    def __init__(self, tree: Tree, rank: np.ndarray):
        nodes, parents, children, self.levels, at = [tree.root], [0], [], [], 0
        while at < len(nodes):
            stop = len(nodes)
            self.levels.append((at, stop))
            for k in range(at, stop):
                nodes[k] = self._stepped(nodes[k])
                below = list(nodes[k][1].values())
                children.append((len(nodes), len(below)))
                nodes += below
                parents += [k] * len(below)
            at = stop
        self.parent = np.array(parents, np.int64)
        self.child, self.children = np.array(children, np.int64).T
        self.edge = np.array([len(x[0]) for x in nodes], np.int64)
        self.begin = np.cumsum(self.edge) - self.edge
        self.depth = self.edge.copy()
        for a, b in self.levels[1:]:
            self.depth[a:b] += self.depth[self.parent[a:b]]
        self.low, self.high = np.array([x[3] for x in nodes], np.int64), np.array([x[4] for x in nodes], np.int64)
        self.names = [x[2] for x in nodes]
        self.ends = np.array([bool(x[2]) for x in nodes])
        self.known, values = np.unique(np.concatenate([x[0] for x in nodes]), return_inverse=True)
        # paths begin at the common end: the reverse of (count in the sketch, value)
        order = np.argsort(rank[(self.known & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)], kind="stable")[::-1]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.tokens = self.place[values].astype(np.int32)
        self.mark = np.zeros(len(self.known), np.uint8)
        self.named = np.repeat(np.arange(len(nodes)), [len(x) for x in self.names])
        self.all_names = [x for some in self.names for x in some]
        self.least, self.most = np.zeros(len(nodes), np.int64), np.ones(len(nodes), np.int64)

    @staticmethod
    def _stepped(node: list) -> list:
        """The node with only the first step of a long edge, so that walks can leave within it."""
        edge, below, names, low, high = node
        step = max(32, len(edge) // 8)
        if len(edge) <= step:
            return node
        rest = edge[step:]
        return [edge[:step], {int(rest[0]): [rest, below, names, low, high]}, [], low + len(rest), high + len(rest)]

    def label(self, labels: list[int]) -> None:
        """Each node's least and greatest label of the sets below it; labels are those of all_names."""
        bounds = np.iinfo(np.int64)
        self.least, self.most = np.full(len(self.names), bounds.max), np.full(len(self.names), bounds.min)
        np.minimum.at(self.least, self.named, labels)
        np.maximum.at(self.most, self.named, labels)
        for a, b in reversed(self.levels[1:]):
            np.minimum.at(self.least, self.parent[a:b], self.least[a:b])
            np.maximum.at(self.most, self.parent[a:b], self.most[a:b])

    def links(self, tokens: np.ndarray, percent: int, label: int | None = None) -> list[int]:
        """Names of sets y with 100 * overlap >= percent * union, without those in subtrees that
        have one label only, the given one."""
        n, out = len(tokens), []
        if not len(self.known):
            return out
        at = np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)
        at = np.sort(self.place[at[self.known[at] == tokens]])
        if 100 * len(at) < percent * n:  # too few tokens are in the tree at all
            return out

        def live(overlap: np.ndarray, left: np.ndarray, depth: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Where the most that a set below can still share makes a link, at the size where it helps most."""
            best = overlap + np.minimum(left, high)
            size = np.maximum(depth + low, depth - overlap + best)
            return 100 * best >= percent * (n + size - best)

        self.mark[at] = 1
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(nodes):
            times = self.children[nodes]
            ends = np.cumsum(times)
            below = np.repeat(self.child[nodes] - ends + times, times) + np.arange(ends[-1])
            overlap = np.repeat(overlap, times)
            edge = self.edge[below]
            # before an edge is read: the set's tokens from the edge's first on are all that is left
            left = len(at) - np.searchsorted(at, self.tokens[self.begin[below]])
            keep = live(overlap, left, self.depth[below] - edge, edge + self.low[below], edge + self.high[below])
            if label is not None:
                keep &= (self.least[below] != label) | (self.most[below] != label)
            below, overlap, edge = below[keep], overlap[keep], edge[keep]
            if not len(below):
                break
            ends = np.cumsum(edge)
            spots = np.arange(ends[-1], dtype=np.int32)
            spots += np.repeat((self.begin[below] - ends + edge).astype(np.int32), edge)
            shared = self.mark.take(self.tokens.take(spots))
            overlap = overlap + np.add.reduceat(shared, ends - edge, dtype=np.int32)
            depth = self.depth[below]
            hit = self.ends[below] & (100 * overlap >= percent * (n + depth - overlap))
            for node in below[hit].tolist():
                out += self.names[node]
            left = len(at) - np.searchsorted(at, self.tokens[self.begin[below] + edge - 1], "right")
            keep = (self.children[below] > 0) & live(overlap, left, depth, self.low[below], self.high[below])
            nodes, overlap = below[keep], overlap[keep]
        self.mark[at] = 0
        return out


class Block:
    """Sets in a tree, and sets that walk it; `found` has the links that connect what the given
    components have apart, a spanning forest. Tokens are in the global order. A walk passes by
    subtrees whose sets were all of its component when the tree was labelled last."""

    def __init__(self, percent: int, rank: np.ndarray):
        self.percent, self.rank, self.tree, self.flat, self.labelled = percent, rank, Tree(), None, 0
        self.component: dict[int, int] = {}
        self.parent: dict[int, int] = {}
        self.found: list[tuple[int, int]] = []

    def _root(self, name: int) -> int:
        x = self.component[name]
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def _known(self, name: int, component: int) -> None:
        self.component.setdefault(name, component)
        self.parent.setdefault(component, component)

    def add(self, name: int, component: int, tokens: np.ndarray) -> None:
        if name not in self.component:
            self._known(name, component)
            self.tree.add(tokens[::-1], name)

    def walk(self, name: int, component: int, tokens: np.ndarray) -> None:
        self._known(name, component)
        if self.flat is None:
            self.flat = FlatTree(self.tree, self.rank)
            self.flat.label([self._root(x) for x in self.flat.all_names])
        elif 32 * (len(self.found) - self.labelled) > len(self.flat.all_names):
            self.flat.label([self._root(x) for x in self.flat.all_names])
            self.labelled = len(self.found)
        for other in self.flat.links(tokens, self.percent, self._root(name)):
            a, b = self._root(name), self._root(other)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                self.found.append((name, other))


def _blocks(percent: int, rank):
    """Rows (group, key, component, role, tokens), sorted by group and role, to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, own = None, Block(percent, rank.value), []

        def out():
            for x in own:
                block.walk(*x)
            return pa.record_batch([pa.array([x[0] for x in block.found], pa.int64()), pa.array([x[1] for x in block.found], pa.int64())], ["a", "b"])

        for batch in batches:
            for group, key, comp, role, tokens in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                if group != now:
                    if now is not None:
                        yield out()
                    now, block, own = group, Block(percent, rank.value), []
                tokens = np.frombuffer(tokens.as_py(), np.uint64)
                if role == WALKS:
                    block.walk(key, comp, tokens)
                elif key not in block.component:
                    block.add(key, comp, tokens)
                    if role == BOTH:
                        own.append((key, comp, tokens))
        if now is not None:
            yield out()

    return run


def _in_groups(rows: DataFrame, percent: int, rank) -> DataFrame:
    """rows (group string, key, component, role, tokens), a task to many groups, to links (a, b)."""
    dealt = rows.repartition("group").sortWithinPartitions("group", "role", "key")
    return dealt.select("group", "key", "component", "role", "tokens").mapInArrow(_blocks(percent, rank), "a bigint, b bigint")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _parts(block_sets: int, times: int = 1):
    """How many parts of so many blocks hold `sets` sets of `size` shingles in all."""
    return F.greatest(F.ceil(F.col("sets") / (times * block_sets)), F.ceil(F.col("size") / (times * BLOCK_TOKENS))).cast("int")


def _dealt(parts: str, seed: int):
    return F.pmod(F.xxhash64("key", F.lit(seed)), F.col(parts)).cast("int")


def _near_clusters(sets: DataFrame, percent: int, most: int) -> DataFrame:
    """(key, cluster): the sets (key, n, signature, cluster) that signatures allow a link in their cluster,
    in the parts that these links would make. Clusters of more than `most` sets are compared by size band, and
    within bands in parts, a group to two parts."""
    name = lambda *c: F.concat_ws("/", *c)
    role = lambda x: F.lit(x).alias("role")
    parts = F.greatest(F.ceil(F.col("sets") / most), F.ceil(F.col("size") / SIGNED_BYTES)).cast("int")
    totals = (F.count("*").alias("sets"), F.sum(F.octet_length("signature")).alias("size"))
    large = materialize(sets.groupBy("cluster").agg(*totals).filter(parts > 1).select("cluster"), "large-signed")
    own = sets.join(_small(large), "cluster", "left_anti").select(name("cluster").alias("group"), "key", "n", role(BOTH), "signature")

    def compared(rows: DataFrame) -> DataFrame:
        dealt = rows.select("group", "key", "n", "role", "signature").repartition("group").sortWithinPartitions("group")
        return dealt.mapInArrow(_signed(percent), "a bigint, b bigint")

    # a whole cluster in one group is done with it; what several groups found is put together
    found = compared(own).select(F.col("b").alias("key"), F.col("a").alias("cluster"))
    if large.limit(1).count():
        big = sets.join(_small(large), "cluster").withColumn("band", F.floor(F.log("n") / _band_width(percent)).cast("int"))
        cells = materialize(big.groupBy("cluster", "band").agg(*totals).select("cluster", "band", parts.alias("parts")), "signed-cells")
        placed = big.join(_small(cells), ["cluster", "band"]).withColumn("part", _dealt("parts", 17))
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        other = cells.select("cluster", F.col("band").alias("band2"), F.col("parts").alias("parts2"))
        pairs = cells.join(other, "cluster").filter("band2 - band between 0 and 1").withColumn("part", every("parts")).withColumn("part2", every("parts2"))
        pairs = pairs.filter("band2 > band or part2 >= part").withColumn("alone", F.expr("band2 = band and part2 = part"))
        pairs = materialize(pairs.select("cluster", "band", "part", "band2", "part2", "alone", name("cluster", "band", "part", "band2", "part2").alias("group")), "signed-pairs")
        at = ["cluster", "band", "part"]
        left = pairs.select(*at, "group", F.when(F.col("alone"), BOTH).otherwise(STAYS).alias("role"))
        right = pairs.filter("not alone").select("cluster", F.col("band2").alias("band"), F.col("part2").alias("part"), "group", role(WALKS))
        found = found.union(components(compared(placed.join(_small(left.union(right)), at)), "near"))
    return materialize(found, "near-clusters")


def _prefix_tokens(percent: int):
    """Rows (key, cluster, band, stream, rest, component, tokens), to the tokens of their prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            some = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(6)]
            yield pa.record_batch([*batch.columns[:6], pa.array([x[: _prefix(len(x), percent)] for x in some], pa.list_(pa.int64()))], batch.schema.names)

    return run


def _links_of(sets: DataFrame, path: str, percent: int, block_sets: int, rank) -> DataFrame:
    """(a, b): links that connect the sets (key, n, tokens, cluster) of each component; sets are
    the table at path, which goes once it is read."""
    name = lambda *c: F.concat_ws("/", *c)
    role = lambda x: F.lit(x).alias("role")
    whole = F.col("key").alias("component")
    totals = (F.count("*").alias("sets"), F.sum("n").alias("size"))
    large = materialize(sets.groupBy("cluster").agg(*totals).filter((F.col("sets") > block_sets) | (F.col("size") > BLOCK_TOKENS)), "large-clusters")
    own = sets.join(_small(large), "cluster", "left_anti").select(name("cluster").alias("group"), "key", whole, role(BOTH), "tokens")
    if not large.limit(1).count():
        links = materialize(_in_groups(own, percent, rank), "links")
        delete(sets.sparkSession, path)
        return links

    big = sets.join(_small(large.select("cluster")), "cluster").withColumn("band", F.floor(F.log("n") / _band_width(percent)).cast("int"))
    cells = big.groupBy("cluster", "band").agg(*totals, F.min("key").alias("k0"), F.max("key").alias("k1"))
    cells = materialize(cells.withColumns({"blocks": _parts(block_sets), "streams": _parts(block_sets, STREAM_BLOCKS)}).drop("sets", "size"), "cells")
    placed = big.join(_small(cells), ["cluster", "band"]).withColumns({"block": _dealt("blocks", 7), "stream": _dealt("streams", 13)})
    placed_path = new_path(sets.sparkSession, "placed-sets")
    placed = written(placed, placed_path)
    group = name("cluster", "band", "block").alias("group")
    ends = placed.filter("blocks > 1 and (key = k0 or key = k1)").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    within = placed.select(group, "key", whole, role(BOTH), "tokens").union(ends.select(group, "key", whole, role(STAYS), "tokens"))
    links = materialize(_in_groups(own.union(within), percent, rank), "links")
    delete(sets.sparkSession, path)

    known = components(links, "linked")
    labelled = placed.join(known, F.col("key") == F.col("node"), "left").withColumn("component", F.coalesce("root", "key"))
    labelled = materialize(labelled.select("key", "n", "tokens", "cluster", "band", "stream", "component"), "labelled-sets")
    delete(sets.sparkSession, placed_path)
    parts = labelled.groupBy("cluster", "component").agg(F.count("*").alias("m"))
    main = parts.groupBy("cluster").agg(F.max(F.struct("m", "component")).alias("m")).select("cluster", F.col("m.component").alias("main"))
    marked = labelled.join(_small(main), "cluster").select("key", "cluster", "band", "stream", (F.col("component") != F.col("main")).alias("rest"), "component", "tokens")
    entries = marked.mapInArrow(_prefix_tokens(percent), "key bigint, cluster bigint, band int, stream int, rest boolean, component bigint, tokens array<bigint>")
    prefixes_path = new_path(sets.sparkSession, "large-prefixes")
    entries = written(entries.withColumn("token", F.explode("tokens")).drop("tokens"), prefixes_path)
    # a link between components shares a shingle of both prefixes, so one that several components have
    ends = entries.groupBy("cluster", "token").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    entries = materialize(entries.join(ends.filter("c0 != c1"), ["cluster", "token"], "left_semi").drop("component"), "shared-prefixes")
    delete(sets.sparkSession, prefixes_path)
    meeting = entries.select(F.col("key").alias("_key")).distinct()
    at = ["cluster", "target", "stream"]
    there = entries.select("token", "cluster", F.col("band").alias("target"), "stream").distinct()
    asking = entries.filter("rest").select("key", "cluster", "band", "token").join(there, ["cluster", "token"]).filter("abs(band - target) <= 1")
    asking = materialize(asking.select("key", *at).distinct(), "asking")
    probes = labelled.select("key", "n", "tokens", "component")
    chunked = asking.join(probes.select("key", "n"), "key").groupBy(*at).agg(*totals).select(*at, _parts(block_sets, TREE_BLOCKS).alias("chunks"))
    chunked = materialize(chunked, "chunks")
    asked = name("cluster", "target", "stream", "chunk").alias("group")
    asking = asking.join(_small(chunked), at).withColumn("chunk", _dealt("chunks", 11)).select(asked, "key").join(probes, "key")
    walking = labelled.join(meeting, F.col("key") == F.col("_key"), "left_semi")
    meets = walking.withColumnRenamed("band", "target").join(_small(chunked), at).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    across = asking.select("group", "key", "component", role(STAYS), "tokens").union(meets.select(asked, "key", "component", role(WALKS), "tokens"))
    return materialize(links.union(_in_groups(across, percent, rank)), "all-links")


def link(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, block_sets: int = BLOCK_SETS, signed_sets: int = SIGNED_SETS) -> DataFrame:
    """(id_col, n_shingles, component_id): a row for each row of docs; two documents link when
    100 * shared shingles >= percent * all shingles of both."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    bounded_batches(spark)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = [("id", docs.schema[id_col].dataType), ("key", T.LongType()), ("n", T.IntegerType()), ("signature", T.BinaryType()), ("slice", T.IntegerType()), ("counts", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    scanned = materialize(text.mapInArrow(_scan(width, to_arrow_schema(schema)), schema), "sets")
    rows = scanned.filter("n is not null").select("id", "key", "n")
    slices = scanned.filter("slice is not null").select("slice", "counts").repartition(1 << (SKETCH_BITS - SLICE_BITS), "slice").mapInArrow(_add, "slice int, counts binary").collect()
    rank = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in slices:
        rank[r["slice"] << SLICE_BITS : (r["slice"] + 1) << SLICE_BITS] = np.frombuffer(r["counts"], np.int64)
    shared = spark.sparkContext.broadcast(rank)

    entries = rows.filter("n > 0").agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    buckets = parts_for(entries, BUCKET_ENTRIES)
    packed = text.select("text").mapInArrow(_prefixes(width, percent, buckets, shared), _PACKED)
    chained = packed.repartition(buckets, "bucket").mapInArrow(_chains, "a bigint, b bigint")
    cluster = materialize(components(chained, "clusters").select(F.col("node").alias("key"), F.col("root").alias("cluster")), "cluster")

    signed = scanned.filter("key is not null").select("key", "n", "signature").join(cluster, "key").dropDuplicates(["key"])
    cluster = _near_clusters(materialize(signed, "signed"), percent, signed_sets)

    # sets of clusters, from the one document of least id (or any, where ids are null) that has each
    first = rows.join(cluster, "key").groupBy("key", "cluster").agg(F.min("id").alias("id"))
    wanted = first.filter("id is not null").withColumnRenamed("id", "_id")
    nameless = rows.filter("id is null and key is not null").limit(1).count() > 0

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = row_sets(batch.column(0), width)
            keys = [_key(s) if len(s) else None for s in sets]
            ordered = [_ordered(s, shared.value).tobytes() for s in sets]
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(ordered, pa.binary())], ["key", "n", "tokens"])

    some = text.join(wanted.select("_id").distinct(), F.col("id") == F.col("_id"), "left_semi")
    if nameless:
        some = some.union(text.filter("id is null"))
    sets = some.select("text").mapInArrow(tokens_of, "key bigint, n bigint, tokens binary").join(cluster, "key")
    path = new_path(spark, "cluster-sets")
    sets = written(sets.dropDuplicates(["key"]) if nameless else sets, path)
    links = _links_of(sets, path, percent, block_sets, shared)

    root = components(links, "joined").select(F.col("node").alias("key"), "root")
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("rep")).join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    ends = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = materialize(classes.join(ends, "root").select("key", "component_id"), "components")
    out = rows.join(named, "key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def op9_ngram_tree_join(spark, sf_dir: str) -> DataFrame:
    """All documents by four-word shingles and a similarity of 0.85."""
    return link(table(spark, sf_dir, "documents"), width=4, percent=85)
