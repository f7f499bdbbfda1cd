"""Jaccard metric-space join of documents: links between sets of five-word shingles at similarity 0.75 or more.

Pivots. The distance 1 - Jaccard is a metric, but two unrelated documents are at distance 1 from nearly any third
one, so sampled documents make no useful Voronoi cells: every document would be replicated into every cell. The first pivots
are therefore single shingles, nearest under a weighted Jaccard distance whose weights fall steeply along one global
order (rare shingles first): a document's cell is that of its first shingle. A partner within the threshold lacks
at most a quarter of the document's shingles, so a window of its first n - ceil(0.75 n) + 2 shingles (their cells) is
sure to share two cells with every partner; that is where a document is replicated to.

Regions. Inside a cell (region) a document becomes the pivot, and only the distances of the others to it are
computed: a star, not all pairs. Members within the threshold of it are one component and need no comparison with each
other. Regions that still hold several components recur. One of at most 1024 members compares members of different components. A larger
one takes as pivot the member that shares cells with most others (the text that edited copies go back to), and
members are compared with it. Two members x, y that have a, b shingles in common with the pivot share at most min(a, b)
shingles inside it; so either that is enough for a link, and their distances to the pivot lie within the triangle
inequality's window, or they share a shingle outside the pivot. The first are few and are found by sizes; for the others, what
lies outside the pivot is joined by windows again, in regions of its own. So all components are exact, and a group of
copies costs as many comparisons as it has members.

The global order only needs to be the same for all documents; it ranks shingles by how often blocks of documents repeat
them (a bounded table of the most repeated ones), which keeps common passages out of the windows. Hot cells:
a block of documents sends at most `dense` members of a cell to the cell's home; the rest stay with a pivot of their
block, in a range that depends on the block.

Comparing. Counting a set's shingles in 1024 parts of the hash space maps it to a vector, and the sum of differences
of two vectors is never more than the number of shingles that only one set holds. Candidates whose vectors are too far
apart cannot be linked and go before any set is read; the others are compared set against set. Inside a region members are
compared by size, component and a smaller vector (256 parts) in place: what these rule out never becomes a row.

Sets and shingles are 64-bit hashes. Documents with equal sets are one node. Defined cases: null texts and texts without
words have the empty set, link with nothing and are their own component; rows without doc_id take no part and get a null
component; repeated rows are linked like other copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.graph import best_per, components
from crewlens.llm.shared import hash_ranges, sized, written
from crewlens.llm.textkit import Words, mix, ngrams, slices

SHINGLE = 5
MATCH, OF = 75, 100  # the least similarity is MATCH / OF
HOT = 1 << 16
DENSE = 32
REGION = 1024
PARTS, SKETCH = 1024, 256
REGION_BYTES = 32 << 20
SEEN = 1 << 13  # nodes of a part whose compared pairs are remembered


class Sets:
    """The distinct shingles of some texts, sorted within each text; `first` is the place of each text's first one."""

    def __init__(self, words: Words):
        count, first = words.counts(), words.first
        grams = ngrams(words.hash, SHINGLE)
        owner = words.owner()
        inside = np.flatnonzero(owner[: len(grams)] == owner[SHINGLE - 1 :]) if len(grams) else np.empty(0, np.int64)
        hashes, of = [grams[inside]], [owner[inside]]
        for n in range(1, SHINGLE):
            at = np.flatnonzero(count == n)
            if len(at):
                whole = ngrams(words.hash, n)[first[at]] if len(words.hash) >= n else np.empty(0, np.uint64)
                hashes.append(whole)
                of.append(at)
        hash_, owner = np.concatenate(hashes), np.concatenate(of)
        order = np.lexsort((hash_, owner))
        hash_, owner = hash_[order], owner[order]
        new = np.ones(len(hash_), bool)
        new[1:] = (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1])
        self.hash, self.owner = hash_[new], owner[new]
        self.size = np.bincount(self.owner, minlength=words.size)
        self.first = np.concatenate([[0], np.cumsum(self.size)])

    def vectors(self) -> np.ndarray:
        """Shingles of each text in each part of the hash space, at most 255."""
        part = (self.hash >> np.uint64(54)).astype(np.int64)  # 1024 parts
        out = np.empty((len(self.size), PARTS), np.uint8)
        for a in range(0, len(self.size), 1024):  # texts of no words are many to a batch
            b = min(a + 1024, len(self.size))
            own = slice(self.first[a], self.first[b])
            counts = np.bincount((self.owner[own] - a) * PARTS + part[own], minlength=(b - a) * PARTS)
            out[a:b] = np.minimum(counts, 255).reshape(-1, PARTS)
        return out

    def nodes(self) -> np.ndarray:
        """A hash of each text's set."""
        sums = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(mix(self.hash + np.uint64(0x51ED270B)), out=sums[1:])
        return mix((sums[self.first[1:]] - sums[self.first[:-1]]) ^ mix(self.size.astype(np.uint64))).view(np.int64)


def sketched(vectors: np.ndarray) -> np.ndarray:
    """Counts in `SKETCH` parts, at most 15, two to a byte."""
    few = np.minimum(vectors.reshape(len(vectors), SKETCH, -1).sum(2, dtype=np.int64), 15).astype(np.uint8)
    return few[:, ::2] | few[:, 1::2] << 4


def unsketched(packed: np.ndarray) -> np.ndarray:
    return np.stack([packed & 15, packed >> 4], 2).reshape(len(packed), -1)


def window_length(size: np.ndarray) -> np.ndarray:
    """How many of a set's first shingles are sure to hold two that any partner's window holds as well."""
    return np.minimum(size, size - -(-MATCH * size // OF) + 2)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, words in slices(batch.column("text"), lower=True):
            sets = Sets(words)
            vectors = sets.vectors()
            both = [pa.array([v.tobytes() for v in x], pa.binary()) for x in (vectors, sketched(vectors))]
            arrays = [batch.column("doc_id").slice(a, b - a), pa.array(sets.size, pa.int64()), pa.array(sets.nodes()), *both]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "node", "vector", "sketch"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several sets of one block hold (some MB of text)."""
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
        many = n >= 4
        return pa.RecordBatch.from_arrays([pa.array(keys[many].view(np.int64)), pa.array(n[many], pa.int64())], ["key", "n"])

    for batch in batches:
        for _, _, words in slices(batch.column("text"), lower=True):
            sets = Sets(words)
            _, once = np.unique(sets.nodes(), return_index=True)
            held.append(sets.hash[np.isin(sets.owner, once)])
            size += len(held[-1])
            if size >= 1 << 20:
                yield counted()
                held, size = [], 0
    yield counted()


def hot_shingles(docs: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """The `most` shingles that blocks of documents repeat most, sorted, and their ranks from 1 (a bounded table)."""
    found = docs.select("text").mapInArrow(_repeated, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "key").limit(most).toPandas()
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    ranks = np.arange(len(keys), 0, -1)  # the most repeated one comes last in the order
    by = np.argsort(keys)
    return keys[by], ranks[by]


def _windows(ranges: int, hot: np.ndarray, ranks: np.ndarray, block_bytes: int):
    shift = np.uint64(64 - int(math.log2(ranges)))

    def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, index of node) of all windows, and the nodes with their sizes."""
        keys, nodes, of, sizes, base = [], [], [], [], 0
        for _, _, words in slices(column, lower=True):
            sets = Sets(words)
            node = sets.nodes()
            at = np.searchsorted(hot, sets.hash)
            rank = np.where(hot[np.minimum(at, len(hot) - 1)] == sets.hash, ranks[np.minimum(at, len(hot) - 1)], 0) if len(hot) else np.zeros(len(sets.hash), np.int64)
            order = np.lexsort((sets.hash, rank, sets.owner))
            place = np.arange(len(order)) - sets.first[sets.owner]
            _, once = np.unique(node, return_index=True)  # copies within the block count once
            use = (place < window_length(sets.size)[sets.owner]) & np.isin(sets.owner, once) & (sets.size > 1)[sets.owner]
            keys.append(sets.hash[order][use])
            of.append(sets.owner[use] + base)
            nodes.append(node)
            sizes.append(sets.size)
            base += len(node)
        node, at = np.unique(np.concatenate(nodes), return_inverse=True)
        size = np.zeros(len(node), np.int64)
        size[at] = np.concatenate(sizes)
        key, who = np.concatenate(keys), at[np.concatenate(of)]
        order = np.lexsort((who, key))
        key, who = key[order], who[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
        return key[new], who[new], node, size

    def packed(range_: int, key: np.ndarray, who: np.ndarray, node: np.ndarray, size: np.ndarray, local: bool) -> dict:
        used, index = np.unique(who, return_inverse=True)
        return {
            "range": range_,
            "local": local,
            "keys": key.tobytes(),
            "at": index.astype(np.uint32 if len(used) > 65535 else np.uint16).tobytes(),
            "nodes": node[used].tobytes(),
            "sizes": size[used].astype(np.uint32).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, part, number = [], 0, 0, 0

        def block() -> Iterator[pa.RecordBatch]:
            key, who, node, size = entries(pa.chunked_array(held))
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            length = np.diff(np.concatenate([start, [len(key)]]))
            rank = np.arange(len(key)) - np.repeat(start, length)
            dense = np.repeat(length > DENSE, length)
            home = ~dense | (rank == 0)
            rows = []
            if dense.any():  # all members of a dense cell, with their own pivot, in a range of this block
                rows.append(packed(ranges + (part * 7919 + number) % ranges, key[dense], who[dense], node, size, True))
            key, who = key[home], who[home]
            bounds = np.searchsorted(key >> shift, np.arange(ranges + 1, dtype=np.uint64)) if ranges > 1 else [0, len(key)]
            rows += [packed(r, key[a:b], who[a:b], node, size, False) for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
            for k in range(0, len(rows), 32):
                yield pa.RecordBatch.from_pylist(rows[k : k + 32], schema=PACKED_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            step = max(1, int(batch.num_rows * block_bytes / max(batch.nbytes, 1) / 2))
            for k in range(0, batch.num_rows, step):
                text = batch.column("text").slice(k, step)
                held.append(text)
                total += batch.nbytes * len(text) / batch.num_rows
                if total >= block_bytes:
                    yield from block()
                    held, total, number = [], 0, number + 1
        if held:
            yield from block()

    return run


PACKED = "range int, local boolean, keys binary, at binary, nodes binary, sizes binary"
PACKED_ARROW = pa.schema([("range", pa.int32()), ("local", pa.bool_()), ("keys", pa.binary()), ("at", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])
MEMBERS = "key long, node long, n long, pivot long"


def _regions(table: pa.Table) -> pa.Table:
    """Members of the cells of one range that hold two nodes or more, with the least node as pivot.
    Packed rows of dense cells keep their block's pivot."""
    out = []
    for local in (False, True):
        keys, nodes, sizes = [], [], []
        for r in table.filter(pc.equal(table["local"], local)).to_pylist():
            node, size = np.frombuffer(r["nodes"], np.int64), np.frombuffer(r["sizes"], np.uint32)
            key = np.frombuffer(r["keys"], np.uint64)
            at = np.frombuffer(r["at"], np.uint16 if len(r["at"]) == 2 * len(key) else np.uint32)
            keys.append(key)
            nodes.append(node[at])
            sizes.append(size[at])
            if local:  # one block at a time: pivots are the block's own
                out.append(_stars(key, node[at], size[at]))
        if not local and keys:
            out.append(_stars(np.concatenate(keys), np.concatenate(nodes), np.concatenate(sizes)))
    if not out:
        out.append(_stars(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint32)))
    return pa.concat_tables(out)


def _stars(key: np.ndarray, node: np.ndarray, size: np.ndarray) -> pa.Table:
    order = np.lexsort((node, key))
    key, node, size = key[order], node[order], size[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node, size = key[new], node[new], size[new]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    length = np.diff(np.concatenate([start, [len(key)]])).astype(np.int64)
    pivot = np.repeat(node[start], length)
    many = np.repeat(length > 1, length)
    columns = (key[many].view(np.int64), node[many], size[many].astype(np.int64), pivot[many])
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["key", "node", "n", "pivot"])


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in slices(batch.column("text"), lower=True):
            sets = Sets(words)
            raw = [sets.hash[x:y].tobytes() for x, y in zip(sets.first[:-1], sets.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(sets.nodes()), pa.array(raw, pa.binary())], ["node", "hashes"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose vectors do not rule out a link: at most a seventh of both sizes may be in one set only."""
    for whole in batches:
        for k in range(0, whole.num_rows, 2048):
            batch = whole.slice(k, 2048)
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int16) for c in ("x", "y"))
            apart = np.abs(x - y).sum(1, dtype=np.int64)
            both = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            keep = apart * (MATCH + OF) <= both * (OF - MATCH)
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, union = [], []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(one, two, assume_unique=True))
            shared.append(both)
            union.append(len(one) + len(two) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(union, pa.int64())], ["a", "b", "shared", "together"])


class _Comparer:
    """Exact distances of candidate pairs."""

    def __init__(self, docs: DataFrame, rows: DataFrame):
        self.docs, self.rows = docs, rows
        self.nodes = written(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("vector").alias("vector"), F.first("sketch").alias("sketch")), "nodes")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """a, b, shared and together for the pairs (a, b) of nodes."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        one = self.nodes.select(F.col("node").alias("a"), "n", F.col("vector").alias("x"))
        two = self.nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("vector").alias("y"))
        pairs = written(pairs.join(one, "a").join(two, "b").mapInArrow(_near, "a long, b long"), "pairs")
        sets = self.sets(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        return written(both.mapInArrow(_compared, "a long, b long, shared long, together long"), "distances", 256)

    def sets(self, nodes: DataFrame) -> DataFrame:
        """node and its shingles, for some nodes: one document is read for each. Few ids are sent to the texts; many
        are joined by shuffle."""
        ids = written(self.nodes.join(nodes, "node", "left_semi").select("doc_id").distinct(), "wanted")
        found = self.docs.join(sized(ids), "doc_id", "left_semi").select("text").mapInArrow(_sets_of, "node long, hashes binary")
        return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _linked(distances: DataFrame) -> DataFrame:
    return distances.where(F.col("shared") * OF >= F.col("together") * MATCH).select("a", "b")


def _fits(n: str, m: str) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(n, m) * OF >= F.greatest(n, m) * MATCH


def _open_regions(members: DataFrame, roots: DataFrame, keys: list[str]) -> DataFrame:
    """Members of the regions that hold several components, with their roots, the regions' sizes and least nodes."""
    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy(*keys).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"), F.min("node").alias("least")).where("low < high")
    return named.join(mixed.select(*keys, "members", "least"), keys)


def _region_pairs(regions: np.ndarray, node: np.ndarray, n: np.ndarray, root: np.ndarray, sketch: np.ndarray, far: np.ndarray | None, inside: np.ndarray | None) -> np.ndarray:
    """Pairs (a, b), a < b, of one part's regions: different components, sizes, triangle windows, shingles inside the pivot and
    sketches that allow a link. Sketches of two nodes are compared once, however many regions hold both; no pair is made
    that they rule out."""
    order = np.lexsort((n, regions))
    starts = np.flatnonzero(np.concatenate([[True], np.diff(regions[order]) != 0]))
    found = [np.empty((0, 2), np.int64)]
    nodes, own = np.unique(node, return_inverse=True)
    seen: dict[int, np.ndarray] = {}
    for rows in np.split(order, starts[1:]) if len(order) else []:
        size = n[rows]
        # Sizes rise: partners of a row lie between it and the greatest size that fits.
        last = np.searchsorted(size * MATCH, size * OF, "right")
        for x in range(len(rows)):
            near = rows[x + 1 : last[x]]
            if not len(near):
                continue
            i = rows[x]
            fit = (root[near] != root[i]) & (node[near] != node[i])
            if far is not None:
                fit &= np.abs(far[near] - far[i]) <= 1 - MATCH / OF + 1e-9
            if inside is not None:
                fit &= np.minimum(inside[near], inside[i]) * (MATCH + OF) >= (n[near] + n[i]) * MATCH
            if len(nodes) <= SEEN:
                if own[i] not in seen:
                    seen[own[i]] = np.zeros(len(nodes), bool)
                known = seen[own[i]]
                fit &= ~known[own[near]]
                known[own[near[fit]]] = True
            near = near[fit]
            if len(near):
                apart = np.abs(sketch[near].astype(np.int16) - sketch[i]).sum(1)
                near = near[apart * (MATCH + OF) <= (n[near] + n[i]) * (OF - MATCH)]
                found.append(np.stack([np.minimum(node[near], node[i]), np.maximum(node[near], node[i])], 1))
    return np.unique(np.concatenate(found), axis=0)


def _pairs(regions: DataFrame, keys: list[str], compare: _Comparer, family: str = "least", far: bool = False, inside: bool = False) -> DataFrame:
    """Members (node, n, root) of the regions `keys` that may be linked, as (a, b). Regions of one `family` (with the same least
    node, or pivot) hold much the same members, so they go to one task, or to several of `REGION_BYTES` each."""
    used = [c for c, use in (("far", far), ("inside", inside)) if use]
    rows = regions.select(F.xxhash64(*keys).alias("region"), "node", "n", "root", F.col(family).alias("family"), *used)
    each = SKETCH // 2 + 48
    sizes = written(rows.groupBy("family").count(), "families")
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(sizes.agg(F.sum("count")).first()[0] or 0) * each // REGION_BYTES))
    # Fewer than there are parts.
    large = sizes.where(F.col("count") * each > REGION_BYTES).select("family", F.ceil(F.col("count") * each / REGION_BYTES).alias("slots"))

    def run(table: pa.Table) -> pa.Table:
        sketch = unsketched(np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH // 2))
        columns = [table[c].to_numpy() for c in ("region", "node", "n", "root")]
        more = [table[c].to_numpy() if c in used else None for c in ("far", "inside")]
        pairs = _region_pairs(*columns, sketch, *more)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    slot = F.pmod(F.xxhash64("region"), F.coalesce("slots", F.lit(1)))
    dealt = rows.join(F.broadcast(large), "family", "left").withColumn("part", F.pmod(F.xxhash64("family", slot), F.lit(parts))).drop("family", "slots")
    dealt = dealt.join(compare.nodes.select("node", "sketch"), "node")
    return dealt.repartition(parts, "part").groupBy("part").applyInArrow(run, "a long, b long").distinct()


def _outside(hot: np.ndarray, ranks: np.ndarray):
    """What a member shares with its pivot, and the window of its shingles outside the pivot: a partner that cannot do with
    what both have inside shares one of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, keys = [], []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                own, pivot = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                rest = np.setdiff1d(own, pivot, assume_unique=True)
                inside = len(own) - len(rest)
                rank = np.zeros(len(rest), np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, rest), len(hot) - 1)
                    rank = np.where(hot[at] == rest, ranks[at], 0)
                need = max(1, -(-MATCH * len(own) // OF) - inside)
                keys.append(rest[np.lexsort((rest, rank))][: max(0, len(rest) - need + 1)].view(np.int64))
                shared.append(inside)
            cuts = np.cumsum([0, *map(len, keys)])
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([*keys, np.empty(0, np.int64)])))
            columns = [batch.column(c) for c in ("node", "pivot", "n", "m")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shared, pa.int64()), lists], ["node", "pivot", "n", "m", "inside", "outside"])

    return run


def _split_by_pivot(large: DataFrame, compare: _Comparer, hot: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """node, pivot, sizes n and m, inside, outside: the members of large regions against their regions' pivots."""
    degree = large.groupBy("node").agg(F.sum("members").alias("degree"))
    pivots = large.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node"))["node"].alias("pivot"))
    groups = written(large.select("key", "node").join(pivots, "key").select("node", "pivot").distinct(), "pivot-groups")
    sizes = compare.nodes.select("node", "n")
    sets = compare.sets(groups.select("node").unionByName(groups.select(F.col("pivot").alias("node"))).distinct())
    sets = sets.join(sizes, "node")
    both = groups.join(sets.withColumnRenamed("hashes", "x"), "node").join(sets.select(F.col("node").alias("pivot"), F.col("hashes").alias("y"), F.col("n").alias("m")), "pivot")
    return written(both.select("node", "pivot", "n", "m", "x", "y").mapInArrow(_outside(hot, ranks), "node long, pivot long, n long, m long, inside long, outside array<long>"), "inside-pivots", 256)


def _last_links(members: DataFrame, roots: DataFrame, links: DataFrame, compare: _Comparer, hot: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """The links that stars have not shown, so far as they join components."""
    open_ = written(_open_regions(members.select("key", "node", "n").distinct(), roots, ["key"]), "open-regions")
    found = _pairs(open_.where(F.col("members") <= REGION), ["key"], compare)
    large = open_.where(F.col("members") > REGION)
    if large.isEmpty():
        return _linked(compare(found))
    inside = _split_by_pivot(large, compare, hot, ranks)
    near = inside.where("node <> pivot").where(F.col("inside") * OF >= (F.col("n") + F.col("m") - F.col("inside")) * MATCH)
    near = near.select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    roots = written(components(links.unionByName(near), "roots"), "roots")
    far = 1 - F.col("inside") / (F.col("n") + F.col("m") - F.col("inside"))
    named = inside.withColumn("far", far).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_size = _pairs(named, ["pivot"], compare, "pivot", far=True, inside=True)
    outside = inside.withColumn("far", far).select("pivot", "node", "n", "far", F.explode("outside").alias("key"))
    regions = written(_open_regions(outside, roots, ["pivot", "key"]), "outside-regions")
    found = found.unionByName(by_size).unionByName(_pairs(regions, ["pivot", "key"], compare, far=True)).distinct()
    return near.unionByName(_linked(compare(found)))


def jaccard_components(docs: DataFrame, ranges: int | None = None, block_bytes: int = 6 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id per row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    rows = written(docs.mapInArrow(_nodes, f"doc_id {kind}, n_shingles long, node long, vector binary, sketch binary"), "sets", 1024)
    if ranges is None:  # a quarter of the shingles is sent, in some ten bytes
        ranges = hash_ranges(spark, 2.5 * (rows.agg(F.sum("n_shingles")).first()[0] or 0))
    known = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")

    hot, ranks = hot_shingles(usable)
    sent = usable.select("text", F.spark_partition_id().alias("part")).mapInArrow(_windows(ranges, hot, ranks, block_bytes), PACKED)
    members = written(sent.groupBy("range").applyInArrow(_regions, MEMBERS), "members", 1024)

    # Stars: first the pivot that a node shares most cells with, then the others it is not yet connected to.
    sizes = known.select("node", F.col("n_shingles").alias("n")).distinct()
    edges = members.where("node <> pivot").groupBy("node", "n", "pivot").count().join(sizes.select(F.col("node").alias("pivot"), F.col("n").alias("m")), "pivot").where(_fits("n", "m"))
    edges = written(edges, "stars")
    compare = _Comparer(usable, known)
    first = best_per(edges, "node", F.desc("count"), "pivot")
    links = _linked(compare(first.select(F.col("node").alias("a"), F.col("pivot").alias("b"))))
    roots = components(links, "roots")

    apart = edges.join(roots, "node", "left").withColumnRenamed("root", "one").join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("two")), "pivot", "left")
    apart = apart.where(~F.coalesce(F.col("one") == F.col("two"), F.lit(False))).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    more = compare(apart.join(first.select(F.col("node").alias("a"), F.col("pivot").alias("b")), ["a", "b"], "left_anti"))
    links = links.unionByName(_linked(more))
    roots = written(components(links, "roots"), "roots")

    last = _last_links(members, roots, links, compare, hot, ranks)
    roots = components(links.unionByName(last), "roots")

    least = known.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left")
    least = least.withColumn("root", F.coalesce("root", "node"))
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.select("node", "root").join(ids, "root").select("node", "component_id")
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), alone).alias("component_id"))
