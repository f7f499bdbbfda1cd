"""Exact top-k search by distributed histogram selection.

Vectors become integer matrices in blocks of rows, and the queries among them blocks of their own. Every query block meets
every vector block: groups of query blocks and stripes of vector blocks span a grid, each of whose cells is one task, and a
block is sent to the cells of its group or stripe; each pair of blocks is one matrix product. In a round, the
pairs count scores in `bins` equal steps of each query's own score range; the counts are summed per query and step, and
the step that holds the k-th score is the range of the next round. When steps are one wide, the k-th score
is known exactly. A last pass emits what lies above it (fewer than k rows a query) and, of the ties at it, the
least ids that each cell may need; the final rank is by score, then id.

The scores are never kept: each pass computes them again. Counts, not scores, are shuffled: at most `bins` rows a query
and cell, and none below the step in which a cell's own scores reach k. Nothing is broadcast, whatever size Spark takes
a table to have (it does not count what `explode` adds), and the driver gets a few numbers.

Defined cases: rows without an id, and vectors that are null, empty or hold null or non-finite components, take no part;
shorter vectors count as filled up with zeros; a row is never its own candidate, a repeated row with the same id is;
a query with fewer than k candidates gets them all. Scores must stay below 2**53, which is checked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from crewlens.llm.shared import written

BLOCK = "block long, n int, dims int, largest long, ids binary, rows binary, cells binary"
#: What is known of the queries of a block: their rows, in order, and a value for each.
STATE = {"row": "array<long>", "low": "array<long>", "above": "array<int>"}
#: Pairs of blocks that Python gets at a time (some 600 KB each), and queries of a pair that are scored at a time.
PAIRS_PER_BATCH, SCORED = 32, 512


def _valid(column: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the rows that take part and their components, floor(64 * x), filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    owner = np.repeat(np.arange(len(width)), width)
    bad = np.bincount(owner, ~np.isfinite(values), len(width)) > 0
    ok = (width > 0) & ~bad & np.asarray(ids.is_valid())
    dims = int(width[ok].max(initial=0))
    out = np.zeros((len(width), dims))
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)
    use = ok[owner]
    out[owner[use], inside[use]] = np.floor(64 * values[use])
    return np.flatnonzero(ok), out[ok]


def _block(block: int, ids: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    """One row of BLOCK; components in the narrowest type that holds them."""
    most = np.abs(cells).max(initial=0)
    small = cells.astype(np.int8 if most < 1 << 7 else np.int16 if most < 1 << 15 else np.int64)
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block], pa.int64()),
            "n": pa.array([len(ids)], pa.int32()),
            "dims": pa.array([cells.shape[1]], pa.int32()),
            "largest": pa.array([int(np.ceil(np.sqrt((cells.astype(float) ** 2).sum(1).max(initial=0)))) + 1], pa.int64()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
            "rows": pa.array([rows.tobytes()], pa.binary()),
            "cells": pa.array([small.tobytes()], pa.binary()),
        }
    )


def _blocks(rows_per_block: int):
    """Blocks of vectors, with the number of each row in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen = 0, 0
        for batch in batches:
            for k in range(0, batch.num_rows, rows_per_block):
                part = batch.slice(k, rows_per_block)
                at, cells = _valid(part.column("embedding"), part.column("vec_id"))
                ids = part.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[at]
                first = part.column("part")[0].as_py() << 40
                rows = first + seen + at
                seen += part.num_rows
                if not len(ids):
                    continue
                if np.abs(cells).max(initial=0) >= 2.0**53:
                    raise OverflowError("components do not fit 53 bits")
                yield _block(first + number, ids, rows, cells.astype(np.int64))
                number += 1

    return run


def _query_blocks(rows_per_block: int, every: int):
    """The queries of the blocks of a task, in blocks as large as vectors' may be, each sorted by row."""

    def packed(block: int, held: list[tuple]) -> pa.RecordBatch:
        ids, rows = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        cells, end = np.zeros((len(ids), max(h[2].shape[1] for h in held)), np.int64), 0
        for _, _, own in held:
            cells[end : end + len(own), : own.shape[1]] = own
            end += len(own)
        order = np.argsort(rows)
        return _block(block, ids[order], rows[order], cells[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = 0, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                mine = ids % every == 0
                if held and n + mine.sum() > rows_per_block:
                    yield packed(first + number, held)
                    number, held, n = number + 1, [], 0
                if mine.any():
                    first = r["part"] << 40
                    held.append((ids[mine], np.frombuffer(r["rows"], np.int64)[mine], _matrix(r["cells"], r["n"], r["dims"])[mine]))
                    n += mine.sum()
        if held:
            yield packed(first + number, held)

    return run


def _matrix(raw: bytes, n: int, dims: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 8: np.int64}[len(raw) // (n * dims)]
    return np.frombuffer(raw, kind).reshape(n, dims)


class _Queries:
    """A query block, and what is known of its queries."""

    def __init__(self, block: int, n: int, dims: int, largest: int, ids: bytes, rows: bytes, cells: bytes, state: dict[str, pa.Array | None]):
        self.block, self.largest, self.cells = block, largest, _matrix(cells, n, dims)
        self.rows, self.ids = np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64)
        self.state = state  # of some of the rows or none

    def known(self, name: str, default: int) -> np.ndarray:
        """A value per query; the default where nothing is known."""
        out = np.full(len(self.rows), default, np.int64)
        if self.state["row"] is not None:
            out[np.searchsorted(self.rows, self.state["row"].to_numpy())] = self.state[name].to_numpy()
        return out


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Queries, slice, np.ndarray, np.ndarray]]:
    """Queries, which of them, candidate ids, scores (overwritten by the next ones; no score with the own row) of each pair
    of blocks. Pairs with the same query block in a row share one object."""
    held, space = None, np.empty(0, np.float32)
    for batch in batches:
        for i in range(batch.num_rows):
            if held is None or held.block != batch.column("q_block")[i].as_py():
                q = {name: batch.column(f"q_{name}")[i].as_py() for name in ("block", "n", "dims", "largest", "ids", "rows", "cells")}
                held = _Queries(**q, state={name: batch.column(name)[i].values for name in STATE})
            r = {name: batch.column(name)[i].as_py() for name in ("n", "dims", "largest", "ids", "rows", "cells")}
            c, rows, ids = _matrix(r["cells"], r["n"], r["dims"]), np.frombuffer(r["rows"], np.int64), np.frombuffer(r["ids"], np.int64)
            dims = min(held.cells.shape[1], c.shape[1])
            bound = held.largest * r["largest"]
            if bound >= 1 << 53:
                raise OverflowError("scores do not fit 53 bits")
            kind = np.float32 if bound < 1 << 24 else np.float64
            if space.dtype != kind or space.size < SCORED * len(ids):
                space = np.empty(SCORED * len(ids), kind)
            itself = np.minimum(np.searchsorted(rows, held.rows), len(rows) - 1)
            itself[rows[itself] != held.rows] = -1
            turned = c[:, :dims].T.astype(kind)
            for at in range(0, len(held.rows), SCORED):
                part = slice(at, min(at + SCORED, len(held.rows)))
                q = held.cells[part, :dims].astype(kind)
                scores = np.matmul(q, turned, out=space[: len(q) * len(ids)].reshape(len(q), len(ids)))
                own = np.flatnonzero(itself[part] >= 0)
                scores[own, itself[part][own]] = -np.inf
                yield held, part, ids, scores


def _reaching(scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate and score where the score reaches the query's least one."""
    at = np.flatnonzero(scores >= least.astype(scores.dtype)[:, None])
    return at // scores.shape[1], at % scores.shape[1], scores.ravel()[at].astype(np.int64)


def _histogram(step: int, low: int, bins: int, k: int, first: bool):
    """Counts of the scores in [low of the query, + bins * step), from the step on in which those at hand reach k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def summed() -> pa.RecordBatch:
            i, cell = np.nonzero(counts)
            use = start[i] + cell * step >= least[i]
            i, cell = i[use], cell[use]
            block = np.full(len(i), held.block, np.int64)
            return pa.RecordBatch.from_pydict({"block": pa.array(block), "row": pa.array(held.rows[i]), "before": pa.array(above[i]), "low": pa.array(start[i] + cell * step), "n": pa.array(counts[i, cell])})

        for q, part, _, scores in _pairs(batches):
            if q is not held:
                if held is not None:
                    yield summed()
                held, start, counts = q, q.known("low", low), np.zeros((len(q.rows), bins), np.int64)
                above = q.known("above", 0 if first else k)
                least = np.where(above < k, start, np.inf)  # a query with fewer than k candidates has no step to find
            if first and scores.shape[1] >= k and not counts[part].any():
                some = scores[:, : max(k, 512)]
                kth = np.maximum(np.partition(some, some.shape[1] - k)[:, some.shape[1] - k], start[part])
                least[part] = np.maximum(least[part], start[part] + (kth.astype(np.int64) - start[part]) // step * step)
            i, _, score = _reaching(scores, least[part])
            cell = (score - start[part][i]) // step
            at = (i * bins + cell)[cell < bins]
            own = counts[part]
            if len(at) < own.size // 8:
                at, n = np.unique(at, return_counts=True)
                own.ravel()[at] += n
            else:
                own += np.bincount(at, minlength=own.size).reshape(own.shape)
            if len(i) > k * len(own):
                upto = np.cumsum(own[:, ::-1], axis=1) >= (k - above[part])[:, None]
                reached = upto.any(axis=1) & (above[part] < k)
                least[part] = np.where(reached, np.maximum(least[part], start[part] + (bins - 1 - upto.argmax(axis=1)) * step), least[part])
        if held is not None:
            yield summed()

    return run


def _winners(k: int, low: int):
    """Scores above each query's k-th, and of those equal to it the least ids, as many as can be needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, n = None, [], 0

        def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Query, id and score of what can be needed of `found`."""
            i, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((ids, -score, i))
            i, ids, score = i[order], ids[order], score[order]
            use = np.arange(len(i)) - np.searchsorted(i, i) < k
            return i[use], ids[use], score[use]

        def rows() -> pa.RecordBatch:
            i, ids, score = best()
            return pa.RecordBatch.from_pydict({"row": pa.array(held.rows[i]), "query_id": pa.array(held.ids[i]), "vec_id": pa.array(ids), "score": pa.array(score)})

        for q, part, ids, scores in _pairs(batches):
            if q is not held:
                if found:
                    yield rows()
                held, cut, found, n = q, q.known("low", low), [], 0
            i, j, score = _reaching(scores, cut[part])
            found.append((i + part.start, ids[j], score))
            n += len(i)
            if n > 4 * k * len(q.rows):
                found = [best()]
                n = len(found[0][0])
        if found:
            yield rows()

    return run


def _dealt(spark: SparkSession, groups: int, stripes: int) -> Column:
    """Numbers of the grid's cells, group by group, whose hashes deal them to as many partitions, one to each."""
    n = groups * stripes
    hashed = spark.range(24 * n).select(F.col("id").cast("int").alias("key")).groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("at")).agg(F.min("key").alias("key"))
    known = {r["at"]: r["key"] for r in hashed.collect()}
    return F.lit([known.get(i, -1 - i) for i in range(n)])  # a number for each, whatever its hash


def _grid(spark: SparkSession, queries: Row, vectors: Row) -> tuple[int, int]:
    """Groups of query blocks and stripes of vector blocks: a cell for each shuffle partition, as far as there are blocks,
    such that few rows are sent."""
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stripes = round(math.sqrt(tasks * (vectors["n"] or 1) / (queries["n"] or 1)))
    stripes = max(1, min(stripes, vectors["blocks"], tasks))
    return max(1, min(math.ceil(tasks / stripes), queries["blocks"])), stripes


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, rows_per_block: int = 4096, bins: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row of `embeddings` (vec_id, embedding)
    whose id is divisible by `every`."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding", F.spark_partition_id().alias("part"))
    vectors = written(rows.mapInArrow(_blocks(rows_per_block), BLOCK), "topk-vectors")
    own = vectors.select("n", "dims", "ids", "rows", "cells", F.spark_partition_id().alias("part"))
    queries = written(own.mapInArrow(_query_blocks(rows_per_block, every), BLOCK), "topk-queries", PAIRS_PER_BATCH)
    sizes = [df.agg(F.count("*").alias("blocks"), F.sum("n").alias("n"), F.coalesce(F.max("largest"), F.lit(1)).alias("largest")).first() for df in (queries, vectors)]
    bound = sizes[0]["largest"] * sizes[1]["largest"]  # no score is further from 0 (Cauchy and Schwarz)
    groups, stripes = _grid(spark, *sizes)
    cells = _dealt(spark, groups, stripes)

    def place(many: int) -> Column:
        """Blocks of a task go to one group or stripe after the other."""
        return ((F.shiftright("block", 40) + F.col("block").bitwiseAND((1 << 40) - 1)) % many).cast("int")

    def sent(blocks: DataFrame, first: Column, step: int, n: int) -> DataFrame:
        """Each block with the number of each cell that it goes to."""
        at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(cells, first + i * step))
        return blocks.withColumn("cell", F.explode(at)).repartition(groups * stripes, "cell")

    def pairs(state: DataFrame | None) -> DataFrame:
        asked = queries.select("block", *(F.col(c).alias(f"q_{c}") for c in ("n", "dims", "largest", "ids", "rows", "cells")))
        asked = asked.withColumns({name: F.lit(None).cast(kind) for name, kind in STATE.items()}) if state is None else asked.join(state.hint("merge"), "block", "left")
        asked = sent(asked, place(groups) * stripes, 1, stripes).withColumnRenamed("block", "q_block")
        # Sorted by cell, a query block meets its vector blocks one after the other.
        return asked.join(sent(vectors, place(stripes), stripes, groups).drop("block").hint("merge"), "cell").drop("cell")

    step, state, low, first = 1, None, -bound, True
    while step * bins < 2 * bound + 1:
        step *= bins
    while step:
        counts = pairs(state).mapInArrow(_histogram(step, low, bins, k, first), "block long, row long, before long, low long, n long")
        counts = counts.groupBy("block", "row", "before", "low").agg(F.sum("n").alias("n"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("block", "row", "before").orderBy(F.desc("low")))
        ranked = counts.withColumn("upto", upto).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k))
        found = written(ranked.select("block", "row", "low", (F.col("upto") - F.col("n")).cast("int").alias("above")), "topk-state", PAIRS_PER_BATCH)
        state = found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(*STATE))).alias("state"))
        state = state.select("block", *(F.col(f"state.{name}") for name in STATE))
        step, first = step // bins, False
    winners = pairs(state).mapInArrow(_winners(k, -bound - 1), "row long, query_id long, vec_id long, score long")
    best = written(winners, "topk-winners", PAIRS_PER_BATCH)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
