"""The documents that rank highest for each query item, by products of dense tiles.

Method: a tile of items has a compact vocabulary (only its items' terms) and a float64 matrix of the terms' weights. A block
of documents has, for that vocabulary, a float64 matrix of impacts. Their BLAS product is the block's scores. All entries are
whole numbers, an impact is below 10**6 and a weight below 1000 * ln(2**64), so a product over COLUMNS terms stays below
2**53 and is exact; wider vocabularies are multiplied in steps of COLUMNS and summed as 64-bit integers. Of each
block the items keep all scores from the k-th highest on, so that ties survive, and then the first k by score and doc_id.

Scale: documents are read twice (counts of the items' terms, then scores) and never shuffled. A task sends its counts, and k
rows per item; Spark cuts those to k again before they meet. Items are sent to the tasks, `item_bytes` of text at a time:
more items are dealt into groups by hash, each scored by its own passes.

Defined cases: null texts have no terms; a row of items is an item of its own, also if its id is null or repeated (its ids'
ranks then repeat); repeated documents are documents of their own; null doc_id comes last among equal scores. Empty
tables give no rows. doc_id is an integer. Other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crewlens.llm.textkit import _buffers, binaries, pieces, terms

ITEMS, DOCS, COLUMNS = 256, 512, 4096
ITEM_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max


@dataclass
class Items:
    """A group of items: their vocabulary, and each item's distinct terms as a run of `term` between `first`."""

    vocabulary: pa.Array
    term: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Items:
        data, offsets = _buffers(texts)
        raw, places, first = terms(data, offsets)
        coded = binaries(raw, places).dictionary_encode()
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        size = max(1, len(coded.dictionary))
        pairs = np.unique(owner * size + coded.indices.to_numpy())
        return cls(coded.dictionary, pairs % size, np.searchsorted(pairs, np.arange(len(texts) + 1) * size))

    def tiles(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Items [a, b), the vocabulary of the tile, and row and column of each weight in its matrix."""
        for a in range(0, len(self.first) - 1, ITEMS):
            b = min(a + ITEMS, len(self.first) - 1)
            own = self.term[self.first[a] : self.first[b]]
            if len(own):
                known, column = np.unique(own, return_inverse=True)
                yield a, b, known, np.repeat(np.arange(b - a), np.diff(self.first[a : b + 1])), column


def _postings(batch: pa.RecordBatch, vocabulary: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows [a, b), their numbers of terms, and per distinct pair of text and known term: text, term, occurrences."""
    for a, b, data, offsets in pieces(batch.column("text")):
        raw, places, first = terms(data, offsets)
        found = pc.index_in(binaries(raw, places), value_set=vocabulary)
        term = found.fill_null(-1).to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(b - a), np.diff(first))
        size = max(1, len(vocabulary))
        pairs, tf = np.unique(owner[term >= 0] * size + term[term >= 0], return_counts=True)
        yield a, b, np.diff(first), pairs // size, pairs % size, tf


def _statistics(docs: DataFrame, vocabulary: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and documents per known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for _, _, n, _, term, _ in _postings(batch, vocabulary):
                total[:-2] += np.bincount(term, minlength=len(vocabulary))
                total[-2:] += (np.count_nonzero(n), n.sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["cell", "n"])

    found = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(vocabulary) + 2, np.int64)
    total[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return int(total[-2]), int(total[-1]), total[:-2]


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """How long texts of n terms are beside the mean, in Python's integers: the product may need more than 64 bits."""
    return np.array([10 + 90 * x * documents // max(length, 1) for x in n.tolist()], np.int64)


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term's occurrences add, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


def tile_scores(weight: np.ndarray, row: np.ndarray, column: np.ndarray, items: int, impact: np.ndarray, place: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Scores of items (rows) and documents (columns): products over COLUMNS terms at a time, each sum exact."""
    out = np.zeros((items, docs), np.int64)
    for a in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        mine, theirs = (column >= a) & (column < a + COLUMNS), (place >= a) & (place < a + COLUMNS)
        width = min(COLUMNS, int(column.max()) + 1 - a)
        left, right = np.zeros((items, width)), np.zeros((width, docs))
        left[row[mine], column[mine] - a] = weight[mine]
        right[place[theirs] - a, doc[theirs]] = impact[theirs]
        out += (left @ right).astype(np.int64)
    return out


class _Best:
    """The k best documents of each item so far: score, and doc_id with nulls last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.doc, self.none = (np.empty(0, np.int64) for _ in range(4))

    def add(self, a: int, b: int, scores: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        """`scores` of items [a, b) and some documents."""
        least = self.least[a:b]
        if scores.shape[1] > self.k:
            # Every score from the block's k-th on: equal ones at that edge all stay.
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, column = np.nonzero(scores >= least[:, None])
        if not len(row):
            return
        item = np.concatenate([self.item, row + a])
        score = np.concatenate([self.score, scores[row, column]])
        ids, nulls = np.concatenate([self.doc, doc[column]]), np.concatenate([self.none, none[column]])
        order = np.lexsort((ids, nulls, -score, item))
        item, score, ids, nulls = item[order], score[order], ids[order], nulls[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.k
        self.item, self.score, self.doc, self.none = item[kept], score[kept], ids[kept], nulls[kept]
        full = place == self.k - 1
        self.least[item[full]] = score[full]


def _scored(items: Items, weight: np.ndarray, documents: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(items.first) - 1, k)
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, n, doc, term, tf in _postings(batch, items.vocabulary):
                own = ids.slice(a, b - a).cast(pa.int64())
                none = own.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                own = own.fill_null(0).to_numpy()
                impact = impacts(tf, norms(n, documents, length)[doc])
                for from_ in range(0, b - a, DOCS):
                    to = min(from_ + DOCS, b - a)
                    lo, hi = np.searchsorted(doc, [from_, to])
                    if lo == hi:
                        continue
                    for first, last, known, row, column in items.tiles():
                        place = np.searchsorted(known, term[lo:hi])
                        place[place == len(known)] = 0
                        here = known[place] == term[lo:hi]
                        scores = tile_scores(weight[known][column], row, column, last - first, impact[lo:hi][here], place[here], doc[lo:hi][here] - from_, to - from_)
                        best.add(first, last, scores, own[from_:to], none[from_:to])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int64()), pa.array(best.doc, pa.int64(), mask=best.none.astype(bool)), pa.array(best.score, pa.int64())], ["item", "doc_id", "score"]
        )

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the `k` best rows of `docs` (doc_id, text) for each row of `items` (item_id, text)."""
    spark = docs.sparkSession
    texts, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    kind, item_kind = (x.schema[c].dataType.simpleString() for x, c in ((docs, "doc_id"), (items, "item_id")))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    groups = -(-size // item_bytes)
    out = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    for group in range(groups):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        held = Items.of(rows.column("text"))
        documents, length, df = _statistics(texts, held.vocabulary)
        found = texts.mapInArrow(_scored(held, weights(df, documents), documents, length, k), "item long, doc_id long, score long")
        best = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"item": pa.array(range(rows.num_rows), pa.int64()), "item_id": rows.column("item_id")}))
        ranks = top.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc_id").cast(kind).alias("doc_id"), "score")
        out = out.unionByName(ranks) if group else ranks
    return out


ORACLE_SQL = r"""
    WITH texts AS (
        SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
    ), sizes AS (SELECT doc_id, row, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0
    ), totals AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS length FROM sizes
    ), held AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM texts) GROUP BY row, term
    ), wanted AS (
        SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM (
            SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark)
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, totals
        WHERE term IN (SELECT term FROM wanted) GROUP BY term, documents
    ), impacts AS (
        SELECT h.row, h.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // length))) AS part
        FROM held h JOIN weights USING (term) JOIN sizes USING (row), totals
    ), scores AS (
        SELECT item, item_id, doc_id, row, sum(part)::BIGINT AS score FROM wanted JOIN impacts USING (term) JOIN sizes USING (row) GROUP BY ALL
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
