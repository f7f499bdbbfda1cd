"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms, hashed into cells: its words, lower-cased, cut at everything but letters and digits,
and the first 4, 5 and 6 bytes of each (inflected and compound words share them). The score is sigmoid(bias + sum of weights + sum over pairs of <v_i, v_j>): besides each word's own weight, every pair
of words interacts through low-rank factors, so a harmless word may count where another word stands beside it.

Fitting: at most `per_class` labelled rows of each class, those with the least hash of doc_id, a documented bound
(the fit is on the driver and needs per_class * 2 texts' cells). The intercept is shifted to the class shares of
all training labels.
Scoring: every document, its whole text, in parallel tasks with the model (cells * (factors + 1) floats) as a
constant.

Only cells whose share differs between the classes by `screen` standard errors get a weight; the rest are noise that a
small sample would be learned by heart from.

Defined cases: null and empty texts have no terms and get the bias alone; without labelled rows of both classes the
score is the share of toxic ones (0 without labels). Repeated label rows count once, toxic if any says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import remainder
from crewlens.llm.textkit import NOT_ALNUM, Words, slices


HEADS = (4, 5, 6)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, cell: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
        out = np.full(size, self.bias) + np.bincount(owner, self.weights[cell], size)
        for v in self.factors.T:
            x = v[cell]
            out += 0.5 * (np.bincount(owner, x, size) ** 2 - np.bincount(owner, x * x, size))
        return out


def _terms(words: Words, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of each text, as (cell, text) pairs."""
    base = words.owner() * cells
    hashes = [words.hash, *(words.heads(n, lower=True) for n in HEADS)]
    keys = np.unique(np.concatenate([base + (h % np.uint64(cells)).astype(np.int64) for h in hashes]))
    return keys % cells, keys // cells


def _sample(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in slices(batch.column("text"), lower=True, breaks=NOT_ALNUM):
                cell, owner = _terms(words, cells)
                cuts = np.searchsorted(owner, np.arange(words.size + 1))
                terms = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(cell, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(a, b - a), terms], ["toxic", "terms"])

    return run


def fit(terms: list[np.ndarray], toxic: np.ndarray, cells: int, factors: int = 4, epochs: int = 12, screen: float = 4.0, decay: float = 2e-4) -> Machine:
    """Logistic loss, AdaGrad over mini-batches, L2 decay; the same rows give the same machine."""
    rng = np.random.default_rng(7)
    seen = np.abs(_contrast(terms, toxic, cells)) >= screen
    terms = [t[seen[t]] for t in terms]
    machine = Machine(float(np.log((toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1))), np.zeros(cells), rng.normal(0, 0.01, (cells, factors)))
    gather_w, gather_v, gather_b = np.full(cells, 1e-6), np.full((cells, factors), 1e-6), 1e-6
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(terms)), max(1, len(terms) // 64)):
            cell = np.concatenate([terms[i] for i in rows])
            owner = np.repeat(np.arange(len(rows)), [len(terms[i]) for i in rows])
            error = _sigmoid(machine.logits(cell, owner, len(rows))) - toxic[rows]
            used, at = np.unique(cell, return_inverse=True)
            slope = error[owner]
            grad_w = np.bincount(at, slope, len(used)) / len(rows) + decay * machine.weights[used]
            grad_v = np.empty((len(used), factors))
            for k in range(factors):
                x = machine.factors[cell, k]
                rest = np.bincount(owner, x, len(rows))[owner] - x
                grad_v[:, k] = np.bincount(at, slope * rest, len(used)) / len(rows) + decay * machine.factors[used, k]
            gather_w[used] += grad_w**2
            gather_v[used] += grad_v**2
            gather_b += error.mean() ** 2
            machine.weights[used] -= 0.2 * grad_w / np.sqrt(gather_w[used])
            machine.factors[used] -= 0.02 * grad_v / np.sqrt(gather_v[used])
            machine.bias -= 0.05 * error.mean() / np.sqrt(gather_b)
    machine.factors[~seen] = 0
    return machine


def _contrast(terms: list[np.ndarray], toxic: np.ndarray, cells: int) -> np.ndarray:
    """How many standard errors each cell's share among toxic rows lies above that among the others."""
    n = np.array([len(toxic) - toxic.sum(), toxic.sum()])
    of = np.repeat(toxic.astype(np.int8), [len(t) for t in terms])
    cell = np.concatenate(terms)
    rows = np.stack([np.bincount(cell[of == x], minlength=cells) for x in (0, 1)], 1)
    share = (rows.sum(1) + 1) / (n.sum() + 2)
    return (rows[:, 1] / n[1] - rows[:, 0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n).sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, cells: int = 1 << 17, per_class: int = 4000) -> Machine:
    """The machine of labelled training rows (fold of doc_id other than 0)."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    all_rows = sum(shares.values())
    if len(shares) < 2:
        rate = shares.get(1, 0) / max(all_rows, 1)
        return Machine(float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))), np.zeros(cells), np.zeros((cells, 1)))
    picked = [known.where(F.col("toxic") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for x in (0, 1)]
    few = picked[0].unionByName(picked[1])  # at most 2 * per_class rows of two numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "toxic").dropDuplicates()
    rows = sample.mapInArrow(_sample(cells), "toxic int, terms array<int>").toArrow().combine_chunks()
    toxic = rows["toxic"].to_numpy().astype(float)
    # All terms in one array of 32-bit cells, a view of it per row: no Python object per term.
    lists = rows["terms"].combine_chunks()
    flat, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
    if not 0 < toxic.sum() < len(toxic):
        return Machine(float(np.log(shares[1] / shares[0])), np.zeros(cells), np.zeros((cells, 1)))
    # The order of rows must not matter: sort them by content.
    terms = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    order = sorted(range(len(terms)), key=lambda i: (toxic[i], len(terms[i]), terms[i].tobytes()))
    machine = fit([terms[i] for i in order], toxic[order], cells)
    machine.bias += float(np.log(shares[1] / shares[0]) - np.log(toxic.sum() / (len(toxic) - toxic.sum())))
    return machine


def _scores(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in slices(batch.column("text"), lower=True, breaks=NOT_ALNUM):
                cell, owner = _terms(words, len(machine.weights))
                score = _sigmoid(machine.logits(cell, owner, words.size))
                columns = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    return run


def scored(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` (text among them or not) and `score`."""
    named = docs.select(*(F.col(c).alias(f"keep_{c}") for c in keep), F.col("text"))
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema), "score double"])
    rows = named.mapInArrow(_scores(machine), ddl)
    return rows.select(*(F.col(f"keep_{c}").alias(c) for c in keep), "score")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of `docs`."""
    rows = scored(docs, train(docs, labels), ["doc_id"])
    return rows.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
