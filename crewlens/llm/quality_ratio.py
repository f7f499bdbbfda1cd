"""Quality by the likelihood ratio of hashed n-grams: trusted target against raw corpus.

Words and word pairs are hashed into a fixed number of cells. Two multinomials over the cells are counted over the trusted documents (four fifths of them, by doc_id) and over
every document. A document's score is the mean over its n-grams of log p(trusted) - log p(raw). The verdict is one
cut for all documents, set below the scores of the trusted documents left out of the counts.

The base rules are counts of words, symbols, repeated lines and repeated five-word windows.

Sizes: the counts are sums per cell (map-side first), so the driver gets `cells` rows however large the corpus; scores
go to the shared folder once, without texts, and the histogram of trusted scores has bounded width.

Defined cases: null, empty and blank texts have no words and fail the base rules; without trusted documents all scores
are 0 and the base rules alone decide. A document is trusted if any of its label rows says quality 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import remainder, sized, written
from crewlens.llm.textkit import Words, mix, ngrams, per_text, slices

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 5
STEPS = 1000  # steps of the score scale per unit
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _grams(words: Words, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all words and word pairs, and the texts that they belong to."""
    owner = words.owner()
    pairs = ngrams(words.hash, 2)
    inside = owner[1:] == owner[:-1] if len(owner) > 1 else np.empty(0, bool)
    hashes = np.concatenate([mix(words.hash), pairs[inside]])
    return (hashes % np.uint64(cells)).astype(np.int64), np.concatenate([owner, owner[1:][inside] if len(owner) > 1 else owner[:0]])


def _counts(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for _, _, words in slices(batch.column("text"), lower=True):
                total += np.bincount(_grams(words, cells)[0], minlength=cells)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["cell", "n"])

    return run


def _repeated(words: Words) -> np.ndarray:
    """Words of each text inside a five-word window that the text holds twice or more."""
    owner = words.owner()
    windows = ngrams(words.hash, WINDOW)
    at = np.flatnonzero(owner[: len(windows)] == owner[WINDOW - 1 :]) if len(windows) else np.empty(0, np.int64)
    keys = mix(windows[at] ^ mix(owner[at].astype(np.uint64)))
    _, back, n = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[n[back] > 1]
    edge = np.zeros(len(owner) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return per_text(np.cumsum(edge)[:-1] > 0, words.first)


def _repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _measures(ratio: np.ndarray, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in slices(batch.column("text"), lower=True):
                cell, owner = _grams(words, len(ratio))
                n = np.bincount(owner, minlength=words.size)
                score = np.bincount(owner, ratio[cell], words.size) / np.maximum(n, 1)
                exact = Words(words.data, words.offsets, lower=False)
                columns = {
                    "n_words": words.counts(),
                    "word_chars": per_text(words.solid & ((words.data & 0xC0) != 0x80), words.offsets),
                    "n_symbols": per_text(SYMBOLS[words.data], words.offsets),
                    "n_dup_lines": np.array([_repeated_lines(words.text(i)) for i in range(words.size)], np.int64),
                    "n_repeat_words": _repeated(exact),
                }
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(columns[f], pa.int64()) for f in FIELDS), pa.array(score, pa.float64())],
                    ["doc_id", *FIELDS, "score"],
                )

    return run


def log_ratio(trusted: np.ndarray, raw: np.ndarray, prior: float = 20.0) -> np.ndarray:
    """log p(trusted) - log p(raw) per cell. Both get `prior` raw counts more, in proportion to their sizes: a cell
    too rare to tell has ratio 0."""
    if not trusted.sum():
        return np.zeros(len(raw))
    return np.log(trusted * (raw.sum() / trusted.sum()) + prior) - np.log(raw + prior)


def cut_of(levels: dict[int, int], loss: float) -> float:
    """The step below which lie `loss` of the counted documents, less half its distance from the median (few
    documents show little of the lower tail)."""
    rest = sum(levels.values())
    if not rest:
        return -np.inf
    low, middle = ((np.cumsum([levels[x] for x in sorted(levels)]) > share * rest).argmax() for share in (loss, 0.5))
    low, middle = sorted(levels)[low], sorted(levels)[middle]
    return (low - (middle - low) / 2) / STEPS


def quality_by_ratio(docs: DataFrame, labels: DataFrame, cells: int = 1 << 16, loss: float = 0.005) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept per row of `docs` (doc_id, text), with `labels`
    (doc_id, quality)."""
    texts = docs.select("doc_id", "text")
    trusted = written(labels.where("quality = 1").select("doc_id").distinct(), "trusted")
    counted_part = remainder("doc_id", 5) != 0
    counted = [
        x.select("text").mapInArrow(_counts(cells), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        for x in (texts.join(sized(trusted.where(counted_part)), "doc_id", "left_semi"), texts)
    ]
    target, raw = (np.bincount(x["cell"].to_numpy(np.int64), x["n"].to_numpy(np.float64), cells) for x in counted)
    ratio = log_ratio(target, raw)

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, {', '.join(f'{f} long' for f in FIELDS)}, score double"
    rows = written(texts.mapInArrow(_measures(ratio, kind), ddl), "quality")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = rows.where(~failed).join(trusted.where(~counted_part), "doc_id", "left_semi").groupBy(F.floor(F.col("score") * STEPS).alias("level")).count()
    cut = cut_of({r["level"]: r["count"] for r in good.collect()}, loss)
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= F.lit(cut)))
