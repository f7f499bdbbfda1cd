import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from crewlens.llm.interpolation import CELLS, CONTEXTS, fit_weights, interpolated_scores


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10


def brute(rows):
    """The same model with dictionaries, given weights are fitted from the same held-out events."""
    seqs = {r["doc_id"]: tokens(r["text"]) for r in rows}
    counts = {}
    for name, folds in (("kept", set(range(2, 10))), ("all", set(range(1, 10)))):
        one, two = Counter(), Counter()
        for i, seq in seqs.items():
            if fold(i) in folds:
                one.update(seq)
                two.update(zip(["<s>", *seq], seq, strict=False))
        counts[name] = one, two
    return seqs, counts


TEXTS = ["a b a b a", "A b c", "", None, "  ", "c c c c", "a b", "b a d e", "x y z " * 300, "é è ü b a"]


def rows_of(n):
    return [Row(doc_id=i, text=TEXTS[i % len(TEXTS)], lang="x", held_out="clash", score=1) for i in range(n)]


def test_base_and_model_equal_brute_force(spark):
    rows = rows_of(60)
    out = {r["doc_id"]: r for r in interpolated_scores(spark.createDataFrame(rows).repartition(3), block_bytes=2000, ranges=4).collect()}
    seqs, counts = brute(rows)
    one, two = counts["all"]
    n, v = sum(one.values()), len(one)

    def ratios(seq, one, two):
        n, v = sum(one.values()), len(one)
        for left, word in zip(["<s>", *seq], seq, strict=False):
            context = one[None] if left == "<s>" else one[left]
            pair = two[left, word] / context if context else 0
            yield math.frexp(context)[1], one[word] / n * (v + 1), pair * (v + 1)

    def level(x):
        return int(np.clip(np.round(math.log2(x) * 2 + CELLS // 2), 1, CELLS - 1)) if x else 0

    cells = Counter()
    for i, seq in seqs.items():
        if fold(i) == 1:
            cells.update((b * CELLS + level(w)) * CELLS + level(p) for b, w, p in ratios(seq, *counts["kept"]))
    weights = fit_weights(np.array(list(cells)), np.array(list(cells.values()), float))
    for i, seq in seqs.items():
        row = out[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(seq), sum(one[w] > 0 for w in seq), n)
        assert row["held_out"] == (fold(i) == 0)
        assert row["base_score"] == pytest.approx(sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in seq))
        assert row["score"] == pytest.approx(sum(math.log10((weights[b] @ [1, w, p]) / (v + 1)) for b, w, p in ratios(seq, one, two)))


def test_weights_are_distributions_that_follow_the_events():
    high = (5 * CELLS + 70) * CELLS + 90  # the pair explains the event best
    low = (6 * CELLS + 90) * CELLS + 0  # only the word does
    weights = fit_weights(np.array([high, low]), np.array([1000.0, 1000.0]))
    assert np.allclose(weights.sum(1), 1) and (weights[1:] > 0).all() and weights.shape == (CONTEXTS, 3)
    assert weights[5].argmax() == 2 and weights[6].argmax() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert interpolated_scores(empty).collect() == []


def test_no_training_rows_gives_uniform_scores(spark):
    held = next(i for i in range(1000) if fold(i) == 0)
    (row,) = interpolated_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["held_out"]) == (3, 0, 0, True)
    assert math.isfinite(row["score"]) and row["score"] <= 0


def test_repeated_rows_each_get_a_row(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id long, text string")
    assert interpolated_scores(docs).count() == 3
