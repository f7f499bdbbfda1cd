import random

import numpy as np

from crewlens.llm.shared import remainder
from crewlens.llm.toxicity_fm import Machine, fit, scored, toxicity

WORDS = [f"word{i}" for i in range(300)]


def sample(n=900):
    """Toxic rows hold both of two marks; one of them alone is harmless: only their pair tells."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        marks = rng.choice([["grim", "folk"], ["grim"], ["folk"], []])
        words = rng.choices(WORDS, k=30) + marks
        rng.shuffle(words)
        rows.append((i, " ".join(words) + ("!" if i % 2 else "."), int(len(marks) == 2)))
    return rows


def test_learns_an_interaction_that_weights_alone_cannot():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (4000, 2))
    terms = [np.array([0] * a + [1] * b + [2 + i % 50], np.int64) for i, (a, b) in enumerate(x)]
    terms = [np.unique(t) for t in terms]
    machine = fit(terms, (x[:, 0] & x[:, 1]).astype(float), 64, epochs=40)
    cases = [np.array([5]), np.array([0, 5]), np.array([1, 5]), np.array([0, 1, 5])]
    logits = machine.logits(np.concatenate(cases), np.repeat(range(4), [len(c) for c in cases]), 4)
    assert logits[3] > 0 > max(logits[:3])


def test_logit_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    machine = Machine(0.3, rng.normal(size=8), rng.normal(size=(8, 3)))
    cell = np.array([1, 4, 6])
    want = 0.3 + machine.weights[cell].sum() + sum(machine.factors[a] @ machine.factors[b] for a, b in [(1, 4), (1, 6), (4, 6)])
    assert np.isclose(machine.logits(cell, np.zeros(3, int), 1)[0], want)


def test_held_out_accuracy_and_shape(spark):
    rows = sample()
    docs = spark.createDataFrame([(i, t, 0.5, True) for i, t, _ in rows], "doc_id long, text string, score double, held_out boolean")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(rows[0][0], 0), (None, 1), (7, None)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity(docs.repartition(3), labels).collect()}
    assert len(out) == len(rows)
    truth = {i: y for i, _, y in rows}
    held = [r for r in out.values() if r["held_out"]]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.9


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = sample(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    a, b = ({r["doc_id"]: r["score"] for r in toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x"), (4, "w" * 100000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity(docs, none).collect()] == [0] * 5
    assert toxicity(docs.limit(0), none).collect() == []
    machine = Machine(0.0, np.zeros(8), np.zeros((8, 1)))
    kept = scored(docs.withColumnRenamed("doc_id", "score"), machine, ["score", "text"])
    assert kept.columns == ["score", "text", "score"] and kept.count() == 5
    assert docs.select(remainder("doc_id", 5).alias("r")).where("r is null").count() == 0
