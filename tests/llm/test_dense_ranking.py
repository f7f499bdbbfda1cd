import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from crewlens.llm import dense_ranking as module
from crewlens.llm.dense_ranking import rank_documents, tile_scores

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall((text or "").encode().lower())  # of bytes: A-Z only


def brute(docs, items, k=10):
    held = [(d, split(t)) for d, t in docs]
    held = [(d, Counter(w), len(w)) for d, w in held if w]
    count, length = len(held), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in held:
            m = 100 - 90 + (90 * n * count) // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(split(text)) if w in c)
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def made(spark, rows, name):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], f"{name} long, text string, score int, item string").repartition(3)


@pytest.mark.parametrize("items_per_tile, docs, columns, item_bytes", [(256, 512, 4096, 1 << 22), (3, 7, 5, 1 << 22), (4, 16, 4096, 400)])
def test_equals_brute_force(spark, monkeypatch, items_per_tile, docs, columns, item_bytes):
    monkeypatch.setattr(module, "ITEMS", items_per_tile)
    monkeypatch.setattr(module, "DOCS", docs)
    monkeypatch.setattr(module, "COLUMNS", columns)
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(50)] + ["Über", "ÜBER", "naïve", "日本語"]

    def text(n):
        return " ".join(rng.choice(pool[: rng.randrange(1, len(pool))]) for _ in range(n))

    rows = [(i, text(rng.randrange(25))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, ".,;"), (None, rows[3][1]), (3, rows[3][1]), (7, "w1"), *((300 + i, "W1, w2!") for i in range(40))]
    wanted = [(i, text(rng.randrange(12))) for i in range(20)] + [(30, None), (31, ""), (32, "unseen"), (None, "w1 w2"), (1, "w3"), (1, "w4"), (33, "w1 " * 500)]
    assert got(rank_documents(made(spark, rows, "doc_id"), made(spark, wanted, "item_id"), item_bytes=item_bytes)) == brute(rows, wanted)


def test_ties_beyond_a_block_go_to_the_lesser_id(spark):
    docs = made(spark, [(i, "same words here" if i % 2 else "other") for i in range(2000, 0, -1)], "doc_id")
    ranks = rank_documents(docs, made(spark, [(1, "words")], "item_id"))
    assert [r["doc_id"] for r in sorted(ranks.collect(), key=lambda r: r["rank"])] == list(range(1, 21, 2))


def test_empty_tables(spark):
    docs, items = made(spark, [(1, "a b")], "doc_id"), made(spark, [(1, "a")], "item_id")
    assert got(rank_documents(docs.limit(0), items)) == got(rank_documents(docs, items.limit(0))) == []
    assert got(rank_documents(docs.where("doc_id = 2"), items)) == []


def test_products_are_exact():
    # Full columns of the greatest weights and impacts: sums near 2**47 in floating point, beyond in integers.
    n, weight = 3 * module.COLUMNS + 17, math.floor(1000 * math.log(2**64))
    column, row = np.arange(n), np.zeros(n, np.int64)
    scores = tile_scores(np.full(n, weight), row, column, 1, np.full(n, 999_999), column, np.zeros(n, np.int64), 1)
    assert scores.tolist() == [[n * weight * 999_999]]
    assert module.COLUMNS * weight * 10**6 < 2**53


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    assert got(rank_documents(docs, items)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
