import math
import random

import pytest

from crewlens.llm.topk_histogram import top_k


def brute(rows, k, every):
    """Sorted scores of all pairs."""

    def cells(v):
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
        return [math.floor(64 * x) for x in v] if ok else None

    usable = [(i, cells(v)) for i, v in rows if i is not None and cells(v)]
    out = []
    for a, (i, q) in enumerate(usable):
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, c, strict=False)), j) for b, (j, c) in enumerate(usable) if b != a)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("scale, bins", [(0.2, 16), (30.0, 256)])
def test_equals_brute_force(spark, scale, bins):
    rng = random.Random(9)
    same = [0.5 * scale, -0.25 * scale, 0.125 * scale]
    rows = [(i, [rng.gauss(0, scale) for _ in range(3)] if i % 3 else same) for i in range(160)]
    rows += [(160, None), (161, []), (162, [1.0, None, 2.0]), (163, [math.nan, 0.0, 0.0]), (180, [math.inf, 0.0, 0.0]), (None, same), (200, [1.0]), (20, same), (20, same)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    stored = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert got(top_k(df, k=20, every=20, rows_per_block=16, bins=bins)) == brute(stored, 20, 20)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert got(top_k(df)) == [(0, 1, 1, 8192), (0, 2, 2, 8192)]
    assert got(top_k(df.limit(0))) == []
    assert got(top_k(df.where("vec_id > 0"))) == []


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert got(top_k(df)) == brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 20, 20)


@pytest.mark.parametrize("most", [1, 40])
def test_broadcasts_nothing_and_equals_brute_force(spark, most):
    """Query blocks that are small as a file become large when each is sent to many tasks. `most`: many equal scores, few."""
    settings = {"spark.sql.maxBroadcastTableSize": "64k", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in settings}
    rng = random.Random(4)
    rows = [(i, [rng.randint(-most, most) / 64 for _ in range(48)]) for i in range(400)] + [(7, [most / 64] * 50), (7, [most / 64] * 50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert got(top_k(df, k=5, every=1, rows_per_block=32, bins=8)) == brute(rows, 5, 1)
        assert got(top_k(df, k=40, every=3, rows_per_block=100)) == brute(rows, 40, 3)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
