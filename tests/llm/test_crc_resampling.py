import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from crewlens.llm import crc_resampling as module
from crewlens.llm.crc_resampling import crc_buckets, ranked, resample

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    words = WORD.findall((text or "").encode().lower())  # of bytes: A-Z only
    return [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def brute(rows, target, buckets=10000, longest=1, least=20, percent=10):
    held = [(d, *grams(t, longest)) for d, t in rows]
    raw, aim = [0] * buckets, [0] * buckets
    for _, fs, _ in held:
        for f in fs:
            raw[zlib.crc32(f) % buckets] += 1
    for t in target:
        for f in grams(t, longest)[0]:
            aim[zlib.crc32(f) % buckets] += 1
    s, t = sum(raw), sum(aim)
    gain = [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(raw, aim, strict=True)]
    out = []
    for d, fs, words in held:
        weight = sum(gain[zlib.crc32(f) % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = [(*r[:4], i) for i, r in enumerate(able, 1) if i <= percent * len(able) // 100]
    rest = [(*r[:4], None) for r in able[len(drawn) :]] + [(*r[:4], None) for r in out if r[4] < least]
    return sorted(drawn + rest, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, score int, part string").repartition(3)


def test_crc_of_groups_of_equal_length(monkeypatch):
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 3, 3, 7, 40, 2000]))) for _ in range(300)] + [b"", b"123456789"]
    data = np.frombuffer(b"".join(words), np.uint8)
    places = np.cumsum([0, *map(len, words)])
    assert crc_buckets(data, places, 1 << 32).tolist() == [zlib.crc32(w) for w in words]
    monkeypatch.setattr(module, "LONG", 2)
    assert crc_buckets(data, places, 10000).tolist() == [zlib.crc32(w) % 10000 for w in words]


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10000, 10), (2, 97, 40), (3, 50, 100)])
def test_equals_brute_force(spark, longest, buckets, percent):
    rng = random.Random(1)
    pool = [f"w{i}" for i in range(60)] + ["Über", "ÜBER", "naïve", "日本語", "É1"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, " .,;\n"), (None, " ".join(pool[:30])), (None, " ".join(pool[:30])), (5, rows[5][1]), (5, rows[6][1]), (400, "x" * 5000 + " y" * 40)]
    target = [" ".join(rng.choice(pool[:20]) for _ in range(30)) for _ in range(20)] + [None, "unseen"]
    df = resample(made(spark, rows), made(spark, list(enumerate(target))), buckets=buckets, longest=longest, percent=percent)
    assert got(df) == brute(rows, target, buckets, longest, percent=percent)


def test_ties_go_to_the_lesser_id(spark, monkeypatch):
    monkeypatch.setattr(module, "noise", lambda seed: module.F.lit(0).cast("long"))
    docs = made(spark, [(i, "one two " * 15) for i in range(99, -1, -1)])
    drawn = resample(docs, docs.where("doc_id < 0")).where("rank IS NOT NULL")
    assert sorted((r["rank"], r["doc_id"]) for r in drawn.collect()) == [(i + 1, i) for i in range(10)]


def test_empty_tables_and_few_rows(spark):
    docs = made(spark, [(1, "one two " * 15), (2, "word")])
    assert got(resample(docs.limit(0), docs)) == []
    assert got(resample(docs, docs.limit(0))) == brute([(1, "one two " * 15), (2, "word")], [])
    assert resample(docs.where("doc_id = 2"), docs).where("rank IS NOT NULL").count() == 0


def test_rank_over_ranges(spark):
    rows = spark.range(5000).selectExpr("id", "id % 7 AS score").repartition(5)
    out = ranked(rows, [module.F.col("score").desc(), module.F.col("id")], "ranked").collect()
    assert [r["id"] for r in sorted(out, key=lambda r: r["rank"])] == sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert sorted(r["rank"] for r in out) == list(range(1, 5001))


def test_given_tables(spark):
    docs, target = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    assert got(resample(docs, target)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
