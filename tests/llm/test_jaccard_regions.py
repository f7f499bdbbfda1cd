import random
import re

import numpy as np
import pytest

from crewlens.llm import jaccard_regions
from crewlens.llm.graph import components
from crewlens.llm.jaccard_regions import PARTS, _region_pairs, jaccard_components, sketched, unsketched


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and sets[a][0] is not None and sets[b][0] is not None and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted(((i, len(s), None if i is None else least[find(a)]) for a, (i, s) in enumerate(sets)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    license_ = " ".join(rng.choices(words, k=60))
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(30, 120))
        texts.append(" ".join(base))
        current = base
        for _ in range(rng.randint(1, 8)):  # chains of small edits and copies
            current = list(rng.choice([base, current]))
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(current))
                current[at : at + 1] = rng.choices(words, k=rng.randint(0, 2))
            texts.append(" ".join(current))
    for k in range(40):  # mostly a common passage: many regions with several components
        texts.append(license_ + " " + " ".join(rng.choices(words, k=k % 25)))
    texts += [" ".join(rng.choices(words, k=50)) + " " + license_ for _ in range(20)]
    texts += ["a b c", "A b  c", "a b c d", "one", "one", "", " \n", None, None, "x " * 3000, "x " * 40, "w1 w2 w3 w4 w5 w6"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 5)) + [(None, texts[0]), (None, "lonely row"), (6, texts[1])]
    return rows


@pytest.mark.parametrize("seed, region", [(1, 64), (2, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, region):
    monkeypatch.setattr(jaccard_regions, "REGION", region)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, node int, component_id string").repartition(5)
    out = jaccard_components(docs, ranges=4, block_bytes=20000)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_chain_a_hub_and_a_ring(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200 + k, 200 + (k + 1) % 7) for k in range(7)] + [(300, 300)]
    out = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert out == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200 + k: 200 for k in range(7)}


def test_vectors_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for size in (3, 40, 500, 6000):
        for _ in range(20):
            one = rng.integers(0, 1 << 63, size).astype(np.uint64)
            two = np.concatenate([one[: int(size * rng.uniform(0.7, 1))], rng.integers(0, 1 << 63, int(size * rng.uniform(0, 0.3))).astype(np.uint64)])
            vectors = np.stack([np.minimum(np.bincount((x >> np.uint64(54)).astype(np.int64), minlength=PARTS), 255) for x in (one, two)]).astype(np.uint8)
            few = unsketched(sketched(vectors)).astype(int)
            apart = len(set(one.tolist()) ^ set(two.tolist()))
            assert np.abs(few[0] - few[1]).sum() <= np.abs(vectors[0].astype(int) - vectors[1]).sum() <= apart


@pytest.mark.parametrize("seen", [0, 1 << 13])
def test_pairs_of_regions_are_made_once_and_none_is_missed(monkeypatch, seen):
    monkeypatch.setattr(jaccard_regions, "SEEN", seen)
    rng = np.random.default_rng(seen)
    rows, nodes = 400, 60
    region, node = rng.integers(0, 12, rows), rng.integers(0, nodes, rows)
    n, root = rng.integers(20, 60, nodes)[node], rng.integers(0, 30, nodes)[node]
    sketch = rng.integers(0, 2, (nodes, 256)).astype(np.uint8)
    sketch[30:] = sketch[:30]  # equal vectors: nothing rules these out but size and root
    far = rng.random(rows)
    want = set()
    for i in range(rows):
        for j in range(rows):
            a, b = node[i], node[j]
            fits = min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 75 and np.abs(sketch[a].astype(int) - sketch[b]).sum() * 175 <= (n[i] + n[j]) * 25
            if region[i] == region[j] and a < b and root[i] != root[j] and fits and abs(far[i] - far[j]) <= 0.25 + 1e-9:
                want.add((a, b))
    out = _region_pairs(region, node, n, root, sketch[node], far, None)
    assert {tuple(x) for x in out.tolist()} == want and len(out) == len(want) > 0
