import hashlib
import random

import pytest

from crewlens.llm import line_bitmaps as module
from crewlens.llm.line_bitmaps import drop_lines, line_bitmaps, line_digest

LOWER = str.maketrans(module.UPPER, module.LOWER)


def brute(rows, min_chars=10):
    """Kept text, lines and dropped lines of each row."""
    last = float("inf")

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    least = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                least[key(line)] = min(least.get(key(line), last), last if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if least.get(key(x)) in (None, last if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id long, text string, pos int, print string, n_dropped int").repartition(3)


CASES = [
    (1, None),
    (2, ""),
    (3, "A Line Of Some Length\nshort\n\n  a line of some length\t\n"),
    (4, "a line of some length\nshort\nits own line, long\nA LINE OF SOME LENGTH \r"),
    (4, "another text of four\na line of some length"),
    (4, "another text of four\na line of some length"),
    (5, "ÄÖÜ ist kein A-Z\nnine char\n123456789"),
    (6, "äöü ist kein a-z\nnine char\n123456789"),
    (7, "ÄÖÜ IST KEIN a-z"),
    (8, "\x0b\x0c   \r\n \n\n"),
    (None, "without an id at all\na line of some length\nits end"),
    (None, "without an id at all\nits own line, long"),
    (9, " a line of some length"),
]


def test_defined_cases(spark):
    assert got(line_digest(made(spark, CASES))) == brute(CASES)


def test_empty_table_and_text_alone(spark):
    assert got(line_digest(made(spark, CASES).limit(0))) == []
    assert line_bitmaps(made(spark, CASES[:2])).count() == 0


@pytest.mark.parametrize("sampled", [1, 32])
def test_frequent_lines_in_random_texts(spark, monkeypatch, sampled):
    monkeypatch.setattr(module, "SAMPLED", sampled)
    rng = random.Random(5)
    pool = ["the license line of all", *(f"line number {i} of a pool" for i in range(40))]
    rows = []
    for d in rng.sample(range(1000), 300):
        lines = [rng.choice([pool[0], rng.choice(pool), f"alone {rng.random()}", "", "short"]) for _ in range(rng.randrange(30))]
        rows.append((d, "\n".join(lines)))
    rows.append((1001, "\n".join(pool[:1] * 20000 + ["end of the long one"])))
    assert got(line_digest(made(spark, rows))) == brute(rows)


def test_frequent_key_is_dealt_to_many_ranges(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'one line that all have\nof its own ' || id AS text")
    frequent = module._frequent(docs, 10, 16).collect()
    assert len(frequent) == 1 and frequent[0]["parts"] >= 12
    assert line_bitmaps(docs).count() == 3999


def test_bitmaps_are_runs(spark):
    docs = made(spark, [(1, "first of the lines\nsecond of the lines"), (2, "its own, the first\nfirst of the lines\nsecond of the lines\nits own, the last\nfirst of the lines")])
    (row,) = line_bitmaps(docs).collect()
    assert (row["doc_id"], row["n_dropped"]) == (2, 3)
    assert [tuple(r) for r in row["keep"]] == [(0, 1), (3, 4), (5, None)]
    texts = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"], r["pos"]) for r in drop_lines(docs, line_bitmaps(docs)).collect()}
    assert texts[2] == ("its own, the first\nits own, the last", 5, 3, 1) and texts[1][1:3] == (2, 0)


def test_no_python_in_the_plan(spark):
    plan = line_digest(made(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(line_digest(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
