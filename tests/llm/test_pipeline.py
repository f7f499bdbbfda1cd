import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from crewlens.llm.packing import tokenizer

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, n=50):
    w = words_of(text)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def shingles(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).unionByName(docs.limit(0)).unionByName(spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (None, "no id here", "en", "s", 10)], docs.schema))
    out = [docs.unionByName(extra)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return df.collect()


def test_columns_and_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "secret_scans", "packing"]
    for df in steps[1:5]:
        assert df.columns == steps[0].columns


def test_toxicity_only_removes(spark, steps):
    before, after = ({(r["doc_id"], r["text"]) for r in rows(d)} for d in steps[:2])
    assert after <= before
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").select("doc_id")
    clean = steps[0].join(labels, "doc_id", "left_semi").select("doc_id").distinct().count()
    assert steps[1].join(labels, "doc_id", "left_semi").select("doc_id").distinct().count() >= 0.98 * clean


def test_one_of_each_group_stays(steps):
    before, after = rows(steps[1]), rows(steps[2])
    sets = [(r["doc_id"], shingles(r["text"])) for r in before]
    kept = [(r["doc_id"], shingles(r["text"])) for r in after]

    def linked(x, y):
        return x and y and 100 * len(x & y) >= 75 * len(x | y)

    ids = [i for i, _ in kept if i is not None]
    assert len(ids) == len(set(ids))
    for k, (i, x) in enumerate(kept):
        assert not any(linked(x, y) for j, y in kept[:k] if i is not None and j is not None)
    gone = {i for i, _ in sets} - {i for i, _ in kept}
    for i, x in sets:
        if i in gone:
            assert any(linked(x, y) and j < i for j, y in sets if j is not None)


def test_passages_stay_once(steps):
    before, after = rows(steps[2]), rows(steps[3])
    count = {}
    for r in after:
        for run in runs(r["text"]):
            count[run] = count.get(run, 0) + 1
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    assert max(count.values(), default=1) == 1
    shared = {}
    for r in before:
        if r["doc_id"] is not None:
            for run in runs(r["text"], 20):  # what an edited copy of a passage has in common at least
                shared.setdefault(run, set()).add(r["doc_id"])
    touched = {i for d in shared.values() if len(d) > 1 for i in d}
    text = {r["doc_id"]: r["text"] for r in after}
    for r in before:
        if r["doc_id"] is not None and r["doc_id"] not in touched:
            assert text[r["doc_id"]] == r["text"]


def test_secrets_are_masked_and_nothing_else(steps):
    before, after = ({(r["doc_id"]): r["text"] for r in rows(d)} for d in steps[3:5])
    assert before.keys() == after.keys()
    for i, text in before.items():
        if after[i] != text:
            assert "[secret]" in after[i]
        assert not re.search(r"[0-9a-f]{16}|AKIA[A-Z0-9]{14}", after[i] or "")


def test_packing_holds_every_token(steps):
    encode = tokenizer(None)
    want = sum(len(encode(r["text"] or "")) + 1 for r in rows(steps[4]))
    out = steps[5]
    assert out.agg(F.sum("length"), F.sum(F.size("ids"))).first() == (want, want)
    lengths = [r["n"] for r in out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert max(lengths) <= 1024


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset", "ids"} <= set(out.columns) and out.count() > 0
