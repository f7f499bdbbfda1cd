import random
import re

import numpy as np

from crewlens.llm.quality_ratio import cut_of, log_ratio, quality_by_ratio


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def texts():
    rng = random.Random(3)
    good = [" ".join(rng.choices("red green blue grey white é".split(), k=40)) for _ in range(400)]
    bad = [" ".join(rng.choices("x## y$$ z%% buy && now|".split(), k=40)) for _ in range(200)]
    odd = [None, "", " \n\t", "a b", "A a A a A a A a A a A a", "l1 m\nl1 m\n\n l1 m\nb", "one two three four five six seven eight nine ten\x0beleven", "w" * 300000]
    return good + bad + odd


def test_base_counts_and_verdicts(spark):
    all_texts = texts()
    docs = spark.createDataFrame([(i, t, 1, True) for i, t in enumerate(all_texts)], "doc_id long, text string, n_words int, kept boolean").repartition(4)
    labels = spark.createDataFrame([(i, 1 if i < 400 else 0) for i in range(0, 600, 2)] + [(0, 0), (2, None), (5000, 1)], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in quality_by_ratio(docs, labels, cells=4096).collect()}
    assert len(out) == len(all_texts)
    for i, t in enumerate(all_texts):
        r = out[i]
        want = base(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])
    sound = [i for i in range(400) if not out[i]["base_failed"]]
    assert sum(out[i]["kept"] for i in sound) >= 0.95 * len(sound)
    assert not any(out[i]["kept"] for i in range(400, 600))


def test_ratio_and_cut():
    ratio = log_ratio(np.array([8.0, 0.0]), np.array([8.0, 8.0]))
    assert ratio[0] > 0 > ratio[1]
    assert (log_ratio(np.zeros(2), np.ones(2)) == 0).all()
    assert (log_ratio(np.array([0.0, 5.0]), np.array([0.0, 50.0])) == [0, 0]).all()
    assert cut_of({-500: 1, 0: 99, 10: 200}, 0.005) == -0.005
    assert cut_of({}, 0.1) == -np.inf


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["kept"] for r in quality_by_ratio(docs, labels).orderBy("n_words").collect()] == [False, True, True]
    assert quality_by_ratio(docs.limit(0), labels).collect() == []
