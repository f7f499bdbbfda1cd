import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from crewlens.llm.packing import CHUNK, deal, differencing, pack_documents, powers, tokenizer


def texts():
    rng = random.Random(2)
    words = "the a of tion ré über 12 \n  \t don't <|endoftext|> naïve 日本 🙂".split(" ")
    many = [" ".join(rng.choices(words, k=rng.randint(1, 900))) for _ in range(120)]
    return [*many, None, "", " ", "x " * 6000, "end<|endoftext|>"]


def test_each_id_lies_in_one_piece_and_sequences_have_no_gaps(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    out = pack_documents(docs, window=256, group_windows=8, with_ids=True).toPandas()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t in rows:
        mine = out[out.doc_id == i].sort_values("start")
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        assert [x for part in mine.ids for x in part] == ids
        assert mine.start.tolist() == np.cumsum([0, *mine.length])[:-1].tolist() and set(mine.doc_tokens) == {len(ids)}
        for r in mine.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    lengths = out.groupby("sequence_id").length.sum()
    assert lengths.max() <= 256 and all(x == 256 or x & (x - 1) == 0 for x in lengths)
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == np.cumsum([0, *seq.length])[:-1].tolist()


def test_differencing_is_near_equal_and_whole():
    rng = random.Random(1)
    sizes = [rng.randint(1, 1000) for _ in range(200)]
    dealt = differencing(sizes, 20)
    assert sorted(i for w in dealt for i in w) == list(range(200))
    sums = [sum(sizes[i] for i in w) for w in dealt]
    assert max(sums) - min(sums) <= 30
    assert differencing([], 3) == [[], [], []]


def test_windows_rise_without_cuts_and_stay_with_them():
    pieces = [(k, 0, 6) for k in range(4)]
    assert sorted(len(w) for w in deal(pieces, 8, cut=False)) == [1, 1, 1, 1]
    cut = deal(pieces, 8)
    assert [sum(p[2] for p in w) for w in cut] == [8, 8, 8]
    assert sum(p[2] for w in cut for p in w) == 24


def test_powers():
    assert [powers(x) for x in (0, 1, 13, 1023)] == [[], [1], [8, 4, 1], [1 << k for k in range(9, -1, -1)]]


def test_long_texts_are_encoded_whole():
    rng = random.Random(4)
    text = "".join(rng.choices(["lo", "rem ", "\n", "  ", "été", "'s", "12 "], k=CHUNK))
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer(None)(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    out = pack_documents(docs).collect()
    assert sum(r["length"] for r in out) == 3 + 3 + 1
    assert pack_documents(docs.limit(0)).collect() == []
