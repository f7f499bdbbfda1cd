import random
import time
import zlib

import numpy as np
import pytest

from crewlens.llm.maxplus_encode import MARK, Lattice, combined, decode, digest, encode, lattice, prefixes, states


@pytest.fixture(scope="module")
def model():
    return lattice(None)


def texts(seed=5):
    rng = random.Random(seed)
    parts = ["the", "straight", "forward", "été", "日本", "🙂", "\n", "", "\t", "xyzzy", "1234", "_____________________", "ofererstst", "ÿ", "a"]
    return [" ".join(rng.choices(parts, k=rng.randint(1, 60))) + "".join(rng.choices(parts, k=5)) for _ in range(40)]


def unigram():
    """The library's own best path over the same pieces: the model's type field set to unigram."""
    import public_tokenizers
    import sentencepiece

    raw = bytearray(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())

    def varint(i):
        value = shift = 0
        while True:
            value |= (raw[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if not raw[i - 1] & 128:
                return value, i

    def skip(kind, i):
        if kind == 0:
            return varint(i)[1]
        if kind == 2:
            n, i = varint(i)
            return i + n
        return i + (4 if kind == 5 else 8)

    i = 0
    while i < len(raw):
        key, i = varint(i)
        if key == 18:  # the trainer's settings
            n, j = varint(i)
            end = j + n
            while j < end:
                inner, j = varint(j)
                if inner == 24:
                    raw[j] = 1
                j = skip(inner & 7, j)
        i = skip(key & 7, i)
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))


def score_of(model, ids):
    return sum(model.score[i] for i in ids)


def test_best_paths_are_never_worse_than_the_librarys(model):
    library = unigram()
    rng = random.Random(1)
    words = ["the", "straightforward", "ofererstst", "internationalization", "thth", "enough", "qqqq"]
    for _ in range(50):
        text = " ".join("".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(20))
        flat, _, scores = model.words([MARK + w for w in text.split(" ")])
        ids = library.encode(text)
        assert scores.sum() >= score_of(model, ids) and score_of(model, flat) == scores.sum()
        assert model.decode(flat.tolist(), True) == library.decode(ids) == text


def test_best_paths_of_short_words_by_all_cuts(model):
    def every(text):
        if not text:
            yield 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in model.pieces:
                for rest in every(text[k:]):
                    yield model.pieces[text[:k]][0] + rest

    for w in ["the", "straight", "enough", "ofererst", "12 34", "a  b", "thtinge"]:
        marked = MARK + w.replace(" ", MARK)
        assert model.path(marked)[0] == max(every(marked))


def test_words_in_step_equal_single_paths(model):
    words = [MARK + w for t in texts() for w in t.split(" ")] + [MARK + "x" * 300, MARK]
    flat, bounds, scores = model.words(words)
    for k, w in enumerate(words):
        score, ids = model.path(w)
        assert flat[bounds[k] : bounds[k + 1]].tolist() == ids and scores[k] == pytest.approx(score)


def test_matrices_combine_to_the_whole(model):
    rng = np.random.default_rng(0)
    a, b, c = rng.normal(size=(3, 4, 4))
    assert np.allclose(combined(combined(a, b), c), combined(a, combined(b, c)))
    assert np.allclose(prefixes(np.stack([a, b, c]))[2], combined(combined(a, b), c))


@pytest.mark.parametrize("size", [1, 3, 16, 17, 40])
def test_chunks_give_the_best_path(model, size):
    for text in texts(7)[:12] + ["straightforwardrepresentations" * 3, "x" * 50, "=" * 70, "a" + " " * 45 + "b  c"]:
        marked = MARK + text.replace(" ", MARK)
        cuts = [(marked[k : k + size], marked[k + size : k + size + model.longest - 1]) for k in range(0, len(marked), size)]
        between = states(np.stack([model.transfer(*c) for c in cuts]))
        found = [model.chunk(*c, between[k], between[k + 1]) for k, c in enumerate(cuts)]
        assert sum(s for _, s in found) == pytest.approx(model.path(marked)[0], rel=1e-9)
        assert "".join(model.decode(ids.tolist(), k == 0) for k, (ids, _) in enumerate(found) if len(ids)) == text


def test_a_chunk_without_spaces_is_one_pass(model):
    """8192 Chinese characters, from every entry to every exit, and each against single paths."""
    rng = random.Random(2)
    text = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(8192))
    began = time.process_time()
    model.transfer(text, "日本語")
    assert time.process_time() - began < 2
    for text, ahead in [("internationalrepresentation", "alization"), ("日本語の文", "章"), ("ab", "straight"), ("thethe", "")]:
        found = model.transfer(text, ahead)
        for s in range(min(len(text), model.longest)):
            for e in range(min(model.longest, len(ahead) + 1)):
                assert found[s, e] == pytest.approx(model.path(text[s:] + ahead[:e], len(text) - s if e else None)[0])


def test_a_giant_text_without_spaces(spark, model):
    text = "国际化straightforward" * 5000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pieces = encode(docs).collect()
    assert len(pieces) == 3 and sum(r["score"] for r in pieces) == pytest.approx(model.path(MARK + text)[0], rel=1e-9)


def test_words_solved_before_are_looked_up(monkeypatch):
    monkeypatch.setattr("crewlens.llm.maxplus_encode.REMEMBERED", 3)
    fresh = Lattice(None)
    words = [MARK + w for w in ("the", "of", "straightforward", "", "x" * 300, "日本")]
    first = [x.tolist() for x in fresh.words(words)]
    for _ in range(3):
        assert [x.tolist() for x in fresh.words(words)] == first
        assert [x.tolist() for x in fresh.words(words[::-1])][2] == first[2][::-1]
    assert all(len(w) <= 256 for w in fresh.solved)


def test_texts_are_cut_where_no_piece_goes_on():
    """Parts between characters that no piece holds side by side are solved once, whatever words they stand in."""
    fresh = Lattice(None)
    parts = ["the", "straight", "日", "ofererst", "🙂", "9", ".", "\n", "ÿ", MARK]
    texts = [MARK + f"the\n{a}.\n{b}日{c}" for a in parts for b in parts for c in parts]
    flat, bounds, scores = fresh.words(texts)
    for k, t in enumerate(texts):
        score, ids = fresh.path(t)
        assert flat[bounds[k] : bounds[k + 1]].tolist() == ids and scores[k] == score
    assert len(fresh.solved) < len(texts) / 20


def test_chunks_at_once_equal_chunks_alone(model):
    chunks = [(t.replace(" ", MARK), "the", e, x) for t in [*texts(3)[:8], "", "a"] for e, x in ((0, 0), (2, 0), (0, 2))]
    ids, bounds, scores = model.chunks(chunks)
    for k, c in enumerate(chunks):
        one, score = model.chunk(*c)
        assert ids[bounds[k] : bounds[k + 1]].tolist() == one.tolist() and scores[k] == score


def test_round_trip(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate([*texts(), None, "", " ", "  two  ", "y" * 5000, "long words " * 400, "a▁b"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, chunk int").repartition(3)
    for chunk in (64, 1 << 15):
        pieces = encode(docs, chunk=chunk)
        found = {}
        for r in decode(pieces).orderBy("doc_id", "chunk").collect():
            found[r["doc_id"]] = found.get(r["doc_id"], "") + r["text"]
        assert found == {i: (t or "").replace(MARK, " ") for i, t, *_ in rows}
    sums = {(r["doc_id"], r["chunk"]): r for r in digest(pieces).collect()}
    for r in pieces.collect():
        d = sums[r["doc_id"], r["chunk"]]
        assert (d["n_pieces"], d["ids_crc32"]) == (len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))


def test_whole_texts_have_the_best_score(spark, model):
    docs = spark.createDataFrame(list(enumerate(texts(9))), "doc_id long, text string")
    out = {}
    for r in encode(docs, chunk=50).collect():
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + r["score"]
    for i, t in enumerate(texts(9)):
        assert out[i] == pytest.approx(model.path(MARK + t.replace(" ", MARK))[0], rel=1e-9)


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "z " * 40), (1, "z " * 40), (None, "b")], "doc_id long, text string")
    assert encode(docs.limit(0)).collect() == []
    out = encode(docs, chunk=30).collect()
    assert len([r for r in out if r["doc_id"] == 1]) == 2 * 3 and len(out) == 7


def test_a_model_with_pieces_beyond_marks_is_refused(monkeypatch):
    class Fake:
        def __init__(self, model_file):
            pass

        vocab_size = lambda self: 2
        id_to_piece = lambda self, i: ["a", f"a{MARK}b"][i]
        get_score = lambda self, i: -1.0
        is_byte = is_control = is_unknown = is_unused = lambda self, i: False

    monkeypatch.setattr("sentencepiece.SentencePieceProcessor", Fake)
    with pytest.raises(ValueError, match="space mark"):
        Lattice("any")
