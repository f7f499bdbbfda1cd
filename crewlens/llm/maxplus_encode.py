"""SentencePiece encoding and decoding by a max-plus scan.

A text becomes the sequence of vocabulary pieces with the greatest sum of scores (the unigram reading of a model);
a character that no piece covers costs 10 more than the worst piece and is written as byte pieces. Spaces
become U+2581 and one is put in front, as the model's normalizer has it.

Best paths are max-plus products. A boundary state says how many characters beyond a cut the last piece reaches. Long
documents are split into chunks of `chunk` characters, dealt over all tasks; each yields its transfer matrix
(best score from entry state to exit state), the matrices of a document are combined associatively, and each chunk is
then backtraced by itself between its two states. Since no piece holds a space mark after another character, all paths
meet between a word and the mark after it: a chunk's matrix needs only the words at its two ends. Likewise they meet between any two
characters that no piece holds side by side: texts are cut there into parts, and equal parts are solved once, many of them in step.

Decoding puts pieces together again, each chunk by itself; characters never straddle chunks. Defined cases: null and
empty texts have one chunk without pieces; U+2581 in a text comes back as a space; unpaired surrogates cannot occur in
Spark strings; repeated rows are encoded each. Rows are told apart by their place in the input, not by doc_id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import written

MARK = "▁"
UNKNOWN_COST = 10.0
NONE = -np.inf
WIDE = 256  # longer parts are solved one by one
STEP = 1 << 16  # characters solved in step
REMEMBERED = 1 << 18
_MEETING = re.compile(f"[^{MARK}](?={MARK})")  # all paths meet after it


class Lattice:
    """The pieces of a model and best paths over them."""

    def __init__(self, path: str | None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.bytes = np.full(256, -1, np.int32)
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.pieces: dict[str, tuple[float, int]] = {}
        silent = set()
        for i, name in enumerate(self.names):
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
            elif model.is_control(i) or model.is_unknown(i):
                silent.add(i)
            elif not model.is_unused(i):
                self.pieces[name] = model.get_score(i), i
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for s, _ in self.pieces.values()) - UNKNOWN_COST
        for name in self.pieces:
            if MARK in name.lstrip(MARK):
                raise ValueError(f"piece {name!r} goes beyond a space mark")
        byte_of = {int(i): bytes([b]) for b, i in enumerate(self.bytes) if i >= 0}
        self.raw = [b"" if i in silent else byte_of.get(i, name.encode()) for i, name in enumerate(self.names)]
        self._forget()
        self._table()
        self._beside()

    def _table(self) -> None:
        """Open addressing from the hash of a piece's characters to its number."""
        self.factor = np.uint64(0x9E3779B97F4A7C15)
        self.power = np.full(self.longest + 1, self.factor, np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power, dtype=np.uint64)
        bits = 17 if len(self.pieces) <= 1 << 15 else 20
        self.shift = np.uint64(64 - bits)
        self.slots, self.value = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.score = np.full(len(self.names) + 1, NONE)
        self.probes = 1
        for name, (score, i) in self.pieces.items():
            self.score[i] = score
            h = 0
            for c in name:
                h = (h * int(self.factor) + ord(c) + 1) % (1 << 64)
            slot = self._slot(np.array([h], np.uint64))[0]
            tries = 1
            while self.value[slot] >= 0:
                slot, tries = (slot + 1) % len(self.slots), tries + 1
            self.slots[slot], self.value[slot] = h, i
            self.probes = max(self.probes, tries)

    def _beside(self) -> None:
        """Which characters pieces hold side by side: by the number of the one and of the other, 0 for all that have none."""
        pairs = {pair for name in self.pieces for pair in zip(name, name[1:], strict=False)}
        numbers = []
        self.before, self.after = np.zeros(0x110000, np.uint16), np.zeros(0x110000, np.uint16)
        for side, table in enumerate((self.before, self.after)):
            own = {c: i for i, c in enumerate(sorted({pair[side] for pair in pairs}), 1)}
            for c, i in own.items():
                table[ord(c)] = i
            numbers.append(own)
        self.beside = np.zeros([len(own) + 1 for own in numbers], bool)
        for a, b in pairs:
            self.beside[numbers[0][a], numbers[1][b]] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        slot = self._slot(hashes)
        out = np.where(self.slots[slot] == hashes, self.value[slot], -1)
        for k in range(1, self.probes):
            open_ = np.flatnonzero((out < 0) & (self.value[slot] >= 0))
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) % len(self.slots)
            hit = self.slots[slot[open_]] == hashes[open_]
            out[open_[hit]] = self.value[slot[open_[hit]]]
        return out

    def path(self, text: str, stop: int | None = None) -> tuple[float, list[int]]:
        """Best pieces of one string. With `stop`, no piece may end in [stop, end of the string)."""
        n = len(text)
        best, back = [0.0] + [NONE] * n, [(0, -1)] * (n + 1)
        for end in range(1, n + 1):
            if stop is not None and stop <= end < n:
                continue
            top, last = best[end - 1] + self.unknown, (1, -1)
            for size in range(1, min(self.longest, end) + 1):
                if best[end - size] > NONE:
                    found = self.pieces.get(text[end - size : end])
                    if found and best[end - size] + found[0] >= top:
                        top, last = best[end - size] + found[0], (size, found[1])
            best[end], back[end] = top, last
        out, at = [], n
        if best[n] == NONE:
            return NONE, []
        while at:
            size, piece = back[at]
            out += [piece] if piece >= 0 else [int(self.bytes[b]) for b in reversed(text[at - size : at].encode())]
            at -= size
        return best[n], out[::-1]

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of many strings (flat), their bounds, and the strings' scores. All paths meet between two characters that
        no piece holds side by side: strings are cut there, and equal parts are solved once. Parts that a process has solved
        before are looked up; it remembers `REMEMBERED` of at most `WIDE` characters, then starts anew."""
        whole = "".join(texts)
        edges = np.cumsum([0, *map(len, texts)])
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        cut = np.ones(len(codes) + 1, bool)
        if len(codes):
            cut[1:-1] = ~self.beside[self.before[codes[:-1]], self.after[codes[1:]]]
        cut[edges] = True
        start = np.flatnonzero(cut)
        raw = np.frombuffer(whole.encode(), np.uint8)
        places = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[start]  # in bytes
        parts = pa.LargeStringArray.from_buffers(len(start) - 1, pa.py_buffer(places), pa.py_buffer(raw)).dictionary_encode()
        at, points, flat, bounds = self._known(parts.dictionary.to_pylist())
        at = at[parts.indices.to_numpy()]
        n = np.diff(bounds)[at]
        ends = np.cumsum(n)
        ids = flat[np.arange(n.sum()) + np.repeat(bounds[at] - ends + n, n)]
        first = np.searchsorted(start, edges)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        return ids, np.append(0, ends)[first], np.bincount(owner, points[at], len(texts))

    def _known(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of each of these distinct strings; scores, pieces (flat) and their bounds by number."""
        if len(self.solved) > REMEMBERED:
            self._forget()
        solved = self.solved
        at = list(map(solved.get, parts))
        new = [k for k, i in enumerate(at) if i is None]
        if not new:
            return np.array(at, np.int64), self.points, self.flat, self.bounds
        new.sort(key=lambda k: len(parts[k]), reverse=True)
        wide = next((i for i, k in enumerate(new) if len(parts[k]) <= WIDE), len(new))
        new = new[wide:] + new[:wide]
        keep, base = len(new) - wide, len(solved)
        ids, counts, scores = [], [], []
        sizes = np.cumsum([len(parts[k]) for k in new[:keep]])
        a = 0
        while a < keep:
            b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + STEP, "right")))
            found = self._in_step([parts[k] for k in new[a:b]])
            for held, more in zip((ids, counts, scores), found, strict=True):
                held.append(more)
            a = b
        for k in new[keep:]:
            score, path = self.path(parts[k])
            ids.append(np.array(path, np.int32))
            counts.append([len(path)])
            scores.append([score])
        for i, k in enumerate(new):
            at[k] = base + i
        solved.update((parts[k], base + i) for i, k in enumerate(new[:keep]))
        points, flat = np.concatenate([self.points, *scores]), np.concatenate([self.flat, *ids])
        bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(counts)))
        self.points, self.bounds = points[: base + keep], bounds[: base + keep + 1]
        self.flat = flat[: self.bounds[-1]] if keep == len(new) else flat[: self.bounds[-1]].copy()
        return np.array(at, np.int64), points, flat, bounds

    def _forget(self) -> None:
        self.solved: dict[str, int] = {}
        self.points, self.flat, self.bounds = np.empty(0), np.empty(0, np.int32), np.zeros(1, np.int64)

    def _in_step(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces (flat), how many each word has, and scores of words in falling order of length."""
        length = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        first = np.cumsum(length) - length
        place = np.arange(len(flat)) - np.repeat(first, length)
        # Pieces that end at each character, the longest first: equal sums go to the longer last piece.
        reach = min(self.longest, int(length[0]))
        piece = np.full((len(flat), reach), -1, np.int32)
        codes = flat + np.uint64(1)
        hashes, at = codes, np.arange(len(flat))
        for k in range(1, reach + 1):
            if k > 1:
                inside = place[at] >= k - 1
                at = at[inside]
                hashes = (hashes_before[at - 1] * self.factor) + codes[at]
            piece[at, reach - k] = self._find(hashes)
            hashes_before = np.zeros(len(flat), np.uint64)
            hashes_before[at] = hashes
        score = self.score[piece]
        base = first + np.arange(len(words))  # a word has one boundary more than it has characters
        best = np.zeros(len(flat) + len(words))
        size, taken = np.zeros(len(best), np.int8), np.full(len(best), -1, np.int32)
        back = np.arange(reach, 0, -1)
        live = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")
        for end, n in enumerate(live.tolist(), 1):
            here, row, k = base[:n] + end, first[:n] + (end - 1), min(reach, end)
            value = best[here[:, None] - back[reach - k :]] + score[row, reach - k :]
            which = value.argmax(1)
            top, bare = value[np.arange(n), which], best[here - 1] + self.unknown
            known = top >= bare
            best[here] = np.where(known, top, bare)
            size[here] = np.where(known, k - which, 1)
            taken[here] = np.where(known, piece[row, which + (reach - k)], -1)
        here, steps, ends = length.copy(), [], []
        while here.any():
            steps.append(np.where(here > 0, taken[base + here], -2))
            ends.append(here.copy())
            here -= np.where(here > 0, size[base + here], 0)
        steps, ends = np.stack(steps[::-1], 1), np.stack(ends[::-1], 1)
        used = steps > -2
        ids, counts = steps[used].astype(np.int32), used.sum(1)
        if (ids < 0).any():  # characters that only bytes can write
            word, step = np.nonzero(used)
            gone = np.flatnonzero(ids < 0)
            raw = [chr(c).encode() for c in flat[first[word[gone]] + ends[word[gone], step[gone]] - 1].tolist()]
            n = np.ones(len(ids), np.int64)
            n[gone] = [len(x) for x in raw]
            spelled = np.repeat(ids < 0, n)
            ids = np.repeat(ids, n)
            ids[spelled] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
            counts = np.bincount(word, n, len(words)).astype(np.int64)
        return ids, counts, best[base + length]

    def spread(self, text: str, ahead: str, entries: int) -> np.ndarray:
        """Best scores from each entry state to each exit state of a string, in one pass over its characters: all entries
        go along side by side, and pieces over the end are looked for once at the end."""
        n, states, whole = len(text), self.longest, text + ahead
        best = np.full((n + 1, entries), NONE)
        for s in range(min(entries, n + 1)):
            best[s, s] = 0.0
        for end in range(1, n + 1):
            top = np.maximum(best[end], best[end - 1] + self.unknown)
            for size in range(1, min(states, end) + 1):
                found = self.pieces.get(text[end - size : end])
                if found:
                    np.maximum(top, best[end - size] + found[0], out=top)
            best[end] = top
        out = np.full((entries, states), NONE)
        out[:, 0] = best[n]
        for e in range(1, min(states - 1, len(ahead)) + 1):
            for size in range(e + 1, min(states, n + e) + 1):
                found = self.pieces.get(whole[n + e - size : n + e])
                if found:
                    out[:, e] = np.maximum(out[:, e], best[n + e - size] + found[0])
        # A piece that covers the whole string and more leaves it in a state of its own.
        for s in range(n + 1, entries):
            out[s, s - n] = 0.0
        return out

    def transfer(self, text: str, ahead: str) -> np.ndarray:
        """Best scores from each entry state to each exit state of a chunk of marked text, but for the words
        strictly inside it, which all paths have in common."""
        cuts = [m.start() + 1 for m in _MEETING.finditer(text)]
        if not cuts:
            return self.spread(text, ahead, self.longest)
        head = self.spread(text[: cuts[0]], "", self.longest)[:, 0]
        return np.add.outer(head, self.spread(text[cuts[-1] :], ahead, 1)[0])

    def chunks(self, chunks: list[tuple[str, str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces (flat) that start in each chunk (text, ahead, entry, leave), between its two states; their bounds; scores."""
        bodies, tails = [], []
        for text, ahead, entry, leave in chunks:
            meetings = [m.start() + 1 for m in _MEETING.finditer(text, entry)] if leave else []
            last = (meetings[-1] if meetings else min(entry, len(text))) if leave else len(text)
            bodies.append(text[entry:last])
            tails.append(self.path(text[last:] + ahead[:leave], len(text) - last) if leave and entry < len(text) else (0.0, []))
        ids, bounds, scores = self.words(bodies)
        if any(tail for _, tail in tails):
            parts = [x for a, b, (_, tail) in zip(bounds[:-1], bounds[1:], tails, strict=True) for x in (ids[a:b], np.array(tail, np.int32))]
            ids, bounds = np.concatenate(parts), bounds + np.cumsum([0, *(len(tail) for _, tail in tails)])
        return ids, bounds, scores + [score for score, _ in tails]

    def chunk(self, text: str, ahead: str, entry: int, leave: int) -> tuple[np.ndarray, float]:
        """Pieces of one chunk, and its score."""
        ids, _, scores = self.chunks([(text, ahead, entry, leave)])
        return ids, float(scores[0])

    def decode(self, ids: list[int], first: bool) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if first and text.startswith(" ") else text


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of (stacks of) matrices, one inner state after the other: no array is larger than the stack."""
    out = a[..., :, 0, None] + b[..., None, 0, :]
    for k in range(1, a.shape[-1]):
        np.maximum(out, a[..., :, k, None] + b[..., None, k, :], out=out)
    return out


def prefixes(matrices: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... matrices, in log2 rounds."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out = np.concatenate([out[:step], combined(out[:-step], out[step:])])
        step *= 2
    return out


def states(matrices: np.ndarray) -> list[int]:
    """The boundary states of the best path: before the first chunk, between chunks, after the last."""
    ahead = prefixes(matrices)
    out = [0]
    for i in range(len(matrices) - 1, 0, -1):
        out.append(int((ahead[i - 1][0] + matrices[i][:, out[-1]]).argmax()))
    return [*([0] if len(matrices) else []), *out[::-1]]


@lru_cache(maxsize=2)
def lattice(path: str | None) -> Lattice:
    return Lattice(path)


OUT = "chunk int, n_chars long, ids array<int>, score double"


def _result(columns: dict, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    flat, bounds, scores = found
    columns = columns | {"ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)), "score": pa.array(scores, pa.float64())}
    return pa.RecordBatch.from_pydict(columns)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of some 2 MB together."""
    step = max(1, int(batch.num_rows * (2 << 20) / max(batch.nbytes, 1)))
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step)


def _short(path: str | None):
    """Texts of one chunk, many at a time: equal parts are solved once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for part in (p for batch in batches for p in _pieces(batch)):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = model.words([MARK + t.replace(" ", MARK) if t else "" for t in texts])
            columns = {"doc_id": part.column("doc_id"), "chunk": pa.array([0] * len(texts), pa.int32()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield _result(columns, found)

    return run


def _matrices(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in batches:
            raw = [model.transfer(t, a).tobytes() for t, a in zip(batch.column("marked").to_pylist(), batch.column("ahead").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(raw, pa.binary())], ["row", "chunk", "matrix"])

    return run


def _boundaries(table: pa.Table) -> pa.Table:
    """Entry and exit state of each chunk of one document."""
    table = table.sort_by("chunk")
    raw = [np.frombuffer(m.as_buffer(), np.float64) for m in table["matrix"]]
    size = int(len(raw[0]) ** 0.5)
    found = states(np.stack(raw).reshape(-1, size, size))
    return pa.table({"row": table["row"], "chunk": table["chunk"], "entry": pa.array(found[:-1], pa.int32()), "leave": pa.array(found[1:], pa.int32())})


def _long(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for part in (p for batch in batches for p in _pieces(batch)):
            found = model.chunks(list(zip(*(part.column(c).to_pylist() for c in ("marked", "ahead", "entry", "leave")), strict=True)))
            yield _result({c: part.column(c) for c in ("doc_id", "chunk", "n_chars")}, found)

    return run


def _cut(chunk: int, ahead: int):
    """Chunks of each long text, spread over rows. `ahead`: characters that a piece may reach beyond a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for k in range(batch.num_rows):
                text = MARK + batch.column("text")[k].as_py().replace(" ", MARK)
                row = (batch.column("part")[k].as_py() << 40) + number
                number += 1
                for c, at in enumerate(range(0, len(text), chunk)):
                    part = text[at : at + chunk]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array([row], pa.int64()),
                            "doc_id": batch.column("doc_id").slice(k, 1),
                            "chunk": pa.array([c], pa.int32()),
                            "marked": pa.array([part], pa.string()),
                            "ahead": pa.array([text[at + chunk : at + chunk + ahead]], pa.string()),
                            "n_chars": pa.array([len(part) - (c == 0)], pa.int64()),
                        }
                    )

    return run


def encode(docs: DataFrame, chunk: int = 1 << 15, model_path: str | None = None) -> DataFrame:
    """doc_id, chunk, n_chars, ids, score: the pieces of each chunk of `docs` (doc_id, text), in order of chunks."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text"), F.lit(0)) >= chunk
    short = rows.where(~is_long).mapInArrow(_short(model_path), f"doc_id {kind}, {OUT}")
    reach = lattice(model_path).longest - 1
    parts = rows.where(is_long).withColumn("part", F.spark_partition_id()).mapInArrow(
        _cut(chunk, reach), f"row long, doc_id {kind}, chunk int, marked string, ahead string, n_chars long"
    )
    parts = written(parts, "chunks").repartition("row", "chunk")  # one giant document feeds many tasks
    matrices = parts.select("row", "chunk", "marked", "ahead").mapInArrow(_matrices(model_path), "row long, chunk int, matrix binary")
    known = matrices.groupBy("row").applyInArrow(_boundaries, "row long, chunk int, entry int, leave int")
    long = parts.join(known, ["row", "chunk"]).select("doc_id", "chunk", "n_chars", "marked", "ahead", "entry", "leave")
    return short.unionByName(long.mapInArrow(_long(model_path), f"doc_id {kind}, {OUT}"))


def _decoded(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in batches:
            texts = [model.decode(ids or [], c == 0) for ids, c in zip(batch.column("ids").to_pylist(), batch.column("chunk").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("chunk"), pa.array(texts, pa.string())], ["doc_id", "chunk", "text"])

    return run


def decode(pieces: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, chunk, text: what the pieces of each chunk (doc_id, chunk, ids) stand for; a document's text is that of its
    chunks in order."""
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return pieces.select("doc_id", "chunk", "ids").mapInArrow(_decoded(model_path), f"doc_id {kind}, chunk int, text string")


def _digest(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in batches:
            lists = batch.column("ids")
            values, bounds = lists.flatten().to_numpy(), np.asarray(lists.offsets)
            base = bounds[0]
            parts = [values[a - base : b - base] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            texts = [model.decode(p.tolist(), c == 0) for p, c in zip(parts, batch.column("chunk").to_pylist(), strict=True)]
            columns = {c: batch.column(c) for c in ("doc_id", "chunk", "n_chars", "score")} | {
                "n_pieces": pa.array([len(p) for p in parts], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64()),
                "text_crc32": pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def digest(pieces: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, chunk, n_chars, score, n_pieces, and checksums of the ids and of the text decoded from them."""
    kind = pieces.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, chunk int, n_chars long, score double, n_pieces long, ids_crc32 long, text_crc32 long"
    return pieces.mapInArrow(_digest(model_path), ddl)
