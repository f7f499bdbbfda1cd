"""Token packing by Karmarkar-Karp multiway differencing.

A document is its token ids and a closing 0. Its full windows are sequences of their own; the rest (shorter than a
window) goes to a group. A group closes at `group_windows` windows of tokens, the last document cut so that the group
fills them exactly. Differencing then deals its pieces to that many windows: each piece starts as a partition with
one full window, and the two partitions of largest spread merge again and again, the heaviest window of one with the
lightest of the other, until one near-equal partition is left. Windows that end above their capacity are cut, and
what is cut off fills those below it; pieces that may not be cut get one more window and are dealt again.

What a task has left at its end also fills windows exactly, after a tail shorter than one window has become sequences of
powers of two, which need no padding. So padding is zero, for at most log2(window) short sequences per task.

A task holds one group and one document's ids at a time; nothing is shuffled. Sequence ids start with the task's
number, so they are unique. Defined cases: null and empty texts are the closing 0 alone; repeated rows are packed
each; an empty table has no pieces.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = 0
SPECIAL = "<|endoftext|>"
CHUNK = 1 << 20
_CUT = re.compile(r"\S(?=\s)")
Piece = tuple[int, int, int]  # document, start, length


@lru_cache(maxsize=2)
def tokenizer(path: str | None):
    """Encodes a text as the vocabulary in `path` does (byte_bpe_50k.json by default).

    The default's ids come from the same vocabulary's rank file, which is faster; a text that holds the special
    token's string goes to the file itself."""
    from tokenizers import Tokenizer

    if path is not None:
        whole = Tokenizer.from_file(path)
        return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    held: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            if not held:
                held.append(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
            return np.array(held[0].encode(text, add_special_tokens=False).ids, np.uint32)
        # No token goes on from a character other than white space into white space, so a long text may be cut there.
        parts, at = [], 0
        while len(text) - at > CHUNK:
            m = _CUT.search(text, at + CHUNK)
            if not m:
                break
            parts.append(np.array(fast.encode_ordinary(text[at : m.end()]), np.uint32))
            at = m.end()
        parts.append(np.array(fast.encode_ordinary(text[at:]), np.uint32))
        return np.concatenate(parts)

    return encode


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indexes of `sizes` dealt to `windows` near-equal windows."""
    if not sizes:
        return [[] for _ in range(windows)]
    order = count()
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, next(order), sums, [[i]] + [[] for _ in range(windows - 1)]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        sums = a + b[::-1]  # both fall: the heaviest window meets the lightest
        by = np.argsort(-sums, kind="stable")
        held = [held_a[k] + held_b[windows - 1 - k] for k in by.tolist()]
        sums = sums[by]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), next(order), sums, held))
    return heap[0][3]


def deal(pieces: list[Piece], capacity: int, cut: bool = True) -> list[list[Piece]]:
    """Pieces in as few windows as hold their total; cut where a window overflows, or, without cutting, in ever one
    window more until none does."""
    total = sum(p[2] for p in pieces)
    windows = max(1, -(-total // capacity))
    while True:
        dealt = [[pieces[i] for i in w] for w in differencing([p[2] for p in pieces], windows)]
        if all(sum(p[2] for p in w) <= capacity for w in dealt):
            return dealt
        if cut:
            break
        windows += 1
    spare: list[Piece] = []
    for w in dealt:
        over = sum(p[2] for p in w) - capacity
        while over > 0:
            doc, start, length = w.pop()
            kept = max(0, length - over)
            if kept:
                w.append((doc, start, kept))
            spare.append((doc, start + kept, length - kept))
            over -= length - kept
    for w in dealt:
        room = capacity - sum(p[2] for p in w)
        while room > 0 and spare:
            doc, start, length = spare.pop()
            if length > room:
                spare.append((doc, start + room, length - room))
                length = room
            w.append((doc, start, length))
            room -= length
    return dealt


def powers(tail: int) -> list[int]:
    """The powers of two that add up to `tail`, largest first."""
    return [1 << k for k in reversed(range(tail.bit_length())) if tail >> k & 1]


class _Packer:
    """One task's documents, group by group."""

    def __init__(self, part: int, window: int, group_windows: int, with_ids: bool):
        self.window, self.limit, self.with_ids = window, window * group_windows, with_ids
        self.sequence = part << 32
        self.docs: dict[int, tuple[object, np.ndarray]] = {}
        self.group: list[Piece] = []
        self.held = 0
        self.rows: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.number = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.number += 1
        self.docs[self.number] = doc_id, ids
        full = len(ids) // self.window * self.window
        for start in range(0, full, self.window):
            self._emit([(self.number, start, self.window)])
        start, rest = full, len(ids) - full
        while rest:
            take = min(rest, self.limit - self.held)
            self.group.append((self.number, start, take))
            self.held, start, rest = self.held + take, start + take, rest - take
            if self.held == self.limit:
                self._close()
        if not self.group or self.group[-1][0] != self.number:
            del self.docs[self.number]

    def finish(self) -> None:
        for size in powers(self.held % self.window):
            sequence = []
            while size:
                doc, start, length = self.group.pop()
                take = min(size, length)
                if take < length:
                    self.group.append((doc, start, length - take))
                sequence.append((doc, start + length - take, take))
                size -= take
            self._emit(sequence)
        if self.group:
            self._close()

    def _close(self) -> None:
        for sequence in deal(self.group, self.window):
            self._emit(sequence)
        last = self.number
        self.docs = {k: v for k, v in self.docs.items() if k == last}
        self.group, self.held = [], 0

    def _emit(self, sequence: list[Piece]) -> None:
        offset = 0
        for doc, start, length in sequence:
            doc_id, ids = self.docs[doc]
            part = ids[start : start + length]
            self.rows.append((doc_id, start, length, zlib.crc32(part.astype("<u4").tobytes()), len(ids), self.sequence, offset))
            if self.with_ids:
                self.ids.append(part)
            offset += length
        self.sequence += 1

    def taken(self) -> pa.RecordBatch:
        rows, ids, self.rows, self.ids = self.rows, self.ids, [], []
        columns = list(zip(*rows, strict=True)) or [[]] * len(FIELDS)
        arrays = [pa.array(c, pa.int64()) for c in columns]
        if self.with_ids:
            cuts = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat)))
        return pa.RecordBatch.from_arrays(arrays, [*FIELDS, *["ids"] * self.with_ids])


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _pack(window: int, group_windows: int, with_ids: bool, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        packer = None
        for batch in batches:
            for k in range(batch.num_rows):
                if packer is None:
                    packer = _Packer(batch.column("part")[0].as_py(), window, group_windows, with_ids)
                ids = encode(batch.column("text")[k].as_py() or "")
                packer.add(batch.column("doc_id")[k].as_py(), np.append(ids, np.uint32(END)))
                if len(packer.rows) >= 4096:
                    yield packer.taken()
        if packer is not None:
            packer.finish()
            yield packer.taken()

    return run


def pack_documents(docs: DataFrame, window: int = 1024, group_windows: int = 64, with_ids: bool = False, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids) of every piece of `docs`
    (integer doc_id, text). `window` must be a power of two."""
    ddl = ", ".join(f"{f} long" for f in FIELDS) + ", ids array<int>" * with_ids
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(_pack(window, group_windows, with_ids, tokenizer_path), ddl)
