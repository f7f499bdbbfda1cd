"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Base kinds: `assign` (a keyword, a sign and a value), `access` (an access key id) and `hex`. The method adds
`markov`: runs of 12 or more key characters that no base span touches and that a first-order Markov model of random
strings explains better than one of ordinary identifiers, by `margin` nats a character and `total` nats in all.

Both models are counts of character pairs over the whole corpus: the labelled samples are the values that base
spans hold (random) and runs of 8 or more key characters (ordinary). Corpora hold unmarked random strings too, so the
ordinary model is counted twice: first over runs of 8 to 19, then over all runs but those that the first model finds
random. Each task sends at most one count per pair and model, so the driver gets two small matrices however large the
corpus.

Of 500 bare random strings of letters and digits of 12, 16 and 20 characters each the models of 10,000 documents find 99 in a
hundred or more; they mark none of those documents.

Spans count code points, end exclusive. Defined cases: null is empty; a text without spans has an empty `spans` and the
hash of the empty string; overlapping spans of different kinds are all reported.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.textkit import pieces, runs

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG, ORDINARY, FIRST = 12, 8, 20
MARGIN, TOTAL = 2.0, 20.0
PIECE = 1 << 19  # bytes of text at a time: the arrays beside them are some sixty times as large
KEY = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LONG},}}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET)
_SYMBOL = np.full(256, -1, np.int16)
_SYMBOL[list(ALPHABET)] = np.arange(SIZE)
_LETTER, _DIGIT = (np.array([bool(re.match(p, chr(c))) for c in ALPHABET]) for p in ("[A-Za-z]", "[0-9]"))
# Paths, dates and numbers may be rare in a corpus and are no secrets: pairs with a sign and pairs of digits tell nothing.
_TELLING = (_LETTER[:, None] & (_LETTER | _DIGIT)) | (_DIGIT[:, None] & _LETTER)
_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Base spans as (start, end, kind), by start, then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _values(text: str) -> list[str]:
    """What base spans hold, without the words around it."""
    found = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    return found + [text[a:b] for a, b, kind in base_spans(text) if kind != "assign"]


def _suspects(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that may hold a base span, and texts with a long run of key characters: cheap tests on bytes."""
    raw = data.tobytes()
    low = raw.lower()
    places = []
    for word, body in [(k, low) for k in KEYWORDS] + [(b"AKIA", raw)]:
        at = body.find(word)
        while at >= 0:
            places.append(at)
            at = body.find(word, at + 1)
    start, end = runs(_HEX[data], offsets)
    places.extend(start[end - start >= 16].tolist())
    start, end = runs(_SYMBOL[data] >= 0, offsets)
    long = start[end - start >= LONG]

    def owners(x: np.ndarray) -> np.ndarray:
        return np.unique(np.searchsorted(offsets, x, "right") - 1)

    return owners(np.array(places, np.int64)), owners(long)


def _pairs(text: str) -> np.ndarray:
    symbols = _SYMBOL[np.frombuffer(text.encode(), np.uint8)].astype(np.int64)
    return np.bincount(symbols[:-1] * SIZE + symbols[1:], minlength=SIZE * SIZE)


def _training(odds: np.ndarray | None, margin: float, total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text"), PIECE):
                symbols = _SYMBOL[data].astype(np.int32)
                start, end = runs(symbols >= 0, offsets)
                # Without a model yet, runs too short for most bare secrets stand for the ordinary ones.
                wide = (end - start >= ORDINARY) & (end - start < FIRST if odds is None else True)
                start, end = start[wide], end[wide]
                pair = symbols[:-1] * SIZE + symbols[1:]
                if odds is None:
                    for i in _suspects(data, offsets)[0]:
                        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
                        for value in _values(text):
                            counts[1] += _pairs(value)
                elif len(start):
                    sums = np.zeros(len(data), np.float64)
                    both = (symbols[:-1] >= 0) & (symbols[1:] >= 0)
                    np.cumsum(np.where(both, odds.ravel()[np.where(both, pair, 0)], 0), out=sums[1:])
                    plain = ~_random(sums[end - 1] - sums[start], end - start, margin, total)
                    start, end = start[plain], end[plain]
                # The pairs inside the runs: from each start to the last but one character.
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, start, 1)
                np.add.at(edge, np.maximum(end - 1, start), -1)
                counts[0] += np.bincount(pair[np.cumsum(edge, dtype=np.int32)[: len(pair)] > 0], minlength=SIZE * SIZE)
        cells = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts.ravel()[cells], pa.int64())], ["cell", "n"])

    return run


def _random(score: np.ndarray, length: np.ndarray, margin: float, total: float) -> np.ndarray:
    """Whether runs of some length and log-likelihood ratio are taken for random strings."""
    return (length >= LONG) & (score >= total) & (score >= margin * (length - 1))


def log_odds(counts: np.ndarray, backoff: float = 20.0) -> np.ndarray:
    """log p(next | previous) under random strings minus under ordinary ones, from counts (2, SIZE * SIZE).

    Random strings are half uniform over the alphabet, as the labelled ones may use a part of it only; ordinary pairs
    back off to how often the next character is met at all."""
    ordinary, random = counts.reshape(2, SIZE, SIZE).astype(float)
    uniform = np.full(SIZE, 1 / SIZE)

    def given(x: np.ndarray, lower: np.ndarray, weight: float) -> np.ndarray:
        return (x + weight * lower) / (x.sum(1, keepdims=True) + weight)

    single = (ordinary.sum(0) + 1) / (ordinary.sum() + SIZE)
    odds = np.log((given(random, uniform, 1.0) + uniform) / 2) - np.log(given(ordinary, single, backoff))
    return np.where(_TELLING, odds, 0.0)


def train(docs: DataFrame, margin: float, total: float) -> np.ndarray:
    def counted(odds: np.ndarray | None) -> np.ndarray:
        rows = docs.select("text").mapInArrow(_training(odds, margin, total), "cell long, n long")
        cells = rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros(2 * SIZE * SIZE, np.int64)
        counts[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.int64)
        return counts.reshape(2, SIZE * SIZE)

    all_, random = counted(None)
    # Values of secrets lie in runs too.
    first = log_odds(np.stack([np.maximum(all_ - random, 0), random]))
    return log_odds(np.stack([counted(first)[0], random]))


def markov_spans(text: str, taken: list[Span], odds: np.ndarray, margin: float, total: float) -> list[Span]:
    """`taken` is sorted by start."""
    starts = [x for x, _, _ in taken]
    ends = list(accumulate((y for _, y, _ in taken), max))  # the furthest end so far
    found = []
    for m in KEY.finditer(text):
        a, b = m.span()
        before = bisect_left(starts, b)
        if before and ends[before - 1] > a:
            continue
        symbols = _SYMBOL[np.frombuffer(m[0].encode(), np.uint8)]
        if _random(odds[symbols[:-1], symbols[1:]].sum(), b - a, margin, total):
            found.append((a, b, "markov"))
    return found


def _scan(batches: Iterator[pa.RecordBatch], odds: np.ndarray, margin: float, total: float) -> Iterator[tuple[pa.RecordBatch, dict[int, tuple[str, list[Span], list[Span]]]]]:
    """Parts of the batches with (text, base spans, all spans) of the rows that have any."""
    for batch in batches:
        for a, b, data, offsets in pieces(batch.column("text"), PIECE):
            base, long = _suspects(data, offsets)
            found = {}
            for i in np.union1d(base, long).tolist():
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
                first = base_spans(text)
                spans = sorted(first + markov_spans(text, first, odds, margin, total), key=lambda s: (s[0], KINDS.index(s[2])))
                if spans:
                    found[i] = text, first, spans
            yield batch.slice(a, b - a), found


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _report(odds: np.ndarray, margin: float, total: float):
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scan(batches, odds, margin, total):
            n = {k: np.zeros(part.num_rows, np.int64) for k in KINDS}
            digest, joined = [empty] * part.num_rows, [""] * part.num_rows
            for i, (_, base, spans) in found.items():
                for _, _, kind in spans:
                    n[kind][i] += 1
                digest[i], joined[i] = hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)
            arrays = [part.column("doc_id"), *(pa.array(n[k]) for k in KINDS), pa.array(digest, pa.string()), pa.array(joined, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def scan_secrets(docs: DataFrame, margin: float = MARGIN, total: float = TOTAL) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 and spans per row of `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(_report(train(docs, margin, total), margin, total), ddl)


def _redacted(odds: np.ndarray, margin: float, total: float, mask: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scan(batches, odds, margin, total):
            if found:
                at = part.schema.get_field_index("text")
                texts = part.column(at).to_pylist()
                for i, (text, _, spans) in found.items():
                    out, last = [], 0
                    for a, b, _ in spans:
                        if b > last:
                            if a >= last:
                                out += [text[last:a], mask]
                            last = b
                    texts[i] = "".join([*out, text[last:]])
                part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
            yield part

    return run


def redact_secrets(docs: DataFrame, margin: float = MARGIN, total: float = TOTAL, mask: str = "[secret]") -> DataFrame:
    """`docs` with every span of its texts replaced by `mask`; overlapping spans become one."""
    named = docs.select(*(F.col(c).alias(c if c == "text" else f"keep_{c}") for c in docs.columns))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema)
    rows = named.mapInArrow(_redacted(train(docs, margin, total), margin, total, mask), ddl)
    return rows.select(*(F.col(c if c == "text" else f"keep_{c}").alias(c) for c in docs.columns))
