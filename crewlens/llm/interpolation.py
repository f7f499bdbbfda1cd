"""Language-model scores by deleted interpolation.

The probability of a word after another mixes three estimates: the bigram's and the word's maximum-likelihood
estimates and a uniform one. The weights depend on how often the context was seen (one bucket per power of two)
and are learned by expectation-maximisation on events held out from the counts.

Training rows are split in two: `fold` 1 is deleted (held out for the weights), the rest is retained. Weights
come from retained counts and deleted events; scores use the counts of both.

How the counts travel. Documents are read in blocks of about 12 MB. A block asks for the counts of its distinct
n-grams (hash, own counts), cut into ranges of the hash space; each range adds up what all blocks hold and answers
in the same order. So a shuffle carries each distinct n-gram of a block once, no vocabulary is broadcast, and no
key gets more than one entry per block. The answers are written to the shared folder once; the weights and
the scores read them from there.

Defined cases: a null or empty text is its end token alone. An empty training set gives uniform scores. Extra columns
of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import hash_ranges, remainder, written
from crewlens.llm.textkit import Words, mix, ngrams, pack, slices, unpack

END = np.uint64(0x0123456789ABCDEF)
START = np.uint64(0xFEDCBA9876543210)
CONTEXTS = 40
CELLS = 128
STEP = 2.0
HELD_OUT, DELETED, RETAINED = 0, 1, 2


class Sequence:
    """Tokens of some texts, each closed by an end token, and the bigrams that end at each token."""

    def __init__(self, words: Words):
        self.length = words.counts() + 1
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        token = np.full(self.first[-1], END, np.uint64)
        inner = np.ones(len(token), bool)
        inner[self.first[1:] - 1] = False
        token[inner] = words.hash
        context = np.concatenate([np.array([START], np.uint64), token])[:-1]
        context[self.first[:-1]] = START
        self.token = mix(token)
        # Contexts are tokens as well: a start is seen as often as an end.
        self.context = mix(np.where(context == START, END, context))
        both = np.empty(2 * len(token), np.uint64)
        both[::2], both[1::2] = context, token
        self.bigram = ngrams(both, 2)[::2]
        self.owner = np.repeat(np.arange(words.size), self.length)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows of one partition in runs of about `size` bytes."""
    held, held_bytes, number = [], 0, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1) / 2))
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            held.append(part)
            held_bytes += part.nbytes
            if held_bytes >= size:
                yield number, pa.Table.from_batches(held)
                held, held_bytes, number = [], 0, number + 1
    if held:
        yield number, pa.Table.from_batches(held)


def _requests(size: int, ranges: int):
    shift = np.uint64(64 - int(math.log2(ranges)))

    def grams(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        role = table["role"].to_numpy()
        parts: tuple[list, list] = ([], [])
        for a, b, words in slices(table["text"], lower=True):
            seq = Sequence(words)
            mark = role[a:b][seq.owner]
            for k, keys in enumerate((seq.token, seq.bigram)):
                found, at = np.unique(keys, return_inverse=True)
                parts[k].append((found, *(np.bincount(at[mark == r], minlength=len(found)) for r in (RETAINED, DELETED))))
        return [merged(p) for p in parts]

    def rows(order: int, block: int, keys: np.ndarray, kept: np.ndarray, deleted: np.ndarray) -> Iterator[pa.RecordBatch]:
        bounds = np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64)) if ranges > 1 else [0, len(keys)]
        full = [(r, a, b) for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
        for k in range(0, len(full), 64):
            some = full[k : k + 64]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([r for r, _, _ in some], pa.int32()),
                    "ngram": pa.array([order] * len(some), pa.int32()),
                    "block": pa.array([block] * len(some), pa.int64()),
                    "hashes": pa.array([keys[a:b].tobytes() for _, a, b in some], pa.binary()),
                    "kept": pa.array([pack(kept[a:b]) for _, a, b in some], pa.binary()),
                    "deleted": pa.array([pack(deleted[a:b]) for _, a, b in some], pa.binary()),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _blocks(batches, size):
            for order, (keys, kept, deleted) in enumerate(grams(table), 1):
                block = (int(table["part"][0].as_py()) << 32) + number
                yield from rows(order, block, keys, kept, deleted)
                events = keys[deleted > 0]
                none = np.zeros(len(events), np.int64)
                yield from rows(order, -1 - block, events, none, none)  # asks only: counted above

    return run


def merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the same keys added up."""
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *(np.bincount(at, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64) for k in (1, 2))


def _answers(table: pa.Table) -> pa.Table:
    """One range of one n-gram order: the corpus counts of each block's n-grams, in the block's order.
    `tokens` and `types` hold the range's sums on its first row."""
    hashes = [np.frombuffer(x.as_py(), np.uint64) for x in table["hashes"]]
    keys, at = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = []
    for name in ("kept", "deleted"):
        totals.append(np.bincount(at, np.concatenate([unpack(x.as_py()) for x in table[name]]), len(keys)).astype(np.int64))
    kept, deleted = totals
    cuts = np.cumsum([len(x) for x in hashes])[:-1]
    n = len(hashes)
    once = [1] + [0] * (n - 1)
    sums = {
        "kept_tokens": int(kept.sum()),
        "kept_types": int((kept > 0).sum()),
        "tokens": int((kept + deleted).sum()),
        "types": int((kept + deleted > 0).sum()),
    }
    parts = np.split(at, cuts)
    return pa.table(
        {"block": table["block"], "ngram": table["ngram"], "range": table["range"]}
        | {"kept": pa.array([pack(kept[p]) for p in parts], pa.binary()), "deleted": pa.array([pack(deleted[p]) for p in parts], pa.binary())}
        | {k: pa.array([v * x for x in once], pa.int64()) for k, v in sums.items()}
    )


class Lookup:
    """A block's distinct n-grams with their corpus counts."""

    def __init__(self, keys: np.ndarray, answers: pa.Table, order: int):
        rows = sorted((r, i) for i, (r, o) in enumerate(zip(answers["range"].to_pylist(), answers["ngram"].to_pylist(), strict=True)) if o == order)
        self.keys = keys
        self.kept, self.deleted = (np.concatenate([unpack(answers[name][i].as_py()) for _, i in rows] or [np.empty(0, np.int64)]) for name in ("kept", "deleted"))
        if len(self.kept) != len(keys):
            raise RuntimeError(f"block of {len(keys)} n-grams got {len(self.kept)} answers")

    def __call__(self, keys: np.ndarray, deleted: bool) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        return (self.kept[at] + self.deleted[at]) if deleted else self.kept[at]


def _sequences(texts: pa.Table) -> tuple[list[Sequence], np.ndarray, np.ndarray]:
    seqs, tokens, bigrams = [], [], []
    for _, _, words in slices(texts["text"], lower=True):
        seq = Sequence(words)
        seqs.append(seq)
        tokens.append(np.unique(seq.token))
        bigrams.append(np.unique(seq.bigram))
    return seqs, np.unique(np.concatenate(tokens)), np.unique(np.concatenate(bigrams))


def _ratios(seq: Sequence, one: Lookup, two: Lookup, tokens: int, types: int, deleted: bool) -> tuple[np.ndarray, ...]:
    """Per token: count, context bucket, and both estimates as multiples of the uniform one."""
    count, context = one(seq.token, deleted), one(seq.context, deleted)
    # A text's closing token follows its last word; every token but the closing one is a context once.
    bigram = two(seq.bigram, deleted)
    uniform = 1.0 / (types + 1)
    word = count / max(tokens, 1) / uniform
    pair = np.where(context > 0, bigram / np.maximum(context, 1), 0.0) / uniform
    bucket = np.frexp(context.astype(np.float64))[1].clip(0, CONTEXTS - 1)
    return count, bucket, word, pair


def _events(tokens: int, types: int):
    """Held-out events as counts over (context bucket, level of the word's ratio, level of the pair's)."""

    def level(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(x > 0, (np.log2(x) * STEP + CELLS // 2).round().clip(1, CELLS - 1), 0).astype(np.int64)

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        counts = np.zeros(CONTEXTS * CELLS * CELLS, np.int64)
        if texts.num_rows:
            seqs, ones, twos = _sequences(texts)
            one, two = Lookup(ones, answers, 1), Lookup(twos, answers, 2)
            for seq in seqs:
                _, bucket, word, pair = _ratios(seq, one, two, tokens, types, deleted=False)
                counts += np.bincount((bucket * CELLS + level(word)) * CELLS + level(pair), minlength=len(counts))
        cells = np.flatnonzero(counts)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(counts[cells], pa.int64())})

    return run


def fit_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = 50, prior: float = 1.0) -> np.ndarray:
    """Weights (uniform, word, pair) of each context bucket by expectation-maximisation.

    `prior` events per component keep every weight positive, so an unseen word never has probability 0."""

    def ratio(level: np.ndarray) -> np.ndarray:
        return np.where(level > 0, 2.0 ** ((level - CELLS // 2) / STEP), 0.0)

    bucket, word, pair = cells // CELLS**2, ratio(cells // CELLS % CELLS), ratio(cells % CELLS)
    value = np.stack([np.ones(len(cells)), word, pair])
    weights = np.full((CONTEXTS, 3), 1 / 3)
    weights[0] = [0.5, 0.5, 0.0]
    for _ in range(rounds):
        share = weights[bucket].T * value
        share *= counts / share.sum(0)
        sums = np.stack([np.bincount(bucket, s, CONTEXTS) for s in share], 1) + prior
        weights = sums / sums.sum(1, keepdims=True)
    weights[0] = [weights[0][0], 1 - weights[0][0], 0.0]  # an unseen context has no pair estimate
    return weights


def _scores(weights: np.ndarray, tokens: int, types: int):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        if texts.num_rows:
            seqs, ones, twos = _sequences(texts)
            one, two = Lookup(ones, answers, 1), Lookup(twos, answers, 2)
            for seq in seqs:
                count, bucket, word, pair = _ratios(seq, one, two, tokens, types, deleted=True)
                mixture = (weights[bucket, 0] + weights[bucket, 1] * word + weights[bucket, 2] * pair) / (types + 1)
                base = np.log10((count + 0.1) / (tokens + 0.1 * (types + 1)))
                first = seq.first[:-1]
                out["n_tokens"].append(seq.length)
                out["n_known"].append(np.add.reduceat((count > 0).astype(np.int64), first))
                out["base_score"].append(np.add.reduceat(base, first))
                out["score"].append(np.add.reduceat(np.log10(mixture), first))
        kinds = {"n_tokens": np.int64, "n_known": np.int64, "base_score": np.float64, "score": np.float64}
        arrays = {k: pa.array(np.concatenate([*v, np.empty(0, kinds[k])]).astype(kinds[k])) for k, v in out.items()}
        return pa.table({"doc_id": texts["doc_id"], "held_out": pa.array(texts["role"].to_numpy() == HELD_OUT, pa.bool_())} | arrays)

    return run


def interpolated_scores(docs: DataFrame, block_bytes: int = 12 << 20, ranges: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score, train_tokens per row of `docs` (doc_id, text).

    `ranges`: parts of the hash space, a power of two; by default at least the session's shuffle partitions, and so many that
    one holds about 64 MB: a byte of text sends about 1.5 bytes of hashes and counts."""
    spark = docs.sparkSession
    if ranges is None:
        ranges = hash_ranges(spark, 1.5 * (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0))
    fold = remainder("doc_id", 10)
    role = F.when(fold == 0, HELD_OUT).when(fold == 1, DELETED).otherwise(RETAINED).cast("int")
    rows = docs.select("doc_id", "text", role.alias("role"), F.spark_partition_id().alias("part"))

    asked = rows.mapInArrow(_requests(block_bytes, ranges), "range int, ngram int, block long, hashes binary, kept binary, deleted binary")
    reply = "block long, ngram int, range int, kept binary, deleted binary, kept_tokens long, kept_types long, tokens long, types long"
    answers = written(asked.groupBy("ngram", "range").applyInArrow(_answers, reply), "interpolation")
    sums = answers.where("ngram = 1").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("kept_tokens", "kept_types", "tokens", "types"))).first()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _blocks(batches, block_bytes):
            block = (int(table["part"][0].as_py()) << 32) + number
            for batch in table.select(["doc_id", "text", "role"]).to_batches():
                yield batch.append_column("block", pa.array([block] * batch.num_rows, pa.int64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = rows.mapInArrow(numbered, f"doc_id {kind}, text string, role int, block long")
    given = answers.select("block", "ngram", "range", "kept", "deleted")
    deleted = texts.where(F.col("role") == DELETED).withColumn("block", -1 - F.col("block")).groupBy("block")
    events = deleted.cogroup(given.where("block < 0").groupBy("block")).applyInArrow(_events(sums[0], sums[1]), "cell long, n long")
    cells = events.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    weights = fit_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.float64))
    scored = texts.groupBy("block").cogroup(given.where("block >= 0").groupBy("block")).applyInArrow(
        _scores(weights, sums[2], sums[3]), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(int(sums[2])).cast("long"))
