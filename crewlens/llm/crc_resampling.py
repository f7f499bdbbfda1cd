"""Documents drawn by how much likelier a target distribution makes their features.

Method: a feature is a run of up to `longest` words, its bucket the CRC-32 of its bytes modulo `buckets`. A batch's distinct
features are grouped by equal length into two-dimensional uint8 arrays, one column per feature and one row per byte; all CRCs
of a group are updated together, byte by byte, and the buckets are scattered back to the features and from there to
their occurrences. Two sums of counts per bucket, over all documents and over the target's texts, give each bucket's gain;
a document's weight is the mean of its gains. Weight plus Gumbel noise from a hash of the id is its score, and the
highest scores are a sample without replacement in proportion to exp(weight / 1000).

Scale: texts are read twice and never shuffled. A task sends at most `buckets` counts. Scores lie in a range that follows
from the logarithms of 64-bit counts (some 200,000 steps), so the histogram that finds the lowest drawn score has a bound.
Only rows at or above that score are sorted, in ranges over all tasks; a row's rank is its place in its range and
the rows of the ranges before.

Defined cases: null text has no features and weight 0; null doc_id is hashed as an empty id and sorts last. Repeated rows
are documents of their own. An empty target or table is no error. Other columns are left alone. Features longer than
LONG bytes are summed one by one: a matrix as long as a text would have one column.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import written
from crewlens.llm.textkit import binaries, per_text, pieces, terms

LONG = 1024
POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each column of a (length, features) uint8 array."""
    crc = np.full(rows.shape[1], 0xFFFFFFFF, np.uint32)
    for row in rows:
        crc = (crc >> np.uint32(8)) ^ _TABLE[(crc ^ row) & np.uint32(0xFF)]
    return ~crc


def crc_buckets(data: np.ndarray, places: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each run of bytes between places, one matrix per length."""
    lengths = np.diff(places)
    order = np.argsort(lengths, kind="stable")
    out = np.empty(len(lengths), np.int64)
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        group, length = order[a:b], int(lengths[order[a]])
        if length > LONG:
            out[group] = [zlib.crc32(data[places[i] : places[i] + length]) for i in group]
        else:
            out[group] = crc_matrix(data[places[group] + np.arange(length)[:, None]])
    return out % buckets


def _runs_of(data: np.ndarray, places: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of n words of one text, joined by spaces: bytes, places, owners."""
    if n == 1:
        return data, places, owner
    at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else np.empty(0, np.int64)
    spaced = np.full(len(data) + len(owner), 32, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(len(owner)), np.diff(places))] = data
    first = places[:-1] + np.arange(len(owner))
    length = places[at + n] + at + n - 1 - first[at]
    joined = np.zeros(len(at) + 1, np.int64)
    np.cumsum(length, out=joined[1:])
    return spaced[np.repeat(first[at] - joined[:-1], length) + np.arange(joined[-1])], joined, owner[at]


def features(data: np.ndarray, offsets: np.ndarray, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and owning text of each feature, for each length of run."""
    text, places, first = terms(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    for n in range(1, longest + 1):
        raw, at, owners = _runs_of(text, places, owner, n)
        coded = binaries(raw, at).dictionary_encode()
        known = coded.dictionary
        edges = np.frombuffer(known.buffers()[1], np.int64, len(known) + 1)
        kept = known.buffers()[2]
        distinct = np.frombuffer(kept, np.uint8) if kept is not None and kept.size else np.empty(0, np.uint8)
        yield crc_buckets(distinct, edges, buckets)[coded.indices.to_numpy()], owners


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features per bucket of all texts (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                for bucket, _ in features(data, offsets, buckets, longest):
                    total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[counts["bucket"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the logarithm of how much likelier the target makes it, one count added to each bucket."""
    size = len(raw)
    s, t = (float(int(x.sum()) + size) for x in (raw, target))
    return np.array([math.floor(1000 * math.log((float(b + 1) * s) / (float(a + 1) * t))) for a, b in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def _weighed(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column("text")):
                size = b - a
                n, words, total = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
                for k, (bucket, owner) in enumerate(features(data, offsets, len(gain), longest)):
                    edges = np.searchsorted(owner, np.arange(size + 1))
                    total += per_text(gain[bucket], edges)
                    n += np.diff(edges)
                    if k == 0:
                        words = np.diff(edges)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, size), *(pa.array(x, pa.int64()) for x in (words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(seed: int):
    """Gumbel noise from the first 32 bits of a hash of the id, 1000 to the unit."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _lowest(levels: dict[int, int], wanted: int) -> int | None:
    """The highest score at or above which lie `wanted` rows."""
    for score in sorted(levels, reverse=True):
        wanted -= levels[score]
        if wanted <= 0:
            return score
    return None


def ranked(rows: DataFrame, order: list, name: str) -> DataFrame:
    """`rows` with `rank`, their place from 1 in the given order. Rows are sorted in ranges, written with their place in
    the range, and moved on by the rows of the ranges before: as many small counts as there are ranges."""
    placed = written(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), name)
    part, inside = F.shiftrightunsigned("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    before, offsets = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        offsets.append((r["part"], before))
        before += r["count"]
    known = rows.sparkSession.createDataFrame(offsets, "part long, before long")
    return placed.withColumn("part", part).join(F.broadcast(known), "part").withColumn("rank", F.col("before") + inside + 1).drop("part", "before", "place")


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10000, longest: int = 1, seed: int = 2024, least_words: int = 20, percent: int = 10
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of `docs` (doc_id, text), with `target`
    (text). Of the rows with `least_words` words `percent` of a hundred are drawn."""
    texts = docs.select("doc_id", "text")
    gain = gains(bucket_counts(texts, buckets, longest), bucket_counts(target, buckets, longest))
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = texts.mapInArrow(_weighed(gain, longest), f"doc_id {kind}, n_words long, n_features long, weight long")
    rows = written(weighed.withColumn("score", F.col("weight") + noise(seed)), "weights")
    able = F.col("n_words") >= least_words
    levels = {r["score"]: r["count"] for r in rows.where(able).groupBy("score").count().collect()}
    wanted = percent * sum(levels.values()) // 100
    lowest = _lowest(levels, wanted) if wanted else None
    high = able & (F.col("score") >= F.lit(lowest).cast("long")) if lowest is not None else F.lit(False)
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked(rows.where(high).select(*columns), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")], "drawn")
    rest = rows.where(~high).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")).unionByName(rest)


#: The CRC goes bit by bit over distinct words: their bytes, low bits first.
ORACLE_SQL = r"""
    WITH texts AS (
        SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
    ), wanted AS (
        SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
    ), held AS (SELECT row, unnest(words) AS word FROM texts
    ), raw AS (SELECT word, count(*) AS n FROM held GROUP BY word
    ), aimed AS (SELECT word, count(*) AS n FROM wanted GROUP BY word
    ), distinct_words AS (SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM raw UNION SELECT word FROM aimed)
    ), bits AS (
        SELECT word, list_transform(range(0, 4 * len(code)), lambda i:
            ((strpos('0123456789ABCDEF', substr(code, ((i // 8) * 2 + (CASE WHEN i % 8 < 4 THEN 2 ELSE 1 END))::INT, 1)) - 1) >> (i % 4)::INT) & 1) AS bits
        FROM distinct_words
    ), buckets AS (
        SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(bits, lambda b: b::BIGINT)),
            lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295::BIGINT) % 10000 AS bucket FROM bits
    ), s AS (SELECT bucket, sum(n)::BIGINT AS s FROM raw JOIN buckets USING (word) GROUP BY bucket
    ), t AS (SELECT bucket, sum(n)::BIGINT AS t FROM aimed JOIN buckets USING (word) GROUP BY bucket
    ), gains AS (
        SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM raw) + 10000)::DOUBLE)
            / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM aimed) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket)
    ), weights AS (
        SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
        FROM held JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row
    ), scored AS (
        SELECT doc_id, row, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
            list_reduce(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), i::INT, 1)) - 1)::BIGINT),
                lambda a, b: a * 16 + b) AS h
        FROM texts LEFT JOIN weights USING (row)
    ), noisy AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM scored
    ), placed AS (
        SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS n FROM noisy WHERE n_features >= 20
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM noisy LEFT JOIN placed USING (row)
"""
