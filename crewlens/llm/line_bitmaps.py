"""Lines that an earlier document has, dropped by keep bitmaps.

Method: every line's key (stripped, A-Z lower-cased) becomes two 64-bit hashes. The hash space is cut into equal ranges,
one per shuffle partition, and a range's lines are sorted by hash, document and position: the first line of a run is the
key's first occurrence, and all lines of other documents behind it are marked as dropped. Only (document, position)
travels on. Per document the marks become a keep bitmap in run-length form: the runs [start, stop) of lines that stay, the
last run open. Documents without a mark have no bitmap.

A key that a large part of all lines have is split: a sample of one line in 32 tells which keys would fill more than half a
range (fewer than two per range, so they may be sent to every task) and into how many following ranges each is dealt, by
document and position. Its parts' least documents are settled in one small sum before marks count. The sample only steers
where rows go; the result is the same whichever keys it finds.

All of it is DataFrame functions: no Python rows.

Defined cases: null text is one empty line. Rows without doc_id count as one document that comes after all others. Rows
with the same doc_id are one document: what one holds, the other may keep. Equal rows get equal bitmaps. An empty table gives
no rows. Other columns are left alone. Two keys with equal 128-bit hashes would count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crewlens.llm.shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
#: One line in so many is counted to find frequent keys.
SAMPLED = 32


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _print(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased. `lower` is the faster of the two forms, and does the same
    to text of single bytes only."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashed(docs: DataFrame, min_chars: int, one_in: int = 1) -> DataFrame:
    """doc_id, print, pos, h1, h2 of each line whose key is long enough; of one line in `one_in`."""
    lines = docs.select("doc_id", _print(F.col("text")).alias("print"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    if one_in > 1:
        lines = lines.where(F.pmod(F.xxhash64("doc_id", "print", "pos"), F.lit(one_in)) == 0)
    keys = lines.where(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return keys.select("doc_id", "print", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(11), "key").alias("h2"))


def _frequent(docs: DataFrame, min_chars: int, ranges: int) -> DataFrame:
    """h1, h2 and parts of the keys that would fill more than half a range: fewer than 2 * ranges rows."""
    counts = written(_hashed(docs, min_chars, SAMPLED).groupBy("h1", "h2").agg(F.count("*").alias("n")), "line-sample")
    total = counts.agg(F.sum("n")).first()[0] or 1
    parts = F.ceil(F.col("n") * (2 * ranges) / F.lit(total)).cast("int")
    return counts.where(F.col("n") * (2 * ranges) > total).select("h1", "h2", F.least(parts, F.lit(ranges)).alias("parts")).where("parts > 1")


def line_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, print (xxhash64 of the text), n_dropped, keep (runs of start and stop, the last stop null) of every document
    in `docs` (doc_id, text) that loses lines. Keys of at least `min_chars` code points lose all lines but those of the
    least doc_id."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = F.broadcast(_frequent(docs, min_chars, ranges))
    # The upper 31 bits of a hash times the number of ranges: equal ranges of the hash space.
    own = F.shiftright(F.shiftrightunsigned("h1", 33) * ranges, 31)
    moved = F.pmod(F.xxhash64("doc_id", "print", "pos"), F.coalesce("parts", F.lit(1)))
    lines = _hashed(docs, min_chars).join(frequent, ["h1", "h2"], "left").withColumn("split", F.col("parts").isNotNull()).withColumn("range", F.pmod(own + moved, F.lit(ranges)).cast("int"))
    streams = W.partitionBy("range", "h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), F.col("pos"))
    first = F.first("doc_id").over(streams.rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = lines.repartitionById(ranges, "range").withColumn("first", first)
    later = ~F.col("doc_id").eqNullSafe(F.col("first"))
    # Of a split key the first of each part is kept here too: another part may have an earlier one.
    marks = written(seen.where(F.col("split") | later).select("doc_id", "print", "pos", "first", *[F.when(F.col("split"), F.col(h)).alias(h) for h in ("h1", "h2")]), "line-marks")
    split = marks.where("h1 IS NOT NULL")
    owners = F.broadcast(split.groupBy("h1", "h2").agg(F.min("first").alias("owner")))
    late = split.join(owners, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    dropped = marks.where("h1 IS NULL").select("doc_id", "print", "pos").unionByName(late.select("doc_id", "print", "pos"))
    places = dropped.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    starts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) != x - 1))
    stops = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != x + 1))
    keep = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform(stops, lambda x: x + 1)).alias("start"),
        F.concat(starts, F.array(F.lit(None).cast("int"))).alias("stop"),
    )
    runs = F.filter(keep, lambda r: r["stop"].isNull() | (r["start"] < r["stop"]))
    return places.select("doc_id", "print", F.size("at").alias("n_dropped"), runs.alias("keep"))


def _kept(lines: Column, keep: Column) -> Column:
    parts = F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, F.coalesce(r["stop"], F.size(lines)) - r["start"]))
    return F.array_join(F.flatten(parts), "\n")


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`docs` with the texts that its `bitmaps` leave, and n_lines (before) and n_dropped. Spark sends the bitmaps to every
    task where they are small by its own estimate, and sorts both sides by document where not."""
    marks = bitmaps.select(F.col("doc_id").alias("_doc"), F.col("print").alias("_print"), F.col("n_dropped").alias("_dropped"), F.col("keep").alias("_keep"))
    met = docs.join(marks, docs["doc_id"].eqNullSafe(F.col("_doc")) & (_print(docs["text"]) == F.col("_print")), "left")
    lines = _lines(F.col("text"))
    text = F.when(F.col("_keep").isNull(), F.col("text")).otherwise(_kept(lines, F.col("_keep")))
    counts = {"n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce("_dropped", F.lit(0)).cast("long")}
    rest = [F.col(c) for c in docs.columns if c not in ("text", *counts)]
    return met.select(*rest, text.alias("text"), *[c.alias(name) for name, c in counts.items()])


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text of every row of `docs` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    cut = drop_lines(docs, written(line_bitmaps(docs), "line-bitmaps"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
    WITH numbered AS (
        SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), lines AS (
        SELECT doc_id, row, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM numbered
    ), keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
    ), owners AS (
        SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) > 1
    ), judged AS (
        SELECT k.*, o.key IS NOT NULL AND k.doc_id IS DISTINCT FROM o.owner AS dropped FROM keyed k LEFT JOIN owners o USING (key)
    )
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY row
"""
