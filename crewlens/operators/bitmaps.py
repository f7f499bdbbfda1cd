"""Sets of ids as bitmaps of a bounded size, to cut facts where they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.params import JoinTuning

_RANGE, _WORDS, _WORD = "__range", "__words", "__word"
# A range is 2**15 ids: 512 words of 64 bits.
_RANGE_BITS, _WORDS_EACH = 15, 512
BITMAP_BYTES = 8 * _WORDS_EACH


def _place(column: str, keys: Sequence[str], ranges: int) -> Column:
    """The range of an id, folded into ``ranges`` places; tenants start at places of their own."""
    first = F.shiftright(F.col(column).cast("bigint"), _RANGE_BITS)
    return F.pmod(first + F.pmod(F.xxhash64(*keys), F.lit(1 << 40)), F.lit(ranges)).cast("int")


def _word(column: str) -> Column:
    return F.pmod(F.shiftright(F.col(column).cast("bigint"), 6), F.lit(_WORDS_EACH)).cast("int")


def id_bitmaps(ids: DataFrame, column: str, keys: Sequence[str] = ("company_id",), ranges: int = 8192) -> DataFrame:
    """One row per place that any id falls into, at most ``ranges``: 512 words with a bit per id. Repeated ids count
    once and NULL is in no set. Bits are gathered before the shuffle."""
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64) as int))")
    spread = ids.where(F.col(column).isNotNull()).select(
        _place(column, keys, ranges).alias(_RANGE), _word(column).alias(_WORD), bit.alias("__bit")
    )
    words = spread.groupBy(_RANGE, _WORD).agg(F.bit_or("__bit").alias("__bits"))
    held = words.groupBy(_RANGE).agg(F.sort_array(F.collect_list(F.struct(_WORD, "__bits"))).alias("__held"))
    held = held.withColumn("__map", F.when(F.size("__held") < _WORDS_EACH, F.map_from_entries("__held")))
    sparse = F.transform(
        F.sequence(F.lit(0), F.lit(_WORDS_EACH - 1)), lambda w: F.coalesce(F.element_at("__map", w), F.lit(0).cast("bigint"))
    )
    # A map is searched from its start for each word: where no word is missing, they only need their order.
    every = F.when(F.size("__held") == _WORDS_EACH, F.transform("__held", lambda e: e["__bits"])).otherwise(sparse)
    return held.select(_RANGE, every.alias(_WORDS))


class IdSet:
    """The distinct values of ``column`` in ``ids`` per tenant, as bitmaps that are sent to every task.

    All bitmaps together take at most ``tuning.bitmap_bytes``, whatever the data: ranges of ids beyond that share places. The
    set then holds ids that are in no row of ``ids``, so use it only in front of a join that drops what does not
    belong; it spares that join's work, and holds every id that is there. With 32 MB, 268 million ids have a bit each.
    """

    def __init__(self, ids: DataFrame, column: str, tuning: JoinTuning = JoinTuning(), keys: Sequence[str] = ("company_id",)):
        self.column, self.keys = column, tuple(keys)
        self.ranges = max(0, tuning.bitmap_bytes // BITMAP_BYTES)
        self._bitmaps = id_bitmaps(ids, column, self.keys, self.ranges) if self.ranges else None

    def cut(self, fact: DataFrame, column: str | None = None) -> DataFrame:
        """The rows of ``fact`` whose ``column`` is in the set, tested where they are read. Without bitmaps all rows."""
        if self._bitmaps is None:
            return fact
        id_ = column or self.column
        found = fact.withColumn(_RANGE, _place(id_, self.keys, self.ranges)).join(F.broadcast(self._bitmaps), _RANGE)
        bit = F.bit_get(F.get(_WORDS, _word(id_)), F.pmod(F.col(id_).cast("bigint"), F.lit(64)).cast("int"))
        return found.where(bit == 1).select(*[F.col(f"`{c}`") for c in fact.columns])
