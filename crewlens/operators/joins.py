"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.params import JoinTuning

_BUCKET, _SPLITS, _SALT, _JOIN, _WEIGHT = "__bucket", "__splits", "__salt", "__join", "__weight"
# A row that stands for more equal rows than this is several rows, which bounds the array it is repeated by.
_COPIES = 1 << 20


def plan_bytes(df: DataFrame) -> int | None:
    """An estimate of the size of a DataFrame: Spark's own for what it reads (for files: their size, cut to the columns
    read), and for a join the size of its left side, widened by the columns that come in. Spark multiplies the sizes of both
    sides without statistics, which makes every joined lookup look large; joins here look rows up, so there are as
    many as on the left. None when the session does not expose the plan; callers then assume the data is large."""
    try:
        return int(_estimate(df._jdf.queryExecution().optimizedPlan()))
    except AttributeError:
        return None


def row_bytes(df: DataFrame) -> int:
    """Spark's default size of a row, for rows of which nothing else is known: texts count as twenty bytes each."""
    kinds = [f.dataType for f in df.schema]
    return 8 + sum(20 if isinstance(k, T.StringType) else 16 if isinstance(k, T.DecimalType) else 8 for k in kinds)


_SAME_ROWS, _LEFT_ROWS = ("Project", "Filter", "Aggregate", "Window", "Sort", "SubqueryAlias"), ("LeftOuter", "Inner", "LeftSemi", "LeftAnti")


def _estimate(plan) -> float:
    children = plan.children()
    name = plan.nodeName()
    if name == "Join" and plan.joinType().toString() in _LEFT_ROWS or name in _SAME_ROWS:
        first = children.apply(0)
        return _estimate(first) * _width(plan) / _width(first)
    if name == "Union":
        return sum(_estimate(children.apply(i)) for i in range(children.size()))
    return float(plan.stats().sizeInBytes())


def _width(plan) -> int:
    """Spark's default sizes of the columns, and eight bytes per row."""
    output = plan.output()
    return 8 + sum(output.apply(i).dataType().defaultSize() for i in range(output.size()))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class HotKeys:
    """Which key buckets of a fact hold far more rows than the mean, for all its joins.

    The rows are counted once for every list of keys in ``joins``: a row counts once per list, in the
    bucket of its keys, and counts are summed before the shuffle, so a task sends at most
    ``buckets`` rows per list. Counts are exact, so every use agrees on them, also after a lost executor.
    A bucket is hot above four times the mean; its parts are then about one mean each, never more
    than its rows, and all parts of a list add up to at most ``buckets`` and one more per hot bucket.
    ``weight`` names a column that says how many rows a row stands for.
    """

    def __init__(
        self, rows: DataFrame, joins: Sequence[Sequence[str]], tuning: JoinTuning = JoinTuning(), weight: str | None = None
    ):
        self.joins = [tuple(keys) for keys in joins]
        self._rows, self._tuning, self._weight = rows, tuning, weight

    @cached_property
    def _hot(self) -> DataFrame:
        # Planned when the first join asks: joins that broadcast need no counts.
        n = self._tuning.buckets
        each = [F.struct(F.lit(i).alias(_JOIN), _bucket(keys, n).alias(_BUCKET)) for i, keys in enumerate(self.joins)]
        counted = (F.col(self._weight) if self._weight else F.lit(1).cast("bigint")).alias("weight")
        keyed = self._rows.select(counted, F.inline(F.array(*each)))
        counts = keyed.groupBy(_JOIN, _BUCKET).agg(F.sum("weight").alias("rows"))
        # One row per list with at most ``buckets`` pairs in it.
        every = counts.groupBy(_JOIN).agg(
            F.sum("rows").alias("total"),
            F.collect_list(F.struct(F.col(_BUCKET), F.col("rows"))).alias("pairs"),
        )
        hot = F.filter("pairs", lambda p: (p["rows"] * n > F.col("total") * 4) & (p["rows"] > 1))
        parts = F.least(F.col("rows"), F.ceil(F.col("rows") * n / F.col("total"))).cast("int")
        return every.select(_JOIN, "total", F.inline(hot)).select(_JOIN, _BUCKET, parts.alias(_SPLITS))

    def of(self, keys: Sequence[str]) -> DataFrame:
        """The hot buckets of one list of keys and into how many parts to split each."""
        return self._hot.where(F.col(_JOIN) == self.joins.index(tuple(keys))).select(_BUCKET, _SPLITS)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    tuning: JoinTuning = JoinTuning(),
    hot: HotKeys | None = None,
    distinct_rows: bool = False,
    together: bool = False,
) -> DataFrame:
    """Join a fact to a lookup on equally named columns (``how``: left, inner or left_semi).

    - A lookup whose estimated size is within ``tuning.broadcast_bytes`` is broadcast.
    - Otherwise hot keys are split: fact rows of a hot bucket get a part number, lookup rows of that
      bucket are copied once per part, and the join is on key and part. Each fact row meets each of
      its lookup rows exactly once, so the rows are those of the plain join. NULL keys are a bucket like
      others. All copies together add at most about one more lookup.

    Equal fact rows are first counted, in their tasks and then over all of them: one row with a weight.
    A hot row's weight is shared out over the parts of its bucket, and every joined row is repeated as often as
    its share says, so not even one row that makes up half the fact ends in one task. ``distinct_rows`` says
    that no two rows are equal (they hold an id), which spares that count and its shuffle. ``together`` says that the fact
    lies in buckets by these keys, none of them hot: it is joined where it lies.

    ``hot`` has the counts of rows with the keys of the fact, made once for several joins; without it
    the fact itself is counted. It steers the split only, never the rows.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"lookup_join keeps the fact on the left: how={how!r}")
    on = list(on)
    if together:
        return fact.join(lookup, on, how)
    size = plan_bytes(lookup)
    if size is not None and size <= tuning.broadcast_bytes:
        return fact.join(F.broadcast(lookup), on, how)
    if distinct_rows or not _countable(fact):
        return _split_join(fact, lookup, on, how, hot or HotKeys(fact, [on], tuning), tuning)
    weighed = fact.groupBy(*[_quoted(c) for c in fact.columns]).agg(F.count(F.lit(1)).alias(_WEIGHT))
    joined = _split_join(weighed, lookup, on, how, hot or HotKeys(weighed, [on], tuning, _WEIGHT), tuning)
    copies = joined.withColumn(_SALT, F.explode(F.array_repeat(F.lit(True), F.col(_WEIGHT).cast("int"))))
    return copies.drop(_SALT, _WEIGHT)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _countable(fact: DataFrame) -> bool:
    """Whether equal rows can stand for each other: no column that cannot be grouped, or whose equal values may
    look different (text under a collation)."""

    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind)
        if isinstance(kind, T.StringType):
            return kind.collation == "UTF8_BINARY"
        return not isinstance(kind, (T.MapType, T.VariantType))

    return plain(fact.schema)


def _row_hash(fact: DataFrame) -> Column:
    # From the row alone, or from the row and its task where equal rows may be left: a task that runs again
    # gives the same parts in whatever order its rows arrive.
    plain = [F.col(_quoted(f.name)) for f in fact.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain) if _WEIGHT in fact.columns else F.xxhash64(*plain, F.spark_partition_id())


def _dealt(fact: DataFrame) -> DataFrame:
    """The fact with a part number per row; a row with a weight becomes one row per part that gets a share."""
    first = F.pmod(_row_hash(fact), F.col(_SPLITS)).cast("int")
    if _WEIGHT not in fact.columns:
        return fact.withColumn(_SALT, F.coalesce(first, F.lit(0)))
    weight = F.col(_WEIGHT)
    parts = F.greatest(F.least(F.coalesce(_SPLITS, F.lit(1)), weight), F.ceil(weight / _COPIES))
    # Shares differ by one at most.
    share = ((weight - weight % parts) / parts).cast("bigint") + F.when(F.col("__nth") < weight % parts, 1).otherwise(0)
    each = fact.withColumn("__nth", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    part = F.coalesce(F.pmod(first + F.col("__nth"), F.col(_SPLITS)), F.lit(0))
    return each.withColumns({_SALT: part, "__share": share}).drop(_WEIGHT, "__nth").withColumnRenamed("__share", _WEIGHT)


def _split_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str,
    hot: HotKeys,
    tuning: JoinTuning,
) -> DataFrame:
    # Equal values must hash alike on both sides, so the lookup takes the fact's types.
    lookup = lookup.withColumns({k: F.col(k).cast(fact.schema[k].dataType) for k in on})
    # At most buckets / 4 rows by construction.
    splits = F.broadcast(hot.of(on))
    bucket = _bucket(on, tuning.buckets)

    left = _dealt(fact.withColumn(_BUCKET, bucket).join(splits, _BUCKET, "left").drop(_BUCKET)).drop(_SPLITS)
    parts = F.sequence(F.lit(0), F.coalesce(F.col(_SPLITS), F.lit(1)) - 1)
    right = (
        lookup.withColumn(_BUCKET, bucket)
        .join(splits, _BUCKET, "left")
        .withColumn(_SALT, F.explode(parts))
        .drop(_BUCKET, _SPLITS)
    )
    return left.join(right, [*on, _SALT], how).drop(_SALT)


def merge_on_key(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with the keys of both sides merged. NULL keys never meet, so each side keeps
    its own NULL-key row. Both sides must be grouped by ``on``: then no key can be hot."""
    return left.join(right, list(on), "full")
