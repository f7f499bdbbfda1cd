"""Group operators: picks, lists and rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.params import JoinTuning


def rollup(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], where: Column | None = None
) -> DataFrame:
    """One row per key with the named aggregates. Rows are pre-aggregated before the shuffle."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])


def child_rollup(
    parent: DataFrame,
    child: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    value: str,
    alias: str,
    how: str = "left",
) -> DataFrame:
    """Sum of a child column per parent key (``invoice items`` per ``job`` through ``invoice``).

    Children are summed per parent row first. A parent row with a huge number of children is
    collapsed before anything is shuffled, and the join is between two sides unique on ``on``.
    """
    per_parent = rollup(child, on, {alias: F.sum(value)})
    return rollup(parent.join(per_parent, list(on), how), keys, {alias: F.sum(alias)})


def _descending(df: DataFrame, name: str) -> list[Column]:
    # A number goes down when its negative goes up; NULLs of a descending key come last.
    value, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # NaN is the greatest number, and its negative is NaN too.
        return [value.isNull(), ~F.isnan(value), -value]
    if isinstance(kind, T.IntegralType):
        # The least integer has no negative of its own type.
        return [value.isNull(), -value.cast("decimal(20,0)")]
    return [value.isNull(), -value]


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    values: Sequence[str],
) -> DataFrame:
    """The values of the first row per group. ``order`` holds (column, 'asc' or 'desc') pairs; NULLs
    come first ascending and last descending.

    With ascending keys and descending numbers it is one aggregate over a struct key, collapsed
    before the shuffle. Other descending types use a window cut to one row per group and task.
    """
    numeric = all(
        way == "asc" or isinstance(df.schema[name].dataType, T.NumericType) for name, way in order
    )
    if not numeric:
        return top_n_per_group(df, keys, order, 1).select(*keys, *values)
    sort_key = [
        part
        for name, way in order
        for part in ([F.col(name)] if way == "asc" else _descending(df, name))
    ]
    # A struct is never NULL, so rows whose order keys are NULL take part.
    pick = F.min_by(F.struct(*values), F.struct(*sort_key)).alias("__pick")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"__pick.{v}").alias(v) for v in values])


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    n: int,
    rank: str | None = None,
) -> DataFrame:
    """The first n rows per group. Spark cuts each task's rows to n per group before the shuffle, so
    a hot group never travels whole. ``rank`` names the row number if it is wanted."""
    by = [F.col(c).asc_nulls_first() if way == "asc" else F.col(c).desc_nulls_last() for c, way in order]
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*by))).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def distinct_list(
    df: DataFrame, keys: Sequence[str], value: Column, alias: str, sep: str = ", ", tuning: JoinTuning = JoinTuning()
) -> DataFrame:
    """Distinct values per group, sorted and joined. Repeats go away in a grouping on keys and value,
    before the shuffle, so what a group collects is only its distinct values.

    The values of a hot group (of a key bucket above four times the mean, repeats gone) are collected and sorted by many tasks, in
    runs of the values that begin alike: as far as the group's least and greatest value agree, and three characters more.
    Runs sort as their beginnings do, so finished runs are joined as text; NULL is in no list."""
    pieces = _sorted_runs(df, keys, value.cast("string"), tuning)
    joined = pieces.select(*keys, "__begins", F.when(F.size("__run") > 0, F.array_join("__run", sep)).alias("__text"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("__text").isNotNull(), F.struct("__begins", "__text"))))
    return joined.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda p: p["__text"]), sep).alias(alias))


def _sorted_runs(df: DataFrame, keys: Sequence[str], value: Column, tuning: JoinTuning) -> DataFrame:
    """Distinct values per group and beginning, sorted; one run without a beginning where a group is not hot."""
    n = tuning.buckets
    valued = df.select(*keys, value.alias("__value")).distinct().withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    # One row per bucket, then the hot ones, above four times the mean: at most a quarter of the buckets.
    sizes = valued.groupBy("__bucket").agg(F.count(F.lit(1)).alias("rows"), F.min("__value").alias("lo"), F.max("__value").alias("hi"))
    every = sizes.agg(F.sum("rows").alias("total"), F.collect_list(F.struct("__bucket", "rows", "lo", "hi")).alias("sizes"))
    hot = every.select(F.inline(F.filter("sizes", lambda s: (s["rows"] * n > F.col("total") * 4) & (s["rows"] > 1))))
    both = F.least(F.char_length("lo"), F.char_length("hi"))
    alike = F.array_max(F.filter(F.sequence(F.lit(0), both), lambda i: F.left("lo", i) == F.left("hi", i)))
    ends = hot.select("__bucket", alike.alias("__alike"))
    runs = valued.join(F.broadcast(ends), "__bucket", "left")
    begins = F.when(F.col("__alike").isNotNull(), F.left("__value", F.col("__alike") + 3))
    return runs.groupBy(*keys, begins.alias("__begins")).agg(F.sort_array(F.collect_list("__value")).alias("__run"))


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    alias: str,
    sep: str = ", ",
    chunk: int = 1_000_000,
) -> DataFrame:
    """Ids per group in numeric order, joined as text.

    A group is built in ranges of ``chunk`` ids, each its own group, so that the ids of a hot group
    are collected, sorted and turned into text by many tasks. Only finished pieces meet at the end.
    """
    pieces = (
        df.where(F.col(id_col).isNotNull())
        .groupBy(*keys, (F.col(id_col) - F.pmod(F.col(id_col), F.lit(chunk))).alias("__chunk"))
        .agg(F.array_sort(F.collect_list(id_col)).alias("__ids"))
        .select(*keys, "__chunk", F.array_join(F.col("__ids").cast("array<string>"), sep).alias("__text"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("__chunk", "__text")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda p: p["__text"]), sep).alias(alias))


def explode_keep(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    """One row per array item; a row with an empty or NULL array stays, with a NULL item."""
    rest = [c for c in df.columns if c != array_col]
    return df.select(*rest, F.explode_outer(array_col).alias(alias))
