import random

import pytest
from conftest import got
from pyspark.sql import functions as F

from crewlens import operators as op
from crewlens.operators.groups import _sorted_runs
from crewlens.params import JoinTuning

# Every bucket with a row in it counts as hot, so that the split path takes part on tiny data.
SPLIT = JoinTuning(broadcast_bytes=-1, buckets=64)
PICK = [("split", "desc"), ("created", "asc")]


@pytest.mark.parametrize(
    ("data", "first"),
    [
        ([("a", 5, 3), ("b", 5, 2), ("c", 4, 1), ("d", None, 0)], "b"),
        ([("a", 5, 3), ("z", 5, None), ("c", 4, 1)], "z"),
        ([("n", None, 1)], "n"),
    ],
)
def test_first_per_group_with_descending_number(rows, data, first):
    df = rows("g int, name string, split int, created int", [(1, *r) for r in data])
    assert got(op.first_per_group(df, ["g"], PICK, ["name"])) == [(1, first)]


def test_first_per_group_takes_null_order_keys_first(rows):
    df = rows("g int, name string, k int", [(1, "n", None), (1, "a", 1), (None, "x", 2)])
    assert got(op.first_per_group(df, ["g"], [("k", "asc")], ["name"])) == [(None, "x"), (1, "n")]


def test_first_per_group_with_descending_text(rows):
    df = rows("g int, name string, v int", [(1, "a", 1), (1, "b", 2), (1, None, 3)])
    assert got(op.first_per_group(df, ["g"], [("name", "desc")], ["v"])) == [(1, 2)]


def test_top_n_keeps_ties_and_small_groups(rows):
    df = rows("g int, v int", [(1, 3), (1, 1), (1, 1), (2, 9)])
    top = op.top_n_per_group(df, ["g"], [("v", "asc")], 2, rank="rn")
    assert got(top) == [(1, 1, 1), (1, 1, 2), (2, 9, 1)]
    assert op.top_n_per_group(df, ["g"], [("v", "asc")], 2).columns == ["g", "v"]


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = op.top_n_per_group(df, ["g"], [("v", "asc")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_lists(rows):
    df = rows("g int, v string, n bigint", [(1, " Bo ", 10), (1, "Al", 9), (1, "Bo", 100), (2, None, None)])
    names = op.distinct_list(df, ["g"], F.trim("v"), "names")
    assert got(names) == [(1, "Al, Bo"), (2, "")]
    for chunk in (1, 7, 1000):
        assert got(op.ordered_text(df, ["g"], "n", "ids", chunk=chunk)) == [(1, "9, 10, 100")]


def test_ordered_text_with_large_and_negative_ids(rows):
    ids = [2**62 + 1, 2**62, -5, -1_000_001, 0]
    df = rows("g int, n bigint", [(1, n) for n in ids])
    assert got(op.ordered_text(df, ["g"], "n", "ids", chunk=1_000_000)) == [(1, ", ".join(map(str, sorted(ids))))]


def test_list_of_a_hot_group_is_sorted_by_many_tasks(spark):
    """Half of all rows on one parent, all of them different: no task that collects holds a quarter."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997 + 2).alias("g"),
        F.concat(F.lit("Tech é"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("v"),
    )
    listed = op.distinct_list(df, ["g"], F.col("v"), "l", tuning=SPLIT)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        runs = _sorted_runs(df, ["g"], F.col("v"), SPLIT)
        held = runs.groupBy(F.spark_partition_id()).agg(F.sum(F.size("__run"))).collect()
        assert sum(r[1] for r in held) == 40_000 and max(r[1] for r in held) <= 0.25 * 40_000
        assert got(listed) == got(df.groupBy("g").agg(F.array_join(F.sort_array(F.collect_set("v")), ", ").alias("l")))
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting)


@pytest.mark.parametrize("buckets", [1, 64])
def test_distinct_lists_of_awkward_values(spark, buckets):
    values = ["", "a", "ab", "abc", "abcd", "abd", "é", "éa", "日本", "日", "\U0001f600", "b", None, "a", "ab ", "Z", "aB"]
    df = spark.createDataFrame([(g, v) for g in (1, 2, None) for v in values[: 17 if g else 5]] + [(3, None), (4, "")], "g bigint, v string")
    df = df.unionByName(spark.range(500).select(F.lit(1).alias("g"), F.lit("abcx").alias("v")))
    want = df.groupBy("g").agg(F.array_join(F.sort_array(F.collect_set("v")), ", ").alias("l"))
    assert got(op.distinct_list(df, ["g"], F.col("v"), "l", tuning=JoinTuning(buckets=buckets))) == got(want)


def test_explode_keep(rows):
    df = rows("g int, a array<int>", [(1, [1, None]), (2, []), (3, None)])
    assert got(op.explode_keep(df, "a", "x")) == [(1, None), (1, 1), (2, None), (3, None)]


def test_merge_on_key_keeps_null_keys_apart(rows):
    left = rows("k int, a int", [(1, 10), (2, 20), (None, 30)])
    right = rows("k int, b int", [(2, 200), (3, 300), (None, 400)])
    merged = got(op.merge_on_key(left, right, ["k"]))
    assert merged == [(None, None, 400), (None, 30, None), (1, 10, None), (2, 20, 200), (3, None, 300)]


def test_child_rollup(rows):
    parent = rows("id int, job int", [(1, 7), (2, 7), (3, 8), (4, None)])
    child = rows("id int, v int", [(1, 1), (1, 2), (2, 4), (4, 8), (None, 16)])
    kept = op.child_rollup(parent, child, ["id"], ["job"], "v", "v")
    assert got(kept) == [(None, 8), (7, 7), (8, None)]
    inner = op.child_rollup(parent, child, ["id"], ["job"], "v", "v", how="inner")
    assert got(inner) == [(None, 8), (7, 7)]


def test_union_tenants_keeps_equal_ids_apart(rows):
    one, two = rows("id int, x int", [(1, 5)]), rows("id int", [(1,)])
    both = op.union_tenants({2: two, 1: one})
    assert got(both, "company_id", "id", "x") == [(1, 1, 5), (2, 1, None)]


def _fact(spark):
    # A third of the rows on key 7, a third on NULL, and copies of rows.
    return spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).cast("bigint").alias("k"),
        (F.col("id") % 5).alias("v"),
    )


def _hot(df, keys=("k",)):
    return op.HotKeys(df, [keys], SPLIT).of(keys)


def _sizes(spark, df):
    """Rows per task of a join whose sides are shuffled, with no help from adaptive execution."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("key_type", ["bigint", "int"])
def test_split_join_equals_plain_join(spark, how, key_type):
    fact = _fact(spark)
    # Key 8 stands twice in the lookup, key 9 not at all, and NULL matches nobody.
    keys = [k for k in range(50) if k != 9] + [8, None]
    lookup = spark.createDataFrame([(k, f"name{i}") for i, k in enumerate(keys)], f"k {key_type}, name string")
    plain, split = fact.join(lookup, ["k"], how), op.lookup_join(fact, lookup, ["k"], how, tuning=SPLIT)
    assert split.columns == plain.columns
    assert got(split) == got(plain)
    assert _hot(fact).count() > 0
    numbered = fact.withColumn("n", F.monotonically_increasing_id())
    once = op.lookup_join(numbered, lookup, ["k"], how, tuning=SPLIT, distinct_rows=True)
    assert got(once.drop("n")) == got(plain)


@pytest.mark.parametrize("hot_key", [7, None])
def test_a_hot_key_in_one_input_task_is_split(spark, hot_key):
    """Half the rows on one key (a value, or NULL), all of them in one input partition."""
    rows = [(hot_key, i) for i in range(2000)] + [(100 + i % 500, i) for i in range(2000)]
    fact = spark.createDataFrame(rows, "k bigint, v bigint").coalesce(1)
    lookup = spark.range(0, 600).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    split = op.lookup_join(fact, lookup, ["k"], "left", tuning=SPLIT)
    sizes = _sizes(spark, split)
    assert sum(sizes) == 4000 and max(sizes) <= 0.25 * sum(sizes)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_equal_rows_of_one_input_task_are_split(spark, how):
    """200,000 rows in one input partition, half of them equal rows of one key."""
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(100 + F.col("id") % 500).cast("bigint")
    fact = spark.range(0, 200_000, 1, 1).select(key.alias("k"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("v"))
    lookup = spark.range(0, 600).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    split = op.lookup_join(fact, lookup, ["k"], how, tuning=SPLIT)
    sizes = _sizes(spark, split)
    assert sum(sizes) == 200_000 and max(sizes) <= 0.25 * sum(sizes)
    assert split.where("k = 7 AND v IS NULL").count() == 100_000


def test_weights_of_equal_rows(spark, monkeypatch):
    """Rows equal in NULLs, arrays and structs too, and more copies than one array holds."""
    monkeypatch.setattr("crewlens.operators.joins._COPIES", 3)
    rows = [(1, None, [1, None], (2, "a"))] * 40 + [(None, "n", None, None)] * 25 + [(1, "x", [], (None, None)), (9, "y", [1], (1, "b"))] * 2
    fact = spark.createDataFrame(rows, "k bigint, `odd name` string, list array<int>, pair struct<a int, b string>").repartition(3)
    lookup = spark.createDataFrame([(1, "one"), (1, "uno"), (2, "two")], "k int, name string")
    for how in ("left", "inner", "left_semi"):
        assert got(op.lookup_join(fact, lookup, ["k"], how, tuning=SPLIT)) == got(fact.join(lookup, ["k"], how))


def test_rows_that_cannot_be_counted_are_joined_as_they_are(spark):
    fact = spark.createDataFrame([(1, {"a": 1})] * 3 + [(2, {"b": 2})], "k bigint, m map<string,int>")
    lookup = spark.createDataFrame([(1, "x")], "k bigint, name string")
    joined = op.lookup_join(fact, lookup, ["k"], tuning=SPLIT)
    assert sorted(str(r) for r in joined.collect()) == sorted(str(r) for r in fact.join(lookup, ["k"], "left").collect())
    same = fact.select("k", F.collate(F.lit("a"), "UTF8_LCASE").alias("c"))
    assert op.lookup_join(same, lookup, ["k"], tuning=SPLIT).count() == 4


@pytest.mark.parametrize("ranges", [1, 4, 8192])
def test_id_sets_hold_every_id_and_nothing_else_while_ranges_have_places(spark, ranges):
    ids = [0, 1, 63, 64, 32767, 32768, 10**12, -1, -64, -32769, 2**62, -(2**63), 2**63 - 1]
    held = spark.createDataFrame([(c, i) for c in (1, 2) for i in ids[c - 1 :]] + [(1, None), (1, 0)], "company_id bigint, id bigint")
    rng = random.Random(2)
    others = [rng.randrange(-(10**13), 10**13) for _ in range(500)] + [i + d for i in ids for d in (-1, 1) if -(2**63) <= i + d < 2**63]
    fact = spark.createDataFrame([(c, i, n) for n, i in enumerate(ids + others) for c in (1, 2)] + [(1, None, 0)], "company_id bigint, key bigint, n int")
    tuning = JoinTuning(bitmap_bytes=4096 * ranges)
    found = op.IdSet(held, "id", tuning).cut(fact, "key")
    keys = held.select("company_id", F.col("id").alias("key")).where("key IS NOT NULL").distinct()
    exact = fact.join(keys, ["company_id", "key"], "left_semi")
    assert found.columns == fact.columns
    assert got(found.join(keys, ["company_id", "key"], "left_semi")) == got(exact)
    if ranges == 8192:  # ids of one tenant that span no more than the bits there are
        near = (F.col("company_id") == 1) & F.col("key").between(-(2**26), 2**26)
        alone = op.IdSet(held.where((F.col("company_id") == 1) & F.col("id").between(-(2**26), 2**26)), "id", tuning).cut(fact.where(near), "key")
        assert got(alone) == got(exact.where(near)) != []
    assert op.id_bitmaps(held, "id", ranges=ranges).count() <= ranges


def test_id_sets_that_are_off_cut_nothing(spark):
    fact = spark.range(5).select(F.lit(1).cast("bigint").alias("company_id"), "id")
    assert op.IdSet(fact.limit(0), "id", JoinTuning(bitmap_bytes=0)).cut(fact).count() == 5
    assert op.IdSet(fact.limit(0), "id").cut(fact).count() == 0


def test_hot_keys_are_bounded_and_counted_once_for_several_joins(spark):
    fact = _fact(spark)
    both = op.HotKeys(fact, [("k",), ("v", "k")], SPLIT)
    hot = both.of(["k"]).collect()
    assert 1 <= len(hot) <= 16
    assert sum(r["__splits"] for r in hot) <= 64 + len(hot)
    assert sorted(map(tuple, hot)) == sorted(map(tuple, _hot(fact).collect()))
    assert both.of(["v", "k"]).count() == _hot(fact, ("v", "k")).count()
    even = spark.range(64_000).withColumnRenamed("id", "k")
    assert _hot(even).count() == 0
    assert _hot(spark.createDataFrame([(1,)], "k bigint")).where("__splits > 1").count() == 0


def test_lookup_join_broadcasts_only_small_lookups(spark):
    fact, lookup = _fact(spark), spark.range(50).select(F.col("id").alias("k"), F.lit("n").alias("name"))

    def plan(**limits):
        joined = op.lookup_join(fact, lookup, ["k"], tuning=JoinTuning(**limits))
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan() and "__salt" not in plan()
    assert "__salt" in plan(broadcast_bytes=-1)


@pytest.mark.parametrize("ddl, values", [
    ("double", [1.0, float("nan"), None, -2.0, float("inf"), float("nan")]),
    ("bigint", [1, -(2**63), None, 2**63 - 1, 0, -(2**63)]),
    ("string", ["b", None, "", "a", "c", "a"]),
])
@pytest.mark.parametrize("way", ["asc", "desc"])
def test_first_per_group_equals_top_one(spark, ddl, values, way):
    rows = [(g, v, i) for g in range(6) for i, v in enumerate(values[g:] + [None] * (g == 5))]
    df = spark.createDataFrame(rows, f"g bigint, v {ddl}, i bigint")
    order = [("v", way), ("i", "asc")]
    first = op.first_per_group(df, ["g"], order, ["i"])
    top = op.top_n_per_group(df, ["g"], order, 1).select("g", "i")
    assert got(first) == got(top)


def test_lookup_join_rejects_other_joins(spark):
    with pytest.raises(ValueError):
        op.lookup_join(spark.range(1), spark.range(1), ["id"], "full")


def test_a_joined_lookup_is_as_large_as_its_left_side(spark, tmp_path):
    """Spark's own estimate of a join without statistics is the product of both sides."""
    for name in ("a", "b"):
        spark.range(200_000).select("id", F.concat(F.lit(name), F.col("id").cast("string")).alias(name)).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b"))
    one, joined = op.plan_bytes(a), op.plan_bytes(a.join(b, "id", "left"))
    assert one < joined < 3 * one
    assert joined < op.plan_bytes(a.unionByName(b.withColumnRenamed("b", "a")).join(b, "id")) < 3 * joined
    assert op.plan_bytes(a.join(b, "id", "full")) > 100 * joined  # not a lookup: as Spark has it


def test_bitmaps_of_dense_and_of_sparse_ranges(spark):
    ids = [*range(1 << 15), (1 << 15) + 70, (1 << 16) - 1]  # the first range lacks no word, the second has two
    one = spark.createDataFrame([(1, i) for i in ids], "company_id BIGINT, id BIGINT")
    bits = op.id_bitmaps(one, "id", ranges=64)
    words = {sum(w.bit_count() if w >= 0 else 64 - (~w).bit_count() for w in r["__words"]): r["__words"] for r in bits.collect()}
    assert set(words) == {1 << 15, 2} and {len(w) for w in words.values()} == {512}
    assert [(i, w) for i, w in enumerate(words[2]) if w] == [(1, 1 << 6), (511, -(1 << 63))]
    # Words that are all there are put in order, not looked up one by one.
    assert "size(__held" in bits._jdf.queryExecution().optimizedPlan().toString()
    assert got(op.IdSet(one, "id", JoinTuning()).cut(one)) == got(one)
