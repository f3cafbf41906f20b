import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from promptloom.operators import dedup, sample


def keys(df):
    return sorted(r[0] for r in df.select("k").collect())


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(997).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))


def by_hash(n, seed=None):
    tail = "" if seed is None else f"\x1f{seed}"
    return sorted(range(n), key=lambda k: hashlib.sha256(f"{k}{tail}".encode()).hexdigest())


@pytest.mark.parametrize("n", [0, 1, 100, 996, 997, 5000])
def test_sample_size_is_exact(rows, n):
    assert keys(sample.sample_rows(rows, "k", n)) == sorted(by_hash(997)[:n])


@pytest.mark.parametrize("partitions", [1, 7])
def test_split_does_not_depend_on_partitioning(rows, partitions):
    parts = sample.train_test_split(rows.repartition(partitions), "k", 0.2)
    test, train = keys(parts.where("split = 'test'")), keys(parts.where("split = 'train'"))
    assert test == sorted(by_hash(997, 68)[: math.ceil(0.2 * 997)])
    assert sorted(test + train) == list(range(997))


@pytest.mark.parametrize("size,expected", [(0.05, 50), (1000, 997), (0, 0), (10, 10)])
def test_split_sizes(rows, size, expected):
    assert sample.train_test_split(rows, "k", size).where("split = 'test'").count() == expected


def test_fraction_is_checked(rows):
    with pytest.raises(ValueError):
        sample.train_test_split(rows, "k", 1.5)


def test_fraction_rounds_up_without_binary_error(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    assert sample.train_test_split(rows, "k", 0.05).where("split = 'test'").count() == 5
    assert sample.train_test_split(rows, "k", 0.07).where("split = 'test'").count() == 7


def test_small_fine_limit_walks_down_the_prefixes(rows, monkeypatch):
    monkeypatch.setattr(sample, "_FINE", 0)
    assert keys(sample.sample_rows(rows, "k", 100)) == sorted(by_hash(997)[:100])


@pytest.mark.parametrize("n", [5, 150, 299, 320])
def test_shared_keys(spark, n):
    """One key holds most rows; its rows differ in content."""
    rows = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.range(2, 32).select(F.col("id").cast("int").alias("k"), F.lit(0).cast("long").alias("v")))
    parts = sample.train_test_split(rows, "k", n, seed=3)
    assert parts.where("split = 'test'").count() == n
    assert parts.distinct().count() == parts.count() == 330


@pytest.mark.parametrize("n", [5, 150, 299])
def test_identical_rows(spark, n, monkeypatch):
    """Copies of one row make up the table and are multiplied in small blocks."""
    copies = sample._copies
    monkeypatch.setattr(sample, "_copies", lambda df, k: copies(df, k, block=16))
    rows = spark.range(300).select(F.lit("a").alias("k"), F.lit("b").alias("col"))
    parts = sample.train_test_split(rows, "k", n)
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts == {"test": n, "train": 300 - n}
    assert parts.drop("split").distinct().collect() == [("a", "b")]


def test_positions_are_dense_and_in_hash_order(rows):
    got = {r["position"]: r["k"] for r in sample.with_position(rows, "k", seed=5).collect()}
    assert [got[i] for i in range(997)] == by_hash(997, 5)


def test_shuffle_is_repeatable(rows):
    once = [r["k"] for r in sample.shuffled(rows, "k").collect()]
    again = [r["k"] for r in sample.shuffled(rows.repartition(3), "k").collect()]
    assert once == again == by_hash(997, 42)


@pytest.mark.parametrize("n", [0, 1, 500, 2000])
def test_first_rows(rows, n):
    assert keys(sample.first_rows(rows.repartition(6), "k", n)) == list(range(min(n, 997)))


def test_spread_never_asks_for_zero_partitions(rows):
    assert sample.spread(rows, 0).rdd.getNumPartitions() == 1
    assert sample.spread(rows, 5).rdd.getNumPartitions() == 5


def test_lengths_group_even_when_one_length_dominates(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.lit(9).alias("n"))
    sizes = sample.grouped_by_length(rows, "n", 4, "k").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2500


def test_dedup(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("a", "b"), (None, None)], "prompt string, response string")
    once = dedup.drop_duplicate_rows(rows)
    assert once.count() == dedup.drop_duplicate_rows(once).count() == 3
    merged = dedup.instruction_dataset(rows, rows, end_mark="!")
    assert {tuple(r) for r in merged.collect()} == {("a", None), ("a", "b!"), (None, None)}
    assert dedup.unique_values(rows, "prompt").count() == 2
    by_position = dedup.stack_splits(rows, rows.selectExpr("response as x", "prompt as y"))
    assert by_position.columns == ["prompt", "response"] and by_position.count() == 8


def test_dedup_is_exact(spark):
    """A third of the rows are copies of one row; nulls and single rows."""
    i = F.col("id")
    rows = spark.range(3000).select(
        F.when(i % 3 == 0, "hot").when(i % 7 == 0, F.lit(None)).otherwise((i % 500).cast("string")).alias("a"),
        F.when(i % 3 == 0, F.lit(None)).otherwise((i % 2).cast("string")).alias("b"),
    )
    got = dedup.drop_duplicate_rows(rows)
    want = {tuple(r) for r in rows.collect()}
    assert got.count() == len(want) and {tuple(r) for r in got.collect()} == want


def test_dedup_of_answers_that_change(spark):
    """Every row that comes out is distinct although the frame answers differently each time it is computed."""
    rows = spark.range(200).select(F.floor(F.rand() * 51).alias("a"))
    got = [r[0] for r in dedup.drop_duplicate_rows(rows).collect()]
    assert len(got) == len(set(got)) and len(got) <= 51


@pytest.mark.parametrize("values", [[None, ""], ["a\x1f", "a"], [None, None, "", "x"]])
def test_split_of_rows_that_differ_in_nulls_only(spark, values):
    """Null and empty keys tie; the rows behind them stay apart, and none is lost or doubled."""
    rows = spark.createDataFrame([(v,) for v in values], "a string")
    for n in range(1, len(values)):
        parts = sample.train_test_split(rows, ["a"], n)
        assert sorted((r["a"] for r in parts.collect()), key=repr) == sorted(values, key=repr)
        assert parts.where("split = 'test'").count() == n


def test_split_of_rows_with_separators_inside(spark):
    rows = spark.createDataFrame([("a\x1fb", "c"), ("a", "b\x1fc")], "x string, y string")
    parts = sample.train_test_split(rows, ["x", "y"], 1)
    assert {(r["x"], r["y"]) for r in parts.collect()} == {("a\x1fb", "c"), ("a", "b\x1fc")}


@pytest.mark.parametrize("n", [1, 15, 25, 40, 45, 60])
def test_first_rows_with_ties(spark, n):
    """Twenty rows share each key, and five have none: exactly n rows, lowest keys first, nulls last."""
    rows = spark.range(40).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    rows = rows.union(spark.range(5).select(F.lit(None).cast("long"), F.col("id"))).repartition(4)
    got = sample.first_rows(rows, "k", n).collect()
    assert len({tuple(r) for r in got}) == len(got) == min(n, 45)
    lowest = [0] * 20 + [1] * 20 + [None] * 5
    assert sorted((r["k"] for r in got), key=lambda k: (k is None, k)) == lowest[:n]


def test_nth_key_without_one_large_sort(spark, monkeypatch):
    """Ranges are dealt out again until one is small; keys that very many rows share are found on the way."""
    rng = random.Random(4)
    values = [rng.choice([5, 5, 5, rng.randrange(40), rng.randrange(1000)]) for _ in range(3000)]
    keys = spark.createDataFrame([(v,) for v in values], "k long").repartition(4).cache()
    for n in (1, 700, 1500, 2200, 2999, 3000):
        assert sample._nth_key(keys, n, 3000, 50) == sorted(values)[n - 1]
    monkeypatch.setattr(sample, "KEYS_AT_ONCE", 20)
    first = sample.first_rows(keys.select("k", F.monotonically_increasing_id().alias("i")), "k", 800)
    assert sorted(r["k"] for r in first.collect()) == sorted(values)[:800]
