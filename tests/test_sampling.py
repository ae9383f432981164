import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultloom.operators import sampling


def by_single_units(sizes, n, shares=None):
    """Targets by moving one unit at a time, as the rule is stated."""
    shares = shares or sizes
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    total = sum(shares)
    target = {i: max(1, min(sizes[i], round(n * shares[i] / total))) for i in order}
    while sum(target.values()) > n:
        target[max(order, key=lambda i: target[i])] -= 1
    while sum(target.values()) < n:
        target[max(order, key=lambda i: sizes[i] - target[i])] += 1
    return target


def allocated(spark, sizes, n, weights=None):
    rows = [(f"g{i:03d}", s, float((weights or sizes)[i])) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "g string, size long, w double")
    found = sampling.allocate(df, n, stratum="g", weight="w" if weights else None).collect()
    return {int(r.g[1:]): r.target for r in found}


@pytest.mark.parametrize(
    ("sizes", "n", "want"),
    [
        ([900, 2], 20, {0: 19, 1: 1}),
        ([500, 500, 50], 120, {0: 57, 1: 57, 2: 6}),
        ([1000, 1, 1, 1, 1, 1], 6, {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1}),
        ([3, 3, 3], 8, {0: 2, 1: 3, 2: 3}),
    ],
)
def test_known_allocations(spark, sizes, n, want):
    assert by_single_units(sizes, n) == want
    assert allocated(spark, sizes, n) == want


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12), st.data())
def test_allocation_equals_moving_single_units(spark, sizes, data):
    if sum(sizes) == len(sizes):
        return
    n = data.draw(st.integers(len(sizes), sum(sizes) - 1))
    assert allocated(spark, sizes, n) == by_single_units(sizes, n)


def test_weighted_allocation(spark):
    rng = random.Random(1)
    for _ in range(5):
        sizes = [rng.randint(1, 40) for _ in range(6)]
        weights = [s * rng.choice([1, 4, 9]) for s in sizes]
        n = rng.randint(6, sum(sizes) - 1)
        assert allocated(spark, sizes, n, weights) == by_single_units(sizes, n, weights)


def table(spark, groups):
    parts = [
        spark.range(size).select(
            F.concat(F.lit(f"{name}-"), F.col("id").cast("string")).alias("node_id"),
            F.lit(name).cast("string").alias("framework_slug"),
        )
        for name, size in groups
    ]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    return df


def counts(df):
    return {r.framework_slug: r["count"] for r in df.groupBy("framework_slug").count().collect()}


def test_all_rows_where_there_are_fewer(spark):
    df = table(spark, [("a", 1), ("b", 1)])
    assert sampling.stratified_sample(df, 10, stratum="framework_slug").count() == 2
    assert sampling.random_sample(df, 10).count() == 2
    assert sampling.random_sample(df, 0).count() == 0


def test_tiny_strata_are_present(spark):
    df = table(spark, [("big", 900), ("tiny", 2)])
    found = sampling.stratified_sample(df, 20, stratum="framework_slug")
    assert counts(found) == {"big": 19, "tiny": 1}


def test_shares_and_exact_size(spark):
    df = table(spark, [("a", 500), ("b", 500), ("c", 50)])
    found = sampling.stratified_sample(df, 120, stratum="framework_slug")
    assert counts(found) == {"a": 57, "b": 57, "c": 6}
    assert found.select("node_id").distinct().count() == 120


def test_null_is_a_stratum(spark):
    df = table(spark, [("a", 30), ("b", 20)]).unionByName(table(spark, [(None, 10)]))
    found = sampling.stratified_sample(df.filter("node_id IS NOT NULL"), 12, stratum="framework_slug")
    assert sum(counts(found).values()) == 12
    assert counts(found)[None] == 2


def test_fewer_than_strata_falls_back_to_plain(spark):
    df = table(spark, [("a", 5), ("b", 5), ("c", 5)])
    found = sampling.stratified_sample(df, 2, stratum="framework_slug")
    plain = sampling.random_sample(df, 2)
    assert sorted(found.collect()) == sorted(plain.collect())


def test_no_stratum(spark):
    assert sampling.stratified_sample(table(spark, [("a", 100)]), 10, stratum=None).count() == 10


def test_sample_is_repeatable_and_seeded(spark):
    df = table(spark, [("a", 300)])
    one = {r.node_id for r in sampling.random_sample(df, 40).collect()}
    two = {r.node_id for r in sampling.random_sample(df.repartition(7), 40).collect()}
    other = {r.node_id for r in sampling.random_sample(df, 40, seed=1).collect()}
    assert one == two and one != other


def test_sample_is_the_head_of_the_hash_order(spark):
    df = table(spark, [("a", 9000), ("b", 300)])
    head = df.orderBy(sampling.sample_order("node_id", 42), "node_id").limit(5000)
    assert sampling.random_sample(df, 5000).exceptAll(head).count() == 0


def test_oversampling_gives_weighted_rows_more_room(spark):
    df = table(spark, [("a", 500), ("b", 500)])
    df = df.withColumn("needs_review", F.col("node_id").endswith("7"))
    weight = F.when(F.col("needs_review"), 9).otherwise(1)
    found = sampling.oversampled(
        df, 100, weight=weight, strata=["framework_slug", "needs_review"]
    )
    assert found.count() == 100 and found.columns == df.columns
    assert found.filter("needs_review").count() == 50


def test_the_table_is_not_shuffled(spark):
    df = spark.range(5000).selectExpr("cast(id as string) node_id", "id % 7 g", "repeat('x', 50) body")
    for sample in (
        sampling.random_sample(df, 100),
        sampling.stratified_sample(df, 100, stratum="g"),
        sampling.oversampled(df, 100, weight=F.lit(1), strata=["g"]),
    ):
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "body" in plan and "Exchange hashpartitioning" not in plan
        assert "SinglePartition" not in plan and sample.count() == 100


def test_exact_size_with_repeated_and_missing_keys(spark):
    rows = [("a", i) for i in range(30)] + [(None, i) for i in range(30)] + [(str(i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "node_id string, x long")
    for n in (1, 7, 31, 45, 99, 100, 150):
        assert sampling.random_sample(df, n).count() == min(n, 100)


def test_strata_stay_apart(spark):
    values = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c")]
    df = spark.createDataFrame([(f"{i}-{k}", *v) for k, v in enumerate(values) for i in range(50)], "node_id string, p string, q string")
    found = sampling.oversampled(df, 8, weight=F.lit(1), strata=["p", "q"])
    assert {(r.p, r.q): r["count"] for r in found.groupBy("p", "q").count().collect()} == dict.fromkeys(values, 2)
