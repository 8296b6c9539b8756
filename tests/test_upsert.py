from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomstead.operators.joins import hot_keys, join_unique
from loomstead.operators.upsert import broken_unique, keep_last, number_rows, upsert
from loomstead.sources.shared import Cuts
from pyspark.sql import functions as F

ROW = st.tuples(st.integers(1, 4), st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.integers(0, 3)))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=6, unique_by=lambda r: r[0]), st.lists(ROW, max_size=8))
def test_upsert_is_a_loop_of_single_upserts(spark, base, batch):
    want = {k: (a, b) for k, a, b in base}
    for k, a, b in batch:  # a is kept, b is overwritten, by nulls too
        want[k] = (want[k][0] if k in want else a, b)
    last = {k: (a, b) for k, a, b in batch}
    want = {k: (want[k][0] if k in dict((r[0], 1) for r in base) else last[k][0], want[k][1]) for k in want}
    schema = "k int, a string, b int"
    new = spark.createDataFrame([(*r, i) for i, r in enumerate(batch)], schema + ", n int")
    got = upsert(spark.createDataFrame(base, schema), new, ["k"], ["b"], ["n"]).collect()
    assert {r.k: (r.a, r.b) for r in got} == want and len(got) == len(want)


def test_null_keys_empty_sides_and_extra_columns(spark):
    base = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(None, "n", 9), (1, "y", 9)], "k int, v string, _other int")
    rows = upsert(base, new, ["k"], ["v"])
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "y"), (None, "n")]
    assert upsert(base.limit(0), new.limit(0), ["k"], ["v"]).count() == 0
    assert keep_last(new.limit(0), ["k"], ["v"]).count() == 0
    assert broken_unique(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).collect()[0][0] == 1


def test_numbers_follow_the_order_across_partitions(spark):
    rows = spark.range(0, 5000).withColumn("x", F.pmod(F.col("id") * 7919, F.lit(5000))).drop("id").repartition(7)
    got = number_rows(rows, ["x"], 11, Cuts(spark, "t")).orderBy("x").select("id").collect()
    assert [r[0] for r in got] == list(range(11, 5011))
    assert number_rows(rows.limit(0), ["x"], 1, Cuts(spark, "t")).count() == 0


def test_a_hot_key_is_joined_as_any_other(spark):
    left = spark.range(0, 9000).select(F.when(F.col("id") < 6000, 1).when(F.col("id") < 6100, None).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "hot"), (7000, "cold")], "k long, v string")
    assert hot_keys(left.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n") == [(1,)]
    got = join_unique(left, right, ["k"])
    assert got.count() == 9000
    assert {r[0]: r[1] for r in got.groupBy("v").count().collect()} == {"hot": 6000, "cold": 1, None: 2999}
    assert join_unique(left, right, ["k"], "inner").count() == 6001


def test_null_keys_match_nothing_and_spread(spark):
    base = spark.createDataFrame([(None, "a", 1), (1, "b", 2), (None, None, 3)], "k int, m string, v int")
    batch = spark.createDataFrame([(None, "a", 9), (1, "b", 8), (1, None, 7)], "k int, m string, v int")
    got = sorted(map(tuple, upsert(base, batch, ("k", "m"), ("v",)).collect()), key=repr)
    assert got == sorted([(None, "a", 1), (None, "a", 9), (None, None, 3), (1, "b", 8), (1, None, 7)], key=repr)
    many = spark.range(4000).selectExpr("cast(null as int) as k", "'x' as m", "cast(id as int) as v")
    out = upsert(base, many, ("k", "m"), ("v",))
    assert out.count() == 4003
    from loomstead.operators.upsert import _spread

    assert many.select(_spread(many.columns, ("k", "m")).alias("s")).distinct().count() == 4000
