"""One key holds a third of the rows: same results, and no task that holds the whole group."""

import random

import pytest
from pyspark.sql import functions as F

from goldthread.operators import dedup as dd, documents as dc, ordering as od, rules as ru, skew as sk

N = 3000


def hot(spark):
    r = random.Random(5)
    data = [(i, "hot" if i % 3 == 0 else f"k{r.randrange(400)}", r.randrange(1000)) for i in range(N)]
    return data, spark.createDataFrame(data, "id long, k string, v long")


def test_every_hot_key_is_cut_by_its_rows(spark):
    """200 hot keys and one with half of all rows: the parts of each hold about rows_per_task rows."""
    df = spark.range(40_000).withColumn("k", F.when(F.col("id") % 2 == 0, "half").otherwise(F.concat(F.lit("k"), F.col("id") % 401)))
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
    hot_ones = {r["k"]: r["_salts"] for r in sk.hot_keys(counts, ["k"], rows_per_task=40).collect()}
    assert hot_ones["half"] == 500 and len(hot_ones) == 402 and set(hot_ones.values()) == {500, 2}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        joined = sk.salted_join(df, counts.withColumnRenamed("_rows", "n"), ["k"], ["id"], rows_per_task=40)
        load = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.min("count"), F.sum("count")).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert load[2] == 40_000 and load[0] < 1.5 * 40_000 / 20 and load[1] > 0.5 * 40_000 / 20


def test_salted_join_equals_a_plain_join(spark, rows):
    _, df = hot(spark)
    one = df.groupBy("k").agg(F.max("v").alias("m")).filter("k <> 'k1'")
    for how in ("inner", "left"):
        assert rows(sk.salted_join(df, one, ["k"], ["id"], how, rows_per_task=50), "id", "m") == rows(df.join(one, "k", how), "id", "m")


def test_salted_join_spreads_the_hot_key(spark):
    _, df = hot(spark)
    one = df.groupBy("k").agg(F.max("v").alias("m"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = sk.salted_join(df, one, ["k"], ["id"], rows_per_task=50).filter("k = 'hot'").withColumn("p", F.spark_partition_id())
        largest = joined.groupBy("p").count().agg(F.max("count"), F.count("p")).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert largest[1] > 1 and largest[0] < N / 3


@pytest.mark.parametrize("per_task", [10, 10**6])
def test_group_values_equal_a_window(spark, rows, monkeypatch, per_task):
    monkeypatch.setattr(sk, "ROWS_PER_TASK", per_task)
    _, df = hot(spark)
    df = df.withColumn("k", F.when(F.col("k") != "k2", F.col("k")))  # a null group
    got = sk.with_group_values(df, ["k"], ["id"], m=F.max("v"), n=F.count(F.lit(1)))
    df.createOrReplaceTempView("t")
    want = spark.sql("SELECT id, max(v) OVER (PARTITION BY k) m, count(*) OVER (PARTITION BY k) n FROM t")
    assert rows(got, "id", "m", "n") == rows(want)


def test_numbers_and_running_sums_of_a_hot_group(spark, rows):
    _, df = hot(spark)
    df.createOrReplaceTempView("t")
    want = rows(spark.sql("SELECT id, row_number() OVER (PARTITION BY k ORDER BY v, id) n, sum(v) OVER (PARTITION BY k ORDER BY v, id) s FROM t"))
    numbered = od.number_rows(df, ["v", "id"], ["k"], "n")
    assert rows(od.running_sum(numbered, "v", ["v", "id"], ["k"], "s"), "id", "n", "s") == want


def test_ranking_trims_groups_before_the_shuffle(spark):
    _, df = hot(spark)
    plan = dd.latest_per_key(df, ["k"], [F.col("v").desc(), F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_a_key_with_many_children_is_one_row(spark):
    """200,000 children of one key, whole blocks of them with the same order value."""
    df = spark.range(200_000).select(F.lit("hot").alias("k"), F.col("id"), (F.col("id") % 7).alias("v")).unionByName(
        spark.range(5).select(F.lit("b").alias("k"), F.col("id"), F.lit(1).cast("long").alias("v")))
    children = dc.ChildList(df, {"id": "id"}, ("v",))
    nested = {r["k"]: r["ids"] for r in dc.nest_lists({"items": children}, ["k"]).select("k", F.col("items.id").alias("ids")).collect()}
    assert nested["hot"] == sorted(range(200_000), key=lambda i: (i % 7, i)) and nested["b"] == list(range(5))
    numbered = dc.numbered_children(children, ["k"]).select("k", "position", "element.id")
    wrong = numbered.filter("k = 'hot'").join(spark.createDataFrame([(i + 1, x) for i, x in enumerate(nested["hot"])], "position long, want long"), "position").filter("id <> want")
    assert numbered.count() == 200_005 and wrong.isEmpty()


@pytest.mark.parametrize("per_task", [10, 10**6])
def test_hot_block_makes_linear_links(spark, monkeypatch, per_task):
    monkeypatch.setattr(sk, "ROWS_PER_TASK", per_task)
    _, df = hot(spark)
    found = ru.exact_links(df, [ru.ExactRule("r", (F.col("k"),))])
    assert found.count() <= N
