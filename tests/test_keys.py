import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shiftroll.functions import keys
from shiftroll.functions.keys import dense_ids, high_water, max_id
from shiftroll.session import materialise


def numbered(spark, n=5000):
    """A third of the rows share one key, and a third of all are the same row."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(n, numPartitions=6).select(
        key.alias("k"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v")
    )


def test_ids_are_dense_and_ordered(spark):
    got = [(r["id"], r["k"]) for r in dense_ids(numbered(spark), ["k", "v"], base=100).collect()]
    ids = sorted(i for i, _ in got)
    assert ids == list(range(101, 101 + 5000))
    by_id = [k for _, k in sorted(got)]
    assert by_id == sorted(by_id)


def test_ids_equal_a_global_row_number(spark):
    df = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("k"), F.col("id").alias("v"))
    ours = {(r["v"], r["id"]) for r in dense_ids(df, ["k", "v"]).collect()}
    ranked = df.withColumn("n", F.row_number().over(Window.orderBy("k", "v")))
    assert ours == {(r["v"], r["n"]) for r in ranked.collect()}


def test_ids_per_scope_on_top_of_each_base(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("tenant"), F.col("id").alias("v"))
    base = spark.createDataFrame([("0", 50), ("1", 7)], "tenant string, base long")
    got = dense_ids(df, ["v"], base, scope=["tenant"], overall_col="n").collect()
    for tenant, start in (("0", 50), ("1", 7), ("2", 0)):
        mine = sorted((r["v"], r["id"]) for r in got if r["tenant"] == tenant)
        assert [i for _, i in mine] == list(range(start + 1, start + 1 + len(mine)))
    assert sorted(r["n"] for r in got) == list(range(1, 1001))


def test_no_rows_no_ids(spark):
    assert dense_ids(spark.range(0).withColumnRenamed("id", "v"), ["v"]).count() == 0


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        dense_ids(spark.range(1).withColumnRenamed("id", "_part"), ["_part"])


def test_a_hot_key_is_spread_over_sort_tasks(spark, monkeypatch):
    """Equal keys are split by source partition, so no task sorts a third of the rows."""
    stored = []
    monkeypatch.setattr(keys, "materialise", lambda df: stored.append(materialise(df)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.range(60_000, numPartitions=12).select(F.lit(7).alias("k"))
        assert dense_ids(hot, ["k"]).agg(F.max("id")).first()[0] == 60_000
        sizes = [r["count"] for r in stored[0].groupBy("_part").count().collect()]
        assert len(sizes) > 1 and max(sizes) <= 60_000 / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_high_water_and_max(spark):
    df = spark.createDataFrame([("a", 4), ("a", 9), ("b", 2)], "tenant string, id long")
    assert high_water(df).first()["next_id"] == 10
    assert high_water(df.limit(0)).first()["next_id"] == 1
    assert {tuple(r) for r in high_water(df, scope=["tenant"]).collect()} == {("a", 10), ("b", 3)}
    assert max_id(df) == 9
    assert max_id(df.limit(0)) == 0
    assert max_id(None) == 0


def test_ids_per_scope_run_on_over_sort_tasks(spark, rows):
    """Scopes that fill several sort tasks, and tasks that hold several scopes."""
    df = spark.range(5000, numPartitions=4).select(
        F.when(F.col("id") % 10 < 7, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("scope"),
        (F.col("id") * 7919 % 5003).alias("v"),
    )
    got = dense_ids(df, ["v"], 10, "id", ["scope"], "overall").collect()
    by_scope = {}
    for r in sorted(got, key=lambda r: (r["scope"], r["v"])):
        by_scope.setdefault(r["scope"], []).append(r["id"])
    assert all(ids == list(range(11, 11 + len(ids))) for ids in by_scope.values())
    overall = [r["overall"] for r in sorted(got, key=lambda r: (r["scope"], r["v"]))]
    assert overall == list(range(1, 5001))
