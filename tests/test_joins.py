import pytest
from pyspark.sql import functions as F

from shiftroll.functions import joins as J


@pytest.fixture
def sides(spark):
    """Half of the rows have key 7, some have none, some have a key unknown to the other side."""
    n = F.col("id")
    key = F.when(n % 2 == 0, F.lit(7)).when(n % 5 == 0, F.lit(None)).otherwise(n % 100).cast("int")
    fact = spark.range(20_000, numPartitions=6).select(key.alias("k"), (n % 10).alias("v"))
    keyed = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return fact, keyed


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_spread_join_equals_plain_join(sides, how, rows):
    fact, keyed = sides
    [hot] = J.hot_keys(fact, [["k"]], min_rows=1)
    assert hot and max(n for _, n in hot) > 1
    spread = J.spread_join(fact, keyed, ["k"], how, hot)
    assert rows(spread) == rows(fact.join(keyed, "k", how))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_lookup_join_beyond_the_broadcast_limit(sides, how, rows):
    fact, keyed = sides
    got = J.lookup_join(fact, keyed, ["k"], how, max_rows=10, min_hot_rows=1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert rows(got) == rows(fact.join(keyed, "k", how))


def test_hot_rows_land_in_several_tasks(spark, sides):
    fact, keyed = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        [hot] = J.hot_keys(fact, [["k"]], min_rows=1)
        joined = J.spread_join(fact, keyed, ["k"], "inner", hot)
        sizes = joined.filter("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) > 1
        assert max(r["count"] for r in sizes) < 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_hot_keys_no_salt(spark):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    assert J.hot_keys(fact, [["k"]], min_rows=1) == [[]]
    assert J.hot_keys(fact.filter("k < 0"), [["k"]], min_rows=1) == [[]]


def test_small_enough_counts_rows_and_bytes(spark, monkeypatch):
    narrow = spark.range(100)
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert J.small_enough([narrow, wide]) == [True, True]
    assert J.small_enough([narrow], max_rows=99) == [False]
    monkeypatch.setattr(J, "BROADCAST_MAX_BYTES", 500_000)
    assert J.small_enough([narrow, wide]) == [True, False]


def test_anti_join_with_repeated_keys(sides, rows):
    fact, keyed = sides
    repeated = keyed.union(keyed).union(keyed)
    got = J.lookup_join(fact, repeated.select("k"), ["k"], "left_anti", max_rows=1, min_hot_rows=1)
    assert rows(got) == rows(fact.join(keyed, "k", "left_anti"))


def test_several_lookups_at_once(spark, sides, rows):
    fact, keyed = sides
    names = spark.range(10).select(F.col("id").alias("v"), F.concat(F.lit("n"), "id").alias("name"))
    lookups = [J.Lookup(keyed, ["k"], "left"), J.Lookup(names, ["v"])]
    expected = rows(fact.join(keyed, "k", "left").join(names, "v"), "k", "v", "w", "name")
    for max_rows in (None, 20, 0):
        got = J.lookup_joins(fact, lookups, max_rows, min_hot_rows=1)
        assert rows(got, "k", "v", "w", "name") == expected


def test_composite_keys(spark, rows):
    fact = spark.range(9000, numPartitions=5).select(
        F.lit("t").alias("tenant"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("k")
    )
    keyed = spark.range(50).select(F.lit("t").alias("tenant"), F.col("id").cast("int").alias("k"), F.col("id").alias("w"))
    got = J.lookup_join(fact, keyed, ["tenant", "k"], max_rows=1, min_hot_rows=1)
    assert rows(got) == rows(fact.join(keyed, ["tenant", "k"]))


def test_arrays_count_towards_the_size(spark):
    rows = spark.range(10).select(
        F.sequence(F.lit(1), F.lit(100_000)).alias("a"),
        F.array(F.lit("ab"), F.lit(None), F.lit("cde")).alias("t"),
        F.array(F.struct(F.lit(1).alias("x"), F.lit("long").alias("y"))).alias("s"),
        F.struct(F.lit("four").alias("z"), F.lit(None).cast("array<long>").alias("n")).alias("o"),
        F.create_map(F.lit("key"), F.lit(1)).alias("m"),
    )
    size = J._measure(rows).first()["bytes"]
    assert 10 * 100_000 * 4 <= size <= 10 * 100_000 * 8 + 10 * 300
    assert J.small_enough([rows.withColumn("a", F.concat(*["a"] * 10))]) == [False]


def test_equal_tables_are_measured_once(spark, sides, monkeypatch):
    fact, keyed = sides
    measured = []
    plain = J._measure
    monkeypatch.setattr(J, "_measure", lambda df: measured.append(df) or plain(df))
    with J.measured_once():
        for _ in range(3):
            again = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
            J.lookup_join(fact, again, ["k"])
        J.lookup_join(fact, again.filter("k < 5"), ["k"])
    assert len(measured) == 2
    J.lookup_join(fact, keyed, ["k"])
    J.lookup_join(fact, keyed, ["k"])
    assert len(measured) == 4


def test_a_joined_fact_is_written_before_its_frequent_keys_are_asked_for(sides, tmp_path, rows):
    fact, keyed = sides
    fact.write.parquet(str(tmp_path / "fact"))
    fact = fact.sparkSession.read.parquet(str(tmp_path / "fact"))
    lookups = [J.Lookup(keyed, ["k"], "left")]
    small = J.lookup_joins(fact, lookups, write_first=True)
    large = J.lookup_joins(fact, lookups, max_rows=1, min_hot_rows=1, write_first=True)
    assert [f for f in small.inputFiles() if f"{tmp_path}/fact" in f]
    assert not [f for f in large.inputFiles() if f"{tmp_path}/fact" in f]
    assert rows(large, "k", "v", "w") == rows(small, "k", "v", "w")
