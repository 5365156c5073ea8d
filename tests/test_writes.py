import pytest
from pyspark.sql import functions as F

from shiftroll.functions.writes import first_per_key, insert_if_absent, insert_not_exists, require_unique


def batch(spark):
    return spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "z"), (3, "c")], "k int, v string")


def test_smallest_row_of_each_key_wins(spark, rows):
    assert rows(insert_if_absent(batch(spark), None, ["k"])) == [(1, "a"), (2, None), (3, "c")]


def test_existing_keys_are_skipped_and_a_second_run_adds_nothing(spark):
    known = spark.createDataFrame([(3,)], "k int")
    first = insert_if_absent(batch(spark), known, ["k"])
    assert sorted(r["k"] for r in first.collect()) == [1, 2]
    again = insert_if_absent(batch(spark), known.union(first.select("k")), ["k"])
    assert again.count() == 0


def test_given_order_decides(spark, rows):
    df = spark.createDataFrame([(1, "a", 9), (1, "b", 1)], "k int, v string, n int")
    assert rows(insert_if_absent(df, None, ["k"], ["n"])) == [(1, "b", 1)]


def test_key_without_value_fails_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(Exception, match="NULL in key column k"):
        insert_if_absent(df, None, ["k"]).collect()


def test_repeated_key_is_refused(spark):
    with pytest.raises(ValueError, match="k="):
        require_unique(batch(spark), ["k"])
    require_unique(batch(spark), ["k", "v"])


def test_rank_filter_runs_before_the_shuffle(spark):
    plan = first_per_key(spark.range(10).withColumn("k", F.col("id") % 2), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_not_exists_keeps_repeats_inside_the_batch(spark, rows):
    known = spark.createDataFrame([(3,), (3,)], "k int")
    assert rows(insert_not_exists(batch(spark), known, ["k"]), "k") == [(1,), (1,), (2,), (2,)]
    assert insert_not_exists(batch(spark), None, ["k"]).count() == 5
