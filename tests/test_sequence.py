import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardbrook.functions.sequence import key_bounds, number_of, run_of, seq_key, time_key

canonical = st.integers(0, 10**120).map(str)


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(canonical, min_size=2, max_size=50, unique=True))
def test_key_order_is_numeric(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    found = [r.n for r in df.orderBy(seq_key("n")).collect()]
    assert found == sorted(numbers, key=int)
    keyed = df.select("n", number_of(seq_key("n")).alias("back"))
    assert all(r.n == r.back for r in keyed.collect())


def test_unequal_lengths(spark):
    df = spark.createDataFrame([("9",), ("10",)], "n string")
    assert [r.n for r in df.orderBy(seq_key("n")).collect()] == ["9", "10"]


def test_any_number_of_digits(spark):
    numbers = ["9", "8" * 128, "1" * 129, "2" * 129, "3" * 500, "1" * 2000]
    df = spark.createDataFrame([(n,) for n in reversed(numbers)], "n string")
    assert [r.n for r in df.orderBy(seq_key("n")).collect()] == numbers


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.one_of(canonical, st.integers(0, 3000).map(str)), min_size=1, max_size=40))
def test_ends_without_sorting(spark, numbers):
    rows = [(n[-1:], n) for n in numbers] + [("none", None)]
    keyed = spark.createDataFrame(rows, "g string, n string").select("g", seq_key("n").alias("seq_key"))
    found = {r.g: r for r in key_bounds(keyed, ["g"]).select(
        "g", number_of("first_key").alias("low"), number_of("last_key").alias("high"), "n_records"
    ).collect()}
    for group in {n[-1:] for n in numbers}:
        mine = sorted((n for n in numbers if n[-1:] == group), key=int)
        assert (found[group].low, found[group].high) == (mine[0], mine[-1])
        assert found[group].n_records == len(mine)
    assert found["none"].high is None and found["none"].n_records == 1


def test_the_log_is_not_sorted_for_its_ends(spark):
    keyed = spark.range(10).selectExpr("'a' AS g", "cast(id AS string) AS n").select(
        "g", seq_key("n").alias("seq_key")
    )
    plan = key_bounds(keyed, ["g"])._jdf.queryExecution().executedPlan().toString()
    below_first_exchange = plan.rsplit("Exchange", 1)[1]
    assert "HashAggregate" in below_first_exchange and "Sort" not in below_first_exchange


def test_a_number_that_is_none_fails(spark):
    keyed = spark.sql("SELECT 'a' AS g, '000000031x2' AS seq_key")
    try:
        key_bounds(keyed, ["g"]).collect()
    except Exception as error:
        assert "CAST_INVALID_INPUT" in str(error)
    else:
        raise AssertionError("no error")


def test_runs_never_decrease(spark):
    numbers = [str(n) for n in (0, 7, 10, 99, 100, 999, 1000, 1001, 1999, 2000, 123456)]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    runs = [r.run for r in df.orderBy(seq_key("n")).select(run_of(seq_key("n"), 3).alias("run")).collect()]
    assert runs == sorted(runs)
    assert len(set(runs)) > 2


def test_long_numbers_that_differ_early_have_one_head(spark):
    """56 digits, of which all but the first eighteen vary."""
    rng = random.Random(4)
    numbers = [f"495903382714902566{rng.randrange(10**38):038d}" for _ in range(300)]
    keyed = spark.createDataFrame([("a", n) for n in numbers], "g string, n string").select(
        "g", seq_key("n").alias("seq_key")
    )
    assert keyed.select(run_of("seq_key", 38)).distinct().count() == 1
    found = key_bounds(keyed, ["g"]).select(number_of("first_key"), number_of("last_key")).first()
    assert tuple(found) == (min(numbers), max(numbers))


def test_time_keys_sort_by_time_and_tie(spark):
    df = spark.createDataFrame(
        [("1950-01-01", 1), ("2024-01-01", 9), ("2024-01-01", 10), ("2024-01-02", 2)], "t string, n bigint"
    ).withColumn("key", time_key(F.col("t").cast("timestamp"), "n"))
    assert [(r.t[:4], r.n) for r in df.orderBy("key").collect()] == [("1950", 1), ("2024", 9), ("2024", 10), ("2024", 2)]
