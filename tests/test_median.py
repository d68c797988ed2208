from __future__ import annotations

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlake.operators import imputation as module
from cohortlake.operators import impute_median, median
from cohortlake.operators.imputation import linear, magnitude

NAN, INF = math.nan, math.inf
SF_DIR = "/root/testdata/sf0.001"


def frame(spark, values, parts=3):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)


@pytest.fixture
def narrow(monkeypatch):
    """Make the linear passes run on small data, with few and coarse buckets."""
    monkeypatch.setattr(module, "LOG_BUCKETS", 2)
    monkeypatch.setattr(module, "LINEAR_BUCKETS", 3)


@pytest.fixture
def passes(monkeypatch):
    """The number of passes over the values, by counting."""
    calls = []
    holders = module._holders
    monkeypatch.setattr(module, "_holders", lambda *a: calls.append(1) or holders(*a))
    return calls


CASES = [
    [1.0, 2.0, 3.0, 4.0],
    [5.0],
    [5.0, 5.0, 5.0, 1.0],
    [1.0] * 50 + [2.0] * 50,
    [1.0] * 50 + [1e300] * 50,
    [-1e300] * 3 + [1e300] * 3,
    [-3.0, -2.0, -1.0, 0.0, 0.0, 4.0],
    [5e-324, -5e-324, 1e-310, 0.0, -0.0, 2.0],
    [-INF, 1.0, 2.0, INF],
    [INF, INF, INF, 1.0],
    [-INF, -INF, 7.0],
    [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0 + 2**-50],
    [float(v) for v in range(1000)],
    [-INF, 5.0],
    [5.0, INF],
    [-1.7e308, 1.7e308],
    [-1.7e308, 1.6e308, 1.7e308, 1.0],
]


@pytest.mark.parametrize("values", CASES)
def test_exact_is_the_middle(spark, values):
    assert median(frame(spark, values), "x") == statistics.median(values)


@pytest.mark.parametrize("values", CASES)
def test_narrowing_gives_the_same(spark, narrow, values):
    assert median(frame(spark, values), "x") == statistics.median(values)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.floats(-1e6, 1e6) | st.integers(-3, 3).map(float), min_size=1, max_size=60))
def test_narrowing_on_any_values(spark, narrow, values):
    assert median(frame(spark, values), "x") == pytest.approx(statistics.median(values), rel=1e-15)


def test_many_distinct_values_take_more_passes(spark, monkeypatch, passes):
    monkeypatch.setattr(module, "LOG_BUCKETS", 4)
    draw = random.Random(7)
    values = [draw.lognormvariate(0, 4) for _ in range(5001)]
    assert median(frame(spark, values, 8), "x") == statistics.median(values)
    assert 2 <= len(passes) <= 5


def test_few_distinct_values_take_one_pass(spark, passes):
    values = [1.0] * 400 + [2.0] * 300 + [3.0] * 600
    assert median(frame(spark, values, 8), "x") == statistics.median(values)
    assert len(passes) == 1


def test_closest_doubles_end(spark, passes):
    """A hot value between its direct neighbours."""
    near = [1.5 - 2**-52, 1.5 + 2**-52, 1.5 + 2**-51]
    values = [1.0] * 10 + near * 3 + [1.5] * 30 + [1.75] * 10
    assert median(frame(spark, values, 4), "x") == statistics.median(values)
    assert len(passes) <= 4


def test_a_narrow_range_is_combined_in_the_map_tasks(spark):
    """What a linear pass shuffles is bounded by tasks times buckets, and not by the values."""
    df = spark.range(0, 400_000, 1, 4).select((F.col("id") / 1_600_000 + 1000).alias("v"))
    plan = df.groupBy(linear(F.col("v"), 1000.0, 1000.25).alias("bucket")).count()
    assert plan.count() <= module.LINEAR_BUCKETS + 2 < 400_000 / 50
    assert median(df, "v", reread=True) == df.selectExpr("percentile(v, 0.5)").first()[0]


def test_rereading_gives_the_same(spark):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    assert median(df, "l_extendedprice", reread=True) == median(df, "l_extendedprice")


def test_bucket_numbers_never_fall(spark):
    values = sorted(
        [s * m * 2.0**e for e in range(-1074, 1024, 7) for m in (1, 1.3, 1.999) for s in (1, -1)]
        + [0.0, INF, -INF, 5e-324, 1.7e308]
    )
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    steps = [r[0] for r in df.select(magnitude(F.col("x"))).collect()]
    assert steps == sorted(steps)
    between = df.where("x between 1 and 3000").select(linear(F.col("x"), 1.0, 3000.0))
    steps = [r[0] for r in between.collect()]
    assert steps == sorted(steps)


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_missing_values_do_not_count(spark, method):
    assert median(frame(spark, [1.0, NAN, NAN, NAN, None]), "x", method) == 1.0
    assert median(frame(spark, [NAN, None]), "x", method) is None
    assert median(frame(spark, []), "x", method) is None


def test_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert median(df, "x") == 1.5


@pytest.mark.parametrize(
    "table, col", [("lineitem", "l_extendedprice"), ("lineitem", "l_discount"), ("events", "value")]
)
@pytest.mark.parametrize("error", [0.01, 0.0025])
def test_approx_stays_within_its_rank_error(spark, table, col, error):
    df = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(col).repartition(5)
    found = median(df, col, "approx", error)
    n = df.count()
    assert df.where(F.col(col) < found).count() <= (0.5 + error) * n
    assert df.where(F.col(col) <= found).count() >= (0.5 - error) * n
    assert df.where(F.col(col) == found).count() > 0


@pytest.mark.parametrize("error", [0.2, 0.01, 0.0001])
@pytest.mark.parametrize(
    "values",
    [
        [float(v) for v in range(3000)],
        [float(v) for v in reversed(range(3000))],
        [1.0] * 1000 + [2.0] * 999 + [3.0] * 2,
        [1000 + v / 1e7 for v in range(3000)],
        [5.0] * 1499 + [7.0] * 1501,
        [-INF] * 3 + [INF] * 4,
    ],
)
def test_approx_never_misses_its_bound(spark, values, error):
    found = {median(frame(spark, values, parts), "x", "approx", error) for parts in (1, 7)}
    assert len(found) == 1
    (found,) = found
    assert found in values
    assert sum(v < found for v in values) <= (0.5 + error) * len(values)
    assert sum(v <= found for v in values) >= (0.5 - error) * len(values)


def test_approx_takes_one_pass_where_it_can(spark, passes):
    values = [float(v) for v in range(1, 20_001)]
    median(frame(spark, values, 4), "x", "approx", 0.01)
    assert len(passes) == 1


@pytest.mark.parametrize("error", [0, 1, -0.1])
def test_an_error_must_be_a_share(spark, error):
    with pytest.raises(ValueError, match="between 0 and 1"):
        median(frame(spark, [1.0]), "x", "approx", error)


def test_two_passes_over_all_values(spark):
    """One counts, one keeps what lies around the middle; later ones read only that."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    n = 200_000
    df = spark.range(0, n, 1, 4).select((F.pow(F.col("id") + 1.0, 1.7) % 50_021.3).alias("v"))
    df.write.mode("overwrite").format("noop").save()
    values = df.mapInArrow(counted, "v double")
    found = module.exact_median(values)
    assert found == df.selectExpr("percentile(v, 0.5)").first()[0]
    assert reads.value == 2 * n


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        median(frame(spark, [1.0]), "x", "guess")


def test_impute_fills_null_and_nan(spark):
    rows = impute_median(frame(spark, [1.0, 2.0, None, NAN]), "x").collect()
    assert sorted(r.x for r in rows) == [1.0, 1.5, 1.5, 2.0]


def test_impute_rounds_half_up_unless_told_not_to(spark):
    df = frame(spark, [2.675, None])
    assert sorted(r.x for r in impute_median(df, "x").collect()) == [2.675, 2.68]
    assert [r.x for r in impute_median(df, "x", digits=None).collect()] == [2.675, 2.675]


def test_impute_without_any_value_leaves_null(spark):
    rows = impute_median(frame(spark, [None, NAN]), "x").collect()
    assert [r.x for r in rows] == [None, None]


def test_imputed_frame_is_one_narrow_pass(spark, plan_of):
    plan = plan_of(impute_median(frame(spark, [1.0, None]), "x"))
    for node in ("Join", "Aggregate", "Window", "CartesianProduct", "Subquery"):
        assert node not in plan


def test_shuffle_carries_bucket_totals(spark, plan_of, monkeypatch):
    """Counted per bucket in the map tasks; only totals meet in the one ranking task."""
    plans = []
    original = type(spark.range(1)).collect
    monkeypatch.setattr(
        type(spark.range(1)), "collect", lambda df: plans.append(plan_of(df)) or original(df)
    )
    median(frame(spark, [1.0, 2.0, 2.0]), "x")
    (plan,) = [p for p in plans if "Window" in p]
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning") == 1
    before_window = plan.split("SinglePartition")[1]
    assert "HashAggregate" in before_window and "Python" not in plan
