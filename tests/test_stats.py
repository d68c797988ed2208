from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import cohort_stats, ordered, preview

COLUMNS = (
    "patient_id string, trial_id string, drug string, site string, dosage_mg double, age int, "
    "status string, outcome_score double"
)
ROWS = [
    ("P1", "T1", "A", "S1", 100.0, 20, "adverse_event", 50.0),
    ("P1", "T1", "A", "S1", 200.0, 30, "active", None),
    (None, "T1", "A", "S2", None, 40, None, 70.0),
    ("P4", "T1", "A", None, math.nan, None, "adverse_event", math.nan),
    ("P5", "T1", None, "S1", 10.0, 50, "active", 1.0),
    ("P6", None, "B", "S1", 20.0, 60, "withdrawn", 2.0),
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def found(df):
    return {(r.trial_id, r.drug): tuple(r)[2:] for r in df.collect()}


def test_measures(records):
    stats = found(cohort_stats(records))
    assert stats[("T1", "A")] == (3, 150.0, 60.0, 30.0, 2, 2)
    assert stats[("T1", None)] == (1, 10.0, 1.0, 50.0, 1, 0)
    assert stats[(None, "B")] == (1, 20.0, 2.0, 60.0, 1, 0)


def test_null_keys(records):
    assert set(found(cohort_stats(records, null_keys="drop"))) == {("T1", "A")}
    with pytest.raises(ValueError):
        cohort_stats(records, null_keys="maybe")


def test_no_group_without_rows(records):
    assert cohort_stats(records.limit(0)).count() == 0


def test_own_keys_and_measures(records):
    df = cohort_stats(records, ["site"], {"oldest": F.max("age")})
    assert {(r.site, r.oldest) for r in df.collect()} == {("S1", 60), ("S2", 40), (None, None)}


def test_order_is_nulls_first(records):
    rows = ordered(cohort_stats(records)).collect()
    assert [(r.trial_id, r.drug) for r in rows] == [(None, "B"), ("T1", None), ("T1", "A")]


def test_counts_add_up(records):
    total = cohort_stats(records).agg(F.sum("patient_count")).first()[0]
    assert total == records.where("patient_id IS NOT NULL").count()


def test_both_aggregation_steps_combine_before_the_shuffle(records, plan_of):
    plan = plan_of(cohort_stats(records))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count(distinct site" in plan and "partial_avg" in plan
    assert "Python" not in plan and "Join" not in plan


def test_preview_keeps_few_rows_per_task(spark, plan_of):
    df = spark.range(0, 1000, 1, 8).selectExpr("1000 - id AS x")
    first = preview(df, 5, ["x"])
    assert [r.x for r in first.collect()] == [1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in plan_of(first)
