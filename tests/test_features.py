from __future__ import annotations

import datetime as dt
import math

import pytest

from cohortlake.contract import DOSAGE_EDGES, DOSAGE_LABELS, WEIGHT_EDGES, WEIGHT_LABELS
from cohortlake.operators import bucketize, fill_missing, parse_date, stamp

DOSES = [-1.0, 0.0, 99.9, 99.99999999, 100.0, 299.9, 300.0, 1e9, None, math.nan]


def labels(spark, values, edges, names, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    rows = bucketize(df, "x", edges, names, "label", **options).orderBy("i").collect()
    return [r.label for r in rows]


def test_left_closed(spark):
    found = labels(spark, DOSES, DOSAGE_EDGES, DOSAGE_LABELS)
    assert found == ["low", "low", "low", "low", "medium", "medium", "high", "high", None, None]


def test_missing_in_the_last_bucket(spark):
    found = labels(spark, DOSES, DOSAGE_EDGES, DOSAGE_LABELS, null_label="high")
    assert found[-2:] == ["high", "high"]


def test_right_closed_from_zero(spark):
    found = labels(spark, DOSES, DOSAGE_EDGES, DOSAGE_LABELS, closed="right", lower=0)
    assert found == [None, None, "low", "low", "low", "medium", "medium", "high", None, None]


def test_weight(spark):
    values = [45.0, 59.9, 60.0, 84.9, 85.0]
    left = labels(spark, values, WEIGHT_EDGES, WEIGHT_LABELS)
    assert left == ["underweight", "underweight", "normal", "normal", "overweight"]
    right = labels(spark, values, WEIGHT_EDGES, WEIGHT_LABELS, closed="right", lower=0)
    assert right == ["underweight", "underweight", "underweight", "normal", "normal"]


def test_lower_end_of_left_closed_is_inside(spark):
    assert labels(spark, [-0.1, 0.0], (10,), ("a", "b"), lower=0) == [None, "a"]


@pytest.mark.parametrize(
    "edges, names, closed",
    [((1, 2), ("a", "b"), "left"), ((2, 1), ("a", "b", "c"), "left"), ((1,), ("a", "b"), "up")],
)
def test_bad_rules(spark, edges, names, closed):
    with pytest.raises(ValueError):
        labels(spark, [1.0], edges, names, closed=closed)


def test_stamp(spark):
    df = spark.range(3)
    fixed = stamp(df, "2024-06-01 12:30:00").collect()
    assert {r.processed_at for r in fixed} == {dt.datetime(2024, 6, 1, 12, 30)}
    now = stamp(df, output="loaded").select("loaded").distinct().collect()
    assert len(now) == 1 and now[0].loaded is not None
    schema = stamp(df, dt.datetime(2024, 1, 1)).schema
    assert schema["processed_at"].dataType.typeName() == "timestamp"


def test_fill_missing(spark):
    df = spark.createDataFrame(
        [(None, None, None), (math.nan, "a", 1)], "x double, s string, n int"
    )
    rows = fill_missing(df, {"x": 7.5, "s": "none"}).collect()
    assert [tuple(r) for r in rows] == [(7.5, "none", None), (7.5, "a", 1)]


def test_parse_date(spark):
    texts = ["2023-01-05", "2023-1-5", "05/01/2023", "2023-02-30", " 2023-01-05"]
    texts += ["2023-01-05\n", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = parse_date(df, "t", "d").orderBy("i").collect()
    assert [r.d for r in rows] == [dt.date(2023, 1, 5)] + [None] * 7
    rows = parse_date(df, "t", "d", "dd/MM/yyyy").orderBy("i").collect()
    assert [r.d for r in rows] == [None, None, dt.date(2023, 1, 5)] + [None] * 5
