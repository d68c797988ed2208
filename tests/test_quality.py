from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.functions.columns import FLOATING_NUMBER
from cohortlake.contract import RECORDS, Contract, ContractError
from cohortlake.operators import (
    apply_contract,
    check_columns,
    drop_null_key,
    null_profile,
    parse_failures,
    quality_counts,
    record_count,
    split_valid,
)

SMALL = Contract(
    schema=T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("age", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("day", T.DateType()),
        ]
    ),
    critical=("id",),
    key="id",
)
CRITICAL = ("id", "drug")


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("a", "x"), ("", "x"), (None, "x"), ("b", ""), ("c", None), (" ", "y"), ("d", "z")],
        "id string, drug string",
    )


def test_split_by_critical_fields(rows):
    valid, invalid = split_valid(rows, CRITICAL)
    assert sorted(r.id for r in valid.collect()) == [" ", "a", "d"]
    assert invalid.count() == 4
    assert valid.count() + invalid.count() == rows.count()


def test_validity_reaches_the_scan(spark, rows, tmp_path, plan_of):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    valid, invalid = split_valid(spark.read.parquet(path), CRITICAL)
    pushed = plan_of(valid).split("PushedFilters: [")[1]
    assert "IsNotNull(id)" in pushed and "Not(EqualTo(id," in pushed
    assert "Or(Or(IsNull(id),EqualTo(id," in plan_of(invalid)
    assert (valid.count(), invalid.count()) == (3, 4)


def test_trim_makes_whitespace_missing(rows):
    assert sorted(r.id for r in split_valid(rows, CRITICAL, trim=True)[0].collect()) == ["a", "d"]


def test_quality_counts(rows):
    assert tuple(quality_counts(rows, CRITICAL).first()) == (7, 3, 4)
    assert tuple(quality_counts(rows.limit(0), CRITICAL).first()) == (0, 0, 0)
    assert record_count(rows).first().record_count == 7


def test_numeric_critical_field(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "x double")
    assert tuple(quality_counts(df, ["x"]).first()) == (3, 1, 2)


def test_drop_null_key(rows):
    kept = drop_null_key(rows, "id").collect()
    assert sorted(r.id for r in kept) == ["", " ", "a", "b", "c", "d"]


def test_null_profile(spark):
    df = spark.createDataFrame(
        [(None, 1.0, 1), ("", math.nan, None), (" ", None, 3), ("a", 2.0, 4)],
        "s string, x double, n int",
    )
    found = {r.column_name: (r.missing_count, r.missing_share) for r in null_profile(df).collect()}
    assert found == {"s": (2, 0.5), "x": (2, 0.5), "n": (1, 0.25)}
    empty = null_profile(df.limit(0)).collect()
    assert [(r.missing_count, r.missing_share) for r in empty] == [(0, None)] * 3


def test_check_columns(spark):
    df = spark.createDataFrame([], "id string, age int, more string")
    with pytest.raises(ContractError, match="day, score"):
        check_columns(df, SMALL)
    df = spark.createDataFrame([], "b string, day date, score double, id string, age int, a int")
    assert check_columns(df, SMALL) == ["a", "b"]


def test_contract_names_must_exist():
    with pytest.raises(ContractError):
        Contract(SMALL.schema, ("nope",), "id")
    with pytest.raises(ContractError):
        Contract(SMALL.schema, ("id",), "nope")


TEXTS = [
    ("a", "40", "1.5", "2023-01-05"),
    ("b", "45.0", "abc", "2023-1-5"),
    ("c", " 41 ", "NaN", "nonsense"),
    ("", "", "", ""),
    (None, None, None, None),
    ("d", "99999999999", "-1e3", "2023-02-30"),
    ("e", "NA", "NA", "NA"),
]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(
        [t[::-1] for t in TEXTS], "day string, score string, age string, id string"
    )


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_apply_contract(spark, texts, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = apply_contract(texts, SMALL)
        assert df.schema == SMALL.schema
        assert [tuple(r) for r in df.collect()] == [
            ("a", 40, 1.5, dt.date(2023, 1, 5)),
            ("b", None, None, None),
            ("c", 41, None, None),
            (None, None, None, None),
            (None, None, None, None),
            ("d", None, -1000.0, None),
            ("e", None, None, None),
        ]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_parse_failures(texts):
    found = {r.column_name: r.failures for r in parse_failures(texts, SMALL).collect()}
    assert found == {"id": 0, "age": 3, "score": 2, "day": 4}


def test_null_values_are_missing_not_failures(texts):
    contract = Contract(SMALL.schema, SMALL.critical, SMALL.key, null_values=("NA", "e"))
    found = {r.column_name: r.failures for r in parse_failures(texts, contract).collect()}
    assert found == {"id": 0, "age": 2, "score": 1, "day": 3}
    assert apply_contract(texts, contract).where("id = 'e'").count() == 0


def test_apply_contract_keeps_typed_columns(spark):
    df = spark.createDataFrame(
        [(dt.date(2023, 1, 5), 1.5, 40, "a")], "day date, score double, age int, id string"
    )
    assert tuple(apply_contract(df, SMALL).first()) == ("a", 40, 1.5, dt.date(2023, 1, 5))


def test_whole_numbers_as_the_cast_reads_them(spark):
    texts = ["1", "+1", "-1", " 1", "1\t", "1.", "1e2", "0x1", "1 1", "٣", "--1", "2147483648"]
    df = spark.createDataFrame(
        [("a", t, None, None) for t in texts], "id string, age string, score string, day string"
    )
    typed = [r.age for r in apply_contract(df, SMALL).collect()]
    cast = [r.age for r in df.selectExpr("try_cast(age AS int) AS age").collect()]
    assert typed == cast == [1, 1, -1, 1, 1] + [None] * 7


def test_one_pass_each(rows, texts, plan_of):
    for df in (quality_counts(rows, CRITICAL), null_profile(rows), parse_failures(texts, SMALL)):
        plan = plan_of(df)
        assert plan.count("Scan ") == 1 and plan.count("Exchange SinglePartition") == 1
        assert "Python" not in plan


def test_names_with_dots(spark):
    df = spark.createDataFrame([("", 1)], "`a.b` string, n int")
    found = {r.column_name: r.missing_count for r in null_profile(df).collect()}
    assert found == {"a.b": 1, "n": 0}


def test_default_contract():
    assert RECORDS.key == "patient_id" and len(RECORDS.names) == 10


def test_the_pattern_of_numbers_lets_all_through_that_parse(spark):
    signs, blanks = ["", "+", "-"], ["", " ", "\t", "\n"]
    cores = ["1", "1.", ".5", "1.5", "1e5", "1E-5", "1.e+5", "1d", "1.5F", "0x1p3", "0X1.8P-1d", "inf", "Infinity",
             "iNf", "nan", "NaN", "", ".", "e5", "1e", "0x1", "forty", "1,5", "1 5", "--1", "infinit", "1e400"]
    texts = [f"{b}{s}{c}{e}" for b in blanks for s in signs for c in cores for e in blanks]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    parses, passes = F.col("x").try_cast("double").isNotNull(), F.col("x").rlike(FLOATING_NUMBER)
    assert df.where(parses & ~passes).count() == 0
    assert df.where(parses).count() > 500
    assert df.where("x IN ('forty', '1,5', '--1')").where(passes).count() == 0
