from __future__ import annotations

from pathlib import Path

import pytest

from cohortlake import scratch
from cohortlake.sinks import write_partitioned, write_table, write_validated
from cohortlake.sources import output_inventory, read_partitioned, read_text_columns


@pytest.fixture
def drugs(spark):
    rows = [(i, "2023" if i % 3 else "2024") for i in range(300)]
    return spark.createDataFrame(rows, "id int, drug string").repartition(6)


def test_partition_values_keep_their_type(spark, drugs, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned(drugs, path, "drug")
    assert spark.read.parquet(path).schema["drug"].dataType.typeName() == "integer"
    back = read_partitioned(spark, path, drugs.schema)
    assert back.schema == drugs.schema
    assert sorted(back.collect()) == sorted(drugs.collect())


def test_restriction_prunes_partitions(spark, drugs, tmp_path, plan_of):
    path = str(tmp_path / "out")
    write_partitioned(drugs, path, "drug")
    one = read_partitioned(spark, path, drugs.schema, where={"drug": "2024"})
    assert one.count() == 100
    plan = plan_of(one.select("id"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "drug" in filters
    assert "ReadSchema: struct<id:int>" in plan


def test_missing_partition_value_comes_back_as_null(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "A")], "id int, drug string")
    path = str(tmp_path / "out")
    write_partitioned(df, path, "drug")
    back = {r.id: r.drug for r in read_partitioned(spark, path, df.schema).collect()}
    assert back == {1: None, 2: None, 3: "A"}


def test_static_and_dynamic_overwrite(spark, drugs, tmp_path):
    path = str(tmp_path / "out")
    new = spark.createDataFrame([(1000, "2024")], drugs.schema)
    write_partitioned(drugs, path, "drug")
    write_partitioned(new, path, "drug", overwrite="dynamic")
    assert read_partitioned(spark, path, drugs.schema).count() == 201
    write_partitioned(new, path, "drug")
    assert read_partitioned(spark, path, drugs.schema).count() == 1


def test_layouts(spark, drugs, tmp_path, plan_of):
    direct, rebalanced = str(tmp_path / "direct"), str(tmp_path / "rebalanced")
    write_partitioned(drugs, direct, "drug", layout="direct")
    write_partitioned(drugs, rebalanced, "drug", layout="rebalance")
    schema = drugs.schema
    many = {r.drug: r for r in output_inventory(spark, direct, "drug", schema).collect()}
    few = {r.drug: r for r in output_inventory(spark, rebalanced, "drug", schema).collect()}
    assert {k: r.row_count for k, r in many.items()} == {"2023": 200, "2024": 100}
    assert {k: r.row_count for k, r in few.items()} == {"2023": 200, "2024": 100}
    assert {r.file_count for r in many.values()} == {6}
    assert {r.file_count for r in few.values()} == {1}
    assert many["2023"].file_count == len(list(Path(direct, "drug=2023").glob("*.parquet")))


def test_rebalance_needs_adaptive_execution(spark, drugs, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            write_partitioned(drugs, str(tmp_path / "out"), "drug", layout="rebalance")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rebalance_splits_a_hot_value(spark, tmp_path):
    """One value with nearly all rows must not become one task."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64KB")
    try:
        df = spark.range(0, 200_000, 1, 16).selectExpr(
            "id", "hash(id) AS noise", "if(id % 100 = 0, 'B', 'A') AS drug"
        )
        path = str(tmp_path / "out")
        write_partitioned(df, path, "drug", layout="rebalance")
    finally:
        spark.conf.set(setting, before)
    files = {r.drug: r for r in output_inventory(spark, path, "drug", df.schema).collect()}
    assert files["A"].file_count > 4
    assert files["A"].row_count == 198_000 and files["B"].row_count == 2_000


def test_largest_file(spark, drugs, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned(drugs.coalesce(1), path, "drug", max_records_per_file=50)
    inventory = output_inventory(spark, path, "drug", drugs.schema).collect()
    files = {r.drug: r.file_count for r in inventory}
    assert files == {"2023": 4, "2024": 2}


@pytest.mark.parametrize("option", [{"overwrite": "append"}, {"layout": "other"}])
def test_unknown_options(drugs, tmp_path, option):
    with pytest.raises(ValueError):
        write_partitioned(drugs, str(tmp_path / "out"), "drug", **option)


def test_inventory_of_nothing(spark, drugs, tmp_path):
    with pytest.raises(FileNotFoundError):
        output_inventory(spark, str(tmp_path / "nowhere"), "drug", drugs.schema)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_partitioned_formats(spark, drugs, tmp_path, fmt):
    path = str(tmp_path / "out")
    write_partitioned(drugs, path, "drug", format=fmt)
    back = read_partitioned(spark, path, drugs.schema, format=fmt)
    assert sorted(back.collect()) == sorted(drugs.collect())


def test_csv_has_fixed_order_and_doubled_quotes(spark, tmp_path):
    df = spark.createDataFrame([('say "a, b"', None, 1)], "t string, u string, n int")
    path = str(tmp_path / "out")
    write_validated(df.coalesce(1), path, ["n", "t", "u"])
    lines = next(Path(path).glob("*.csv")).read_text().splitlines()
    assert lines == ["n,t,u", '1,"say ""a, b""",']
    assert tuple(read_text_columns(spark, path).first()) == ("1", 'say "a, b"', None)


def test_csv_keeps_every_field(spark, tmp_path):
    """Blanks at the ends, blanks only, quotes, separators and line breaks, and microseconds."""
    rows = [("T1 ", "2024-01-02 03:04:05.123456"), (" T1", None), ("  ", None), ('a "b", c\nd', None)]
    df = spark.createDataFrame(rows, "trial string, at string").selectExpr(
        "trial", "CAST(at AS timestamp) AS at"
    )
    path = str(tmp_path / "out")
    write_table(df, path, "csv")
    back = read_partitioned(spark, path, df.schema, format="csv", multiLine="true")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_overwrite_of_a_table(spark, tmp_path):
    path = str(tmp_path / "out")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_scratch_lies_in_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch.scratch_dir(spark), scratch.scratch_dir(spark)
    assert one.startswith(base) and one != other


def test_staging_never_overwrites(spark, tmp_path):
    base = tmp_path / "work"
    base.mkdir()
    (base / "mine.txt").write_text("keep")
    one = scratch.staged(spark.range(3), str(base))
    other = scratch.staged(spark.range(5), str(base))
    assert (one.count(), other.count()) == (3, 5)
    assert (base / "mine.txt").read_text() == "keep"


def test_scratch_without_the_setting_lies_in_the_warehouse():
    class Conf:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "/shared/warehouse/"}.get(name, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert scratch.scratch_dir(Session()).startswith("/shared/warehouse/cohortlake-")
    assert scratch.scratch_dir(Session(), "/own").startswith("/own/cohortlake-")


def test_staged_table_is_read_not_recomputed(spark, plan_of):
    df = scratch.staged(spark.range(10).selectExpr("id * 2 AS x"))
    plan = plan_of(df)
    assert "FileScan parquet" in plan and "Range" not in plan
    assert sorted(r.x for r in df.collect()) == list(range(0, 20, 2))
