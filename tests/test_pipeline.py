from __future__ import annotations

import dataclasses
import datetime as dt
import json
import os
import statistics
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.contract import RECORDS, Contract, ContractError, EmptyInputError
from cohortlake.operators import impute_median, ordered, record_measures, split_valid
from cohortlake.operators import cohort_stats as stats_of
from cohortlake.plans import pipeline as pl
from cohortlake.plans.catalog import as_text, run_on_tables
from cohortlake.plans.tables import trial_records
from cohortlake.sinks import write_table
from cohortlake.sources import read_text_columns

SF_DIR = "/root/testdata/sf0.001"
HEADER = ",".join(RECORDS.names)
LINES = [
    "P1,T1,A,S1,100,20,60,2023-01-05,adverse_event,10",
    "P2,T1,A,S2,300,30,85,2023-01-06,active,",
    "P3,T1,B,S1,,forty,,2023-13-01,completed,20",
    "P4,T1,B,S1,99.9,50,59.9,2023-01-08,withdrawn,40",
    ",T1,A,S1,1,1,1,2023-01-05,active,1000",
    "P6,T1,,S1,1,1,1,2023-01-05,active,1000",
    "P7,T1,A,,1,1,1,2023-01-05,active,1000",
]


@pytest.fixture
def config(write, tmp_path):
    def make(text: str = "\n".join([HEADER, *LINES]) + "\n", **options):
        return pl.PipelineConfig(
            input_path=write(text, "in/records.csv"),
            output_path=str(tmp_path / "records"),
            stats_path=str(tmp_path / "stats"),
            run_date="2024-06-01",
            **options,
        )

    return make


def test_metrics(spark, config):
    metrics = pl.run_pipeline(spark, config()).metrics
    assert metrics == {
        "total_records": 7,
        "valid_records": 4,
        "invalid_records": 3,
        "ragged_records": 0,
        "imputed_records": 1,
        "median": 20.0,
        "parse_failures": {
            "dosage_mg": 0, "age": 1, "weight_kg": 0, "enrollment_date": 1, "outcome_score": 0
        },
    }


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_records(spark, config, method):
    made = config(median_method=method, processed_at="2024-06-01 00:00:00")
    result = pl.run_pipeline(spark, made)
    rows = {r.patient_id: r for r in result.records.collect()}
    assert set(rows) == {"P1", "P2", "P3", "P4"}
    assert [rows[f"P{i}"].outcome_score for i in (1, 2, 3, 4)] == [10.0, 20.0, 20.0, 40.0]
    labels = [rows[f"P{i}"].dosage_bucket for i in (1, 2, 3, 4)]
    assert labels == ["medium", "high", None, "low"]
    groups = [rows[f"P{i}"].weight_group for i in (1, 2, 3, 4)]
    assert groups == ["normal", "overweight", None, "underweight"]
    assert rows["P3"].age is None and rows["P3"].enrollment_date is None
    assert {r.processed_at for r in rows.values()} == {dt.datetime(2024, 6, 1)}


def test_stats_and_summary(spark, config, tmp_path):
    result = pl.run_pipeline(spark, config(summary_path=str(tmp_path / "summary")))
    stats = {(r.trial_id, r.drug): tuple(r)[2:] for r in result.stats.collect()}
    assert stats == {
        ("T1", "A"): (2, 200.0, 15.0, 25.0, 2, 1),
        ("T1", "B"): (2, 99.9, 30.0, 50.0, 1, 0),
    }
    summary = json.loads(next((tmp_path / "summary").glob("*.json")).read_text())
    assert summary.pop("parse_failures")["age"] == 1
    assert summary == {
        "pipeline": "cohortlake",
        "run_date": "2024-06-01",
        "total_records_ingested": 7,
        "valid_records": 4,
        "invalid_records": 3,
        "status": "SUCCESS",
        "ragged_records": 0,
        "imputed_records": 1,
        "median": 20.0,
        "extra_columns": [],
        "written_records": 4,
        "output_files": 2,
    }


def test_a_failed_run_says_so(spark, config, tmp_path):
    pl.run_pipeline(spark, config())
    bad = config(HEADER + ",more\n" + LINES[4] + ",x\n", summary_path=str(tmp_path / "summary"))
    with pytest.raises(EmptyInputError):
        pl.run_pipeline(spark, bad)
    summary = json.loads(next((tmp_path / "summary").glob("*.json")).read_text())
    assert summary["status"] == "FAILED" and "no valid records" in summary["error"]
    assert summary["total_records_ingested"] == 1 and summary["extra_columns"] == ["more"]
    gone = dataclasses.replace(bad, input_path=str(tmp_path / "gone"))
    with pytest.raises(FileNotFoundError):
        pl.run_pipeline(spark, gone)
    summary = json.loads(next((tmp_path / "summary").glob("*.json")).read_text())
    assert summary["status"] == "FAILED" and "valid_records" not in summary


def test_output_is_partitioned(spark, config, tmp_path):
    pl.run_pipeline(spark, config())
    assert sorted(p.name for p in (tmp_path / "records").glob("drug=*")) == ["drug=A", "drug=B"]


def test_right_closed_unrounded_csv_run(spark, config, tmp_path):
    """Intervals closed on the right, median as it is, null keys dropped, plain CSV results."""
    result = pl.run_pipeline(
        spark,
        config(
            buckets=pl.RIGHT_CLOSED,
            median_digits=None,
            null_keys="drop",
            output_format="csv",
            stats_format="csv",
        ),
    )
    labels = {r.patient_id: r.dosage_bucket for r in result.records.collect()}
    assert labels == {"P1": "low", "P2": "medium", "P3": None, "P4": "low"}
    text = "".join(p.read_text() for p in sorted((tmp_path / "stats").glob("*.csv")))
    assert text.splitlines()[0].startswith("trial_id,drug,patient_count,avg_dosage_mg")
    assert result.stats.count() == 2


def test_missing_values_in_the_last_range(spark, config):
    result = pl.run_pipeline(spark, config(buckets=pl.LEFT_CLOSED_NULL_LAST))
    row = result.records.where("patient_id = 'P3'").first()
    assert (row.dosage_bucket, row.weight_group) == ("high", "overweight")


def test_command_line(spark, config, tmp_path):
    from cohortlake import __main__ as command

    made = config()
    out, stats, summary = (str(tmp_path / n) for n in ("o", "s", "j"))
    command.main(
        [made.input_path, out, stats, "--summary", summary, "--run-date", "2024-06-01",
         "--ranges", "right", "--digits", "none"],
        spark,
    )
    assert spark.read.parquet(stats).count() == 2
    assert spark.read.json(summary).first().run_date == "2024-06-01"
    labels = {r.patient_id: r.dosage_bucket for r in spark.read.parquet(out).collect()}
    assert labels["P1"] == "low"


@pytest.mark.parametrize(
    "option, field, value",
    [
        (["--work", "/w"], "work_path", "/w"),
        (["--trim"], "trim", True),
        (["--multi-line"], "multi_line", True),
        (["--processed-at", "2024-01-02 03:04:05"], "processed_at", "2024-01-02 03:04:05"),
        (["--error", "0.01"], "median_error", 0.01),
        (["--max-records-per-file", "7"], "max_records_per_file", 7),
        (["--manifest", "/m"], "manifest_path", "/m"),
        (["--overwrite", "dynamic"], "overwrite", "dynamic"),
        (["--publishing", "version"], "publishing", "version"),
        (["--ragged", "reject"], "ragged", "reject"),
        (["--cluster-by", "trial_id", "site"], "cluster_by", ["trial_id", "site"]),
    ],
)
def test_command_line_options(option, field, value):
    from cohortlake import __main__ as command

    plain = command.config_of(command.parser().parse_args(["in", "out", "stats"]))
    made = command.config_of(command.parser().parse_args(["in", "out", "stats", *option]))
    assert getattr(made, field) == value != getattr(plain, field)
    null = ["--null-value", "NA", "--null-value", "-"]
    made = command.config_of(command.parser().parse_args(["in", "out", "stats", *null]))
    assert tuple(made.contract.null_values) == ("NA", "-")


def test_rejected_and_validated_rows_can_be_kept(spark, config, tmp_path):
    valid, invalid = str(tmp_path / "valid"), str(tmp_path / "invalid")
    pl.run_pipeline(spark, config(validated_path=valid, invalid_path=invalid))
    kept = read_text_columns(spark, valid)
    assert kept.columns == RECORDS.names and kept.count() == 4
    assert kept.where("age = 'forty'").count() == 1
    assert read_text_columns(spark, invalid).count() == 3


def test_all_scores_missing(spark, config):
    lines = [line.rsplit(",", 1)[0] + "," for line in LINES]
    result = pl.run_pipeline(spark, config("\n".join([HEADER, *lines]) + "\n"))
    assert result.metrics["median"] is None and result.metrics["imputed_records"] == 4
    assert result.records.where("outcome_score IS NOT NULL").count() == 0
    assert {r.avg_outcome_score for r in result.stats.collect()} == {None}


@pytest.mark.parametrize(
    "text, error",
    [
        ("", EmptyInputError),
        (HEADER + "\n", EmptyInputError),
        (HEADER + "\n" + LINES[4] + "\n", EmptyInputError),
        ("patient_id,drug\nP1,A\n", ContractError),
    ],
)
def test_bad_input_leaves_earlier_results_alone(spark, config, text, error):
    pl.run_pipeline(spark, config())
    bad = config(text)
    with pytest.raises(error):
        pl.run_pipeline(spark, bad)
    assert spark.read.parquet(bad.output_path).count() == 4
    assert spark.read.parquet(bad.stats_path).count() == 2


def test_missing_input(spark, tmp_path):
    config = pl.PipelineConfig(str(tmp_path / "no.csv"), str(tmp_path / "a"), str(tmp_path / "b"))
    with pytest.raises(FileNotFoundError):
        pl.run_pipeline(spark, config)


@pytest.mark.parametrize(
    "paths",
    [
        ("/d/in", "/d/in", "/d/stats"),
        ("/d/in", "/d/out", "/d/out/"),
        ("/d/in/x.csv", "/d/in", "/d/stats"),
        ("file:///d/in", "/d/in/out", "/d/stats"),
        (["/d/one", "/d/two"], "/d/two", "/d/stats"),
        ("/d/lake/*/part.csv", "/d/lake/raw", "/d/stats"),
        ("/d/in", "/d//in/x", "/d/stats"),
        ("/d/in", "/d/other/../in", "/d/stats"),
        ("in", f"{os.getcwd()}/in/out", "/d/stats"),
        ("/d/in/2024-{01,02}/", "/d/in/2023", "/d/stats"),
    ],
)
def test_overlapping_paths(spark, paths):
    with pytest.raises(ValueError, match="overlap"):
        pl.check_paths(spark, pl.PipelineConfig(*paths))


def test_paths_with_a_common_start_do_not_overlap(spark):
    pl.check_paths(spark, pl.PipelineConfig("/d/in", "/d/in2", "/d/in3"))
    pl.check_paths(spark, pl.PipelineConfig("/d/in/*.csv", "/d/in2", "/d/in3"))


def test_changed_input_is_noticed(spark, config, monkeypatch):
    pl.run_pipeline(spark, config())
    metrics = pl.source_metrics
    monkeypatch.setattr(pl, "source_metrics", lambda *a: {**metrics(*a), "valid_records": 5})
    changed = config(f"{HEADER}\n" + "\n".join(LINES).replace("P4", "P9") + "\n")
    with pytest.raises(RuntimeError, match="4 records written, 4 in the files, 5 valid ones read"):
        pl.run_pipeline(spark, changed)
    kept = {r.patient_id for r in spark.read.parquet(changed.output_path).collect()}
    assert kept == {"P1", "P2", "P3", "P4"}
    assert spark.read.parquet(changed.stats_path).agg(F.sum("patient_count")).first()[0] == 4


@pytest.mark.parametrize("layout", ["direct", "rebalance"])
def test_run_equals_the_operators_one_by_one(spark, layout):
    result = run_on_tables(spark, SF_DIR, layout=layout)
    valid, invalid = split_valid(trial_records(spark, SF_DIR), RECORDS.critical)
    expected = ordered(stats_of(impute_median(valid, "outcome_score"))).collect()
    assert ordered(result.stats).collect() == expected
    assert result.metrics["invalid_records"] == invalid.count()
    scores = [r.outcome_score for r in valid.collect() if r.outcome_score is not None]
    assert result.metrics["median"] == statistics.median(scores)
    assert result.records.where("outcome_score IS NULL").count() == 0


def test_approx_run_is_within_the_rank_error(spark):
    result = run_on_tables(spark, SF_DIR, median_method="approx", median_error=0.01)
    valid, _ = split_valid(trial_records(spark, SF_DIR), RECORDS.critical)
    scores = valid.where("outcome_score IS NOT NULL")
    n, found = scores.count(), result.metrics["median"]
    assert scores.where(F.col("outcome_score") < found).count() <= 0.51 * n
    assert scores.where(F.col("outcome_score") <= found).count() >= 0.49 * n


def test_shape_of_the_statistics(spark):
    """Five trials by three drugs, every valid record counted once."""
    result = run_on_tables(spark, SF_DIR)
    rows = result.stats.collect()
    assert result.stats.columns == ["trial_id", "drug", *record_measures()]
    assert len(rows) == 15
    assert sum(r.patient_count for r in rows) == result.metrics["valid_records"]
    events = result.records.where("status = 'adverse_event'").count()
    assert sum(r.adverse_events for r in rows) == events


@pytest.mark.parametrize("method", ["exact", "approx"])
@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_source_is_read_twice(spark, tmp_path, monkeypatch, method, format):
    """Once for the metrics and once for the write, apart from the header, with all outputs."""
    source = str(tmp_path / "in")
    write_table(as_text(trial_records(spark, SF_DIR)), source, "csv")
    reads = spark.sparkContext.accumulator(0)
    rows = read_text_columns(spark, source).count()
    config = pl.PipelineConfig(
        source,
        str(tmp_path / "records"),
        str(tmp_path / "stats"),
        validated_path=str(tmp_path / "valid"),
        invalid_path=str(tmp_path / "invalid"),
        work_path=str(tmp_path / "work"),
        median_method=method,
        output_format=format,
    )
    original = pl.raw_records

    def counted(*args):
        df = original(*args)

        def pass_on(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch

        return df.mapInArrow(pass_on, df.schema)

    monkeypatch.setattr(pl, "raw_records", counted)
    pl.run_pipeline(spark, config)
    left = {p.name for p in tmp_path.iterdir()} - {"work"}
    assert left == {"in", "records", "stats", "valid", "invalid"}
    assert not list((tmp_path / "work").glob("*"))
    assert rows > 1000
    assert reads.value == 2 * rows


def test_statistics_read_only_their_columns(spark, config, plan_of):
    result = pl.run_pipeline(spark, config())
    plan = plan_of(stats_of(result.records))
    scan = plan.split("FileScan parquet [")[1].split("]")[0]
    assert {c.split("#")[0] for c in scan.split(",")} == {
        "patient_id", "trial_id", "drug", "site", "dosage_mg", "age", "status", "outcome_score"
    }


def test_files_on_disk(spark, config, tmp_path):
    result = pl.run_pipeline(spark, config())
    assert (Path(tmp_path) / "records" / "_SUCCESS").exists()
    assert result.records.count() == 4


def test_own_contract(spark, write, tmp_path):
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("day", T.DateType()),
            T.StructField("points", T.LongType()),
        ]
    )
    contract = Contract(schema, ("id", "points"), "id", "dd.MM.yyyy", null_values=("-",))
    text = "points;id;day\n4;a;05.01.2023\n-;b;05.01.2023\nx;-;2023-01-05\n9;c;-\n"
    config = pl.PipelineConfig(
        write(text, "own/in.csv"),
        str(tmp_path / "records"),
        str(tmp_path / "stats"),
        contract=contract,
        read_options={"sep": ";"},
        measure="points",
        buckets=(),
        partition_by="day",
        keys=("day",),
        measures={"points": F.sum("points")},
    )
    result = pl.run_pipeline(spark, config)
    assert result.metrics["parse_failures"] == {"day": 1, "points": 1}
    assert (result.metrics["total_records"], result.metrics["valid_records"]) == (4, 2)
    assert [tuple(r) for r in result.stats.collect()] == [(None, 9.0), (dt.date(2023, 1, 5), 4.0)]


def test_measure_must_be_numeric(spark, write):
    raw = read_text_columns(spark, write("id,score\n1,x\n"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "score")])
    with pytest.raises(ContractError, match="numeric"):
        pl.source_metrics(raw, Contract(schema, ("id",), "id"), "score")


def test_metrics_row_without_parsed_columns(spark):
    names = [f.name for f in pl.METRICS]
    row = pl.metrics_row(spark, dict(zip(names, [1, 1, 0, 0, 1, None, {}]))).first()
    assert tuple(row) == (1, 1, 0, 0, 1, None, {})


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_source_is_parsed_once_without_outputs_of_its_text(spark, write, tmp_path, monkeypatch, format):
    lines = [
        "p1,t,A,s,10,30,60.5,2024-01-05,active,4",
        "p2,t,B,s,NaN,3x,61,2024-1-5,active,NaN",
        ",t,B,s,1,31,62,2024-01-06,active,9",
        "p4,u,A,s,,32,,,completed,",
    ]
    source = write("\n".join([",".join(RECORDS.names), *lines]) + "\n", "once/in.csv")
    reads = spark.sparkContext.accumulator(0)
    original = pl.raw_records

    def counted(*args):
        df = original(*args)

        def pass_on(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch

        return df.mapInArrow(pass_on, df.schema)

    monkeypatch.setattr(pl, "raw_records", counted)
    config = pl.PipelineConfig(
        source, str(tmp_path / "records"), str(tmp_path / "stats"), output_format=format,
        work_path=str(tmp_path / "work"),
    )
    result = pl.run_pipeline(spark, config)
    assert reads.value == len(lines)
    assert not list((tmp_path / "work").glob("*"))
    assert result.metrics["parse_failures"] == {
        "dosage_mg": 0, "age": 1, "weight_kg": 0, "enrollment_date": 1, "outcome_score": 0
    }
    names = ("patient_id", "dosage_mg", "age", "weight_kg", "enrollment_date", "outcome_score")
    rows = result.records.orderBy("patient_id").select(*names).collect()
    assert [tuple(r) for r in rows] == [
        ("p1", 10.0, 30, 60.5, dt.date(2024, 1, 5), 4.0),
        ("p2", None, None, 61.0, None, 4.0),
        ("p4", None, 32, None, None, 4.0),
    ]
