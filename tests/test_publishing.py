"""Partial runs, versioned tables, and what is left of runs that fail midway."""

from __future__ import annotations

import dataclasses
import subprocess
import sys
import textwrap
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortlake import scratch, sinks, sources, versions
from cohortlake.contract import RECORDS
from cohortlake.plans import pipeline as pl

HEADER = ",".join(RECORDS.names)
FIRST = [
    "P1,T1,A,S1,100,20,60,2023-01-05,adverse_event,10",
    "P2,T1,A,S2,300,30,85,2023-01-06,active,20",
    "P3,T1,B,S1,50,40,70,2023-01-07,completed,30",
    "P4,T2,C,S3,50,40,70,2023-01-07,completed,30",
]
LATER = [
    "P5,T1,A,S1,100,50,60,2023-02-05,active,10",
    "P6,T3,D,S1,100,60,60,2023-02-05,active,10",
]


@pytest.fixture
def config(write, tmp_path):
    def make(lines, name="records.csv", **options):
        return pl.PipelineConfig(
            input_path=write("\n".join([HEADER, *lines]) + "\n", f"in/{name}"),
            output_path=str(tmp_path / "out"),
            stats_path=str(tmp_path / "stats"),
            validated_path=str(tmp_path / "valid"),
            run_date="2024-06-01",
            **options,
        )

    return make


def patients(result):
    return {r.patient_id for r in result.records.collect()}


def cohorts(result):
    return {(r.trial_id, r.drug): r.patient_count for r in result.stats.collect()}


def files(folder, pattern):
    return {(p, p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(folder).glob(pattern)}


@pytest.mark.parametrize("publishing", pl.PUBLISHING)
def test_a_partial_run_leaves_other_partitions_alone(spark, config, publishing):
    earlier = config(FIRST, publishing=publishing)
    pl.run_pipeline(spark, earlier)
    untouched = {p for drug in "BC" for p in files(earlier.output_path, f"**/drug={drug}/*.parquet")}
    made = config(LATER, "later.csv", overwrite="dynamic", publishing=publishing)
    result = pl.run_pipeline(spark, made)
    assert patients(result) == {"P3", "P4", "P5", "P6"}
    assert cohorts(result) == {("T1", "A"): 1, ("T1", "B"): 1, ("T2", "C"): 1, ("T3", "D"): 1}
    assert untouched and untouched <= files(made.output_path, "**/*.parquet")
    assert sources.read_text_columns(spark, path_of(spark, made.validated_path)).count() == 2
    assert not [p.name for p in Path(made.output_path).parent.iterdir() if "-" in p.name]


def path_of(spark, path):
    version = versions.current(spark, path)
    return version.paths(path)[0] if version else path


@pytest.mark.parametrize("publishing", pl.PUBLISHING)
@pytest.mark.parametrize("overwrite", pl.OVERWRITE)
def test_a_run_that_fails_midway_is_taken_back(spark, config, monkeypatch, publishing, overwrite):
    """The records are in place already when the statistics can't be put there."""
    before = pl.run_pipeline(spark, config(FIRST, publishing=publishing))
    made = config(LATER, "later.csv", overwrite=overwrite, publishing=publishing)
    kept, wanted = patients(before), cohorts(before)
    if publishing == "version":
        original = versions.commit

        def commit(session, path, *rest):
            if path == made.stats_path:
                raise OSError("no")
            return original(session, path, *rest)

        monkeypatch.setattr(versions, "commit", commit)
    else:
        original = scratch._rename

        def rename(session, path, to):
            if to == made.stats_path and "stats-" in path and not failed:
                failed.append(1)
                raise OSError("no")
            return original(session, path, to)

        failed = []
        monkeypatch.setattr(scratch, "_rename", rename)
    with pytest.raises(OSError, match="no"):
        pl.run_pipeline(spark, made)
    records = sources.read_partitioned(spark, made.output_path, before.records.schema)
    stats = sources.read_partitioned(spark, made.stats_path, before.stats.schema)
    assert {r.patient_id for r in records.collect()} == kept
    assert {(r.trial_id, r.drug): r.patient_count for r in stats.collect()} == wanted
    assert sorted(p.name for p in Path(made.output_path).parent.iterdir()) == ["in", "out", "stats", "valid"]


def test_a_partial_run_of_an_empty_place(spark, config):
    result = pl.run_pipeline(spark, config(LATER, overwrite="dynamic"))
    assert patients(result) == {"P5", "P6"} and len(cohorts(result)) == 2


def test_statistics_that_are_missing_are_made_from_the_records(spark, config, tmp_path):
    pl.run_pipeline(spark, config(FIRST))
    made = config(LATER, "later.csv", overwrite="dynamic")
    made = dataclasses.replace(made, stats_path=str(tmp_path / "other"))
    assert cohorts(pl.run_pipeline(spark, made)) == {
        ("T1", "A"): 1, ("T1", "B"): 1, ("T2", "C"): 1, ("T3", "D"): 1
    }


def test_publishing_versions_renames_nothing(spark, config, monkeypatch):
    names = []
    original = scratch.hadoop_path

    def watched(session, path):
        system, made = original(session, path)

        class Watch:
            def __getattr__(self, name):
                names.append(name)
                return getattr(system, name)

        return Watch(), made

    for module in (scratch, versions):
        monkeypatch.setattr(module, "hadoop_path", watched)
    pl.run_pipeline(spark, config(FIRST, publishing="version"))
    pl.run_pipeline(spark, config(LATER, "later.csv", overwrite="dynamic", publishing="version"))
    assert "create" in names and "rename" not in names
    names.clear()
    pl.run_pipeline(spark, config(FIRST))
    assert "rename" in names


@pytest.mark.parametrize(
    "options", [{"overwrite": "all"}, {"publishing": "copy"}, {"ragged": "guess"}, {"layout": "x"}]
)
def test_unknown_options(spark, config, options):
    with pytest.raises(ValueError, match=next(iter(options))):
        pl.run_pipeline(spark, config(FIRST, **options))


def test_a_partial_run_needs_the_partition_among_the_keys(spark, config):
    with pytest.raises(ValueError, match="keys"):
        pl.run_pipeline(spark, config(FIRST, overwrite="dynamic", keys=("trial_id",)))


def test_partitions_are_not_renamed_into_a_versioned_table(spark, config):
    before = pl.run_pipeline(spark, config(FIRST, publishing="version"))
    with pytest.raises(ValueError, match="versioned"):
        pl.run_pipeline(spark, config(LATER, "later.csv", overwrite="dynamic"))
    assert patients(before) == {"P1", "P2", "P3", "P4"}


# --- versioned tables ---------------------------------------------------------------------------


@pytest.fixture
def numbers(spark):
    return spark.range(12).select(F.col("id"), (F.col("id") % 3).cast("string").alias("part"))


def ids(spark, path, df, **options):
    return sorted(r.id for r in sources.read_partitioned(spark, path, df.schema, **options).collect())


def test_versions_one_after_the_other(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_versioned(numbers, path, "part")
    sinks.write_versioned(numbers.where("part = '1'").withColumn("id", F.col("id") + 100), path, "part", "dynamic")
    assert ids(spark, path, numbers) == [0, 2, 3, 5, 6, 8, 9, 11, 101, 104, 107, 110]
    assert ids(spark, path, numbers, version=1) == list(range(12))
    assert ids(spark, path, numbers, where={"part": "1"}) == [101, 104, 107, 110]
    assert [v.number for v in versions.history(spark, path)] == [2, 1]
    assert versions.restore(spark, path, 1).number == 3
    assert ids(spark, path, numbers) == list(range(12))
    assert versions.expire(spark, path) == 1
    assert ids(spark, path, numbers) == list(range(12))
    with pytest.raises(LookupError):
        ids(spark, path, numbers, version=1)
    with pytest.raises(LookupError):
        versions.restore(spark, path, 2)
    with pytest.raises(ValueError):
        versions.expire(spark, path, 0)


def test_a_restriction_prunes_folders_of_a_version(spark, numbers, tmp_path, plan_of):
    path = str(tmp_path / "t")
    sinks.write_versioned(numbers, path, "part")
    plan = plan_of(sources.read_partitioned(spark, path, numbers.schema, {"part": "2"}), "formatted")
    assert "PartitionFilters" in plan and "part" in plan.split("PartitionFilters")[1][:120]


def test_a_cut_short_version_is_not_seen(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    made = sinks.write_versioned(numbers, path, "part")
    whole = Path(versions._file(path, made.number)).read_text()
    for end in (0, 1, len(whole) // 2, len(whole) - 1):
        Path(versions._file(path, 2)).write_text(whole[:end])
        assert versions.current(spark, path) == made
    assert sinks.write_versioned(numbers, path, "part").number == 3


def test_partitions_with_odd_names(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a/b"), (2, "x=y"), (3, None), (4, "50%"), (5, "{q}*"), (6, "é ü"), (7, "2023")]
    df = spark.createDataFrame(rows, "id long, part string")
    sinks.write_versioned(df, path, "part")
    sinks.write_versioned(df.where("id = 5"), path, "part", "dynamic")
    read = sources.read_partitioned(spark, path, df.schema)
    assert sorted(map(tuple, read.collect())) == rows


def test_tables_without_partitions_and_without_rows(spark, numbers, tmp_path):
    plain, empty = str(tmp_path / "p"), str(tmp_path / "e")
    sinks.write_versioned(numbers, plain)
    sinks.write_versioned(numbers.where("id < 3"), plain)
    assert ids(spark, plain, numbers) == [0, 1, 2]
    with pytest.raises(ValueError, match="partitioned"):
        sinks.write_versioned(numbers, plain, overwrite="dynamic")
    sinks.write_versioned(numbers.where("false"), empty, "part")
    assert ids(spark, empty, numbers) == []
    sinks.write_versioned(numbers, empty, ["part"], "dynamic", layout="rebalance")
    assert ids(spark, empty, numbers) == list(range(12))


def test_two_partition_columns(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    df = numbers.withColumn("half", (F.col("id") % 2).cast("int"))
    sinks.write_versioned(df, path, ["part", "half"])
    one = df.where("part = '1' AND half = 0").withColumn("id", F.col("id") + 50)
    sinks.write_versioned(one, path, ["part", "half"], "dynamic")
    assert ids(spark, path, df) == sorted([i for i in range(12) if i not in (4, 10)] + [54, 60])


def test_writers_at_the_same_time_lose_nothing(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_versioned(numbers, path, "part")
    errors = []

    def replace(part):
        try:
            later = numbers.where(F.col("part") == part).withColumn("id", F.col("id") + 100)
            sinks.write_versioned(later, path, "part", "dynamic")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=replace, args=(p,)) for p in "012"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    assert ids(spark, path, numbers) == [100 + i for i in range(12)]
    assert versions.current(spark, path).number == 4


def test_a_failed_write_leaves_no_folder(spark, numbers, tmp_path):
    path = tmp_path / "t"
    with pytest.raises(Exception, match="nope"):
        bad = numbers.withColumn("id", F.raise_error(F.lit("nope")).cast("long"))
        sinks.write_versioned(bad, str(path), "part")
    assert not list(path.glob("*"))


# --- counts, files and row groups ---------------------------------------------------------------


def test_written_rows_are_counted_once_when_tasks_are_repeated(tmp_path):
    """Every task of the write fails at first, after it has passed on rows."""
    code = f"""
    import sys
    sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from cohortlake import sinks, sources
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "1g").getOrCreate())

    def once(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    df = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 3).cast("string").alias("part"))
    df = df.mapInArrow(once, df.schema)
    for layout in ("direct", "rebalance"):
        path = {str(tmp_path)!r} + "/" + layout
        seen = sinks.write_partitioned(df, path, "part", layout=layout, observe={{"rows": F.count(F.lit(1))}})
        files = sources.file_manifest(spark, path, df.schema, "part")
        assert seen == {{"rows": 1000}} == {{"rows": files.agg(F.sum("rows")).first()[0]}}, seen
    print("agreed")
    """
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300
    )
    assert "agreed" in done.stdout, done.stderr[-3000:]


def test_footers_answer_ranges_without_reading_pages(spark, numbers, tmp_path, plan_of):
    path = str(tmp_path / "t")
    sinks.write_partitioned(numbers, path, "part")
    found = sources.footer_ranges(spark, path, "part", numbers.schema, ["id"])
    assert "PushedAggregation: [MIN(id), MAX(id)]" in plan_of(found, "formatted")
    assert {tuple(r) for r in found.collect()} == {("0", 0, 9), ("1", 1, 10), ("2", 2, 11)}


def test_inventory_is_the_manifest_of_a_table(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    rows = numbers.union(spark.createDataFrame([(50, None)], numbers.schema))
    sinks.write_versioned(rows.repartition(2, "id"), path, "part")
    found = sources.output_inventory(spark, path, "part", rows.schema, ["id"])
    sinks.write_table(found, str(tmp_path / "m"))
    kept = {r.part: r for r in sources.read_partitioned(spark, str(tmp_path / "m"), found.schema).collect()}
    assert set(kept) == {"0", "1", "2", None}
    assert (kept[None].file_count, kept[None].row_count, kept[None].min_id) == (1, 1, 50)
    sizes = sum(p.stat().st_size for p in (tmp_path / "t").glob("**/*.parquet"))
    assert sum(r.byte_count for r in kept.values()) == sizes
    assert sum(r.file_count for r in kept.values()) == len(list((tmp_path / "t").glob("**/*.parquet")))


def test_clustered_files_skip_row_groups(spark, tmp_path):
    """The scan of one trial reads fewer rows from files that are sorted by trial."""
    trial = F.pmod(F.xxhash64("id"), F.lit(50)).alias("trial")
    rows = spark.range(0, 60_000, 1, 1).select("id", F.lit("A").alias("drug"), trial)
    read = {}
    spark.conf.set("parquet.block.size", 64 << 10)
    try:
        for name, cluster in (("plain", ()), ("sorted", ["trial"])):
            path = str(tmp_path / name)
            sinks.write_partitioned(rows, path, "drug", cluster_by=cluster)
            wanted = sources.read_partitioned(spark, path, rows.schema, {"drug": "A", "trial": 7})
            assert wanted.count() == rows.where("trial = 7").count()
            read[name] = rows_scanned(wanted)
    finally:
        spark.conf.unset("parquet.block.size")
    assert read["plain"] == 60_000 and read["sorted"] < 20_000


def rows_scanned(df):
    """The scan's own count of rows, from the metrics of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, scans = [plan], []
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            scans.append(node)
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    (scan,) = scans
    return scan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("publishing", pl.PUBLISHING)
def test_partial_runs_of_csv_results(spark, config, publishing):
    """Line breaks in fields, one file format for all outputs, versions or renamed folders."""
    formats = {"output_format": "csv", "stats_format": "csv", "multi_line": True}
    odd = '"P,9\n""x""",T1,A,S1,100,20,60,2023-01-05,active,10'
    pl.run_pipeline(spark, config(FIRST, publishing=publishing, **formats))
    made = config([odd], "later.csv", overwrite="dynamic", publishing=publishing, **formats)
    result = pl.run_pipeline(spark, made)
    assert patients(result) == {"P3", "P4", 'P,9\n"x"'}
    assert cohorts(result) == {("T1", "A"): 1, ("T1", "B"): 1, ("T2", "C"): 1}


def test_many_partial_runs_one_after_the_other(spark, config):
    """A day at a time, each with its own partitions; the table is the last word of each."""
    for day in range(4):
        lines = [f"P{day}{k},T1,D{(day + k) % 3},S1,{day},2{k},60,2023-01-05,active,10" for k in range(2)]
        made = config(lines, f"day{day}.csv", overwrite="dynamic", publishing="version")
        result = pl.run_pipeline(spark, made)
    # days 0 to 3 write D0 D1, D1 D2, D2 D0, D0 D1
    assert patients(result) == {"P30", "P31", "P20"}
    assert cohorts(result) == {("T1", "D0"): 1, ("T1", "D1"): 1, ("T1", "D2"): 1}
    assert [v.number for v in versions.history(spark, made.output_path)] == [4, 3, 2, 1]
    assert versions.expire(spark, made.output_path, keep=2) == 3
    assert sources.read_partitioned(spark, made.output_path, result.records.schema).count() == 3


def test_ragged_rows_in_a_run(spark, config, tmp_path):
    lines = [*FIRST, "P7,T1,B,S1,50", "P8,T1,B,S1,50,40,70,2023-01-07,completed,30,more"]
    made = config(lines, summary_path=str(tmp_path / "summary"))
    kept = pl.run_pipeline(spark, made)
    assert patients(kept) == {"P1", "P2", "P3", "P4", "P7", "P8"}
    assert kept.metrics["ragged_records"] == 2
    strict = dataclasses.replace(made, ragged="reject", invalid_path=str(tmp_path / "invalid"))
    result = pl.run_pipeline(spark, strict)
    assert patients(result) == {"P1", "P2", "P3", "P4"}
    summary = sources.read_partitioned(spark, made.summary_path, result.summary.schema, format="json").first()
    assert (summary.ragged_records, summary.invalid_records, summary.written_records) == (2, 2, 4)
    assert sources.read_text_columns(spark, strict.invalid_path).count() == 2


def test_a_run_over_files_with_two_headers(spark, config, write, tmp_path):
    """One header is taken for all at first; the run finds out and starts again."""
    made = config(FIRST)
    names = HEADER.split(",")
    other = ",".join(reversed(names))
    row = ",".join(reversed("P9,T9,A,S9,1,2,3,2023-01-05,active,4".split(",")))
    write(f"{other}\n{row}\n", "in/second.csv")
    write(f"{HEADER},more\nP8,T9,A,S9,1,2,3,2023-01-05,active,4,x\n", "in/third.csv")
    made = dataclasses.replace(made, input_path=str(tmp_path / "in"), summary_path=str(tmp_path / "summary"))
    result = pl.run_pipeline(spark, made)
    assert patients(result) == {"P1", "P2", "P3", "P4", "P8", "P9"}
    assert result.summary.first().extra_columns == ["more"]


@pytest.mark.parametrize("publishing", pl.PUBLISHING)
def test_a_run_keeps_the_manifest_of_its_records(spark, config, tmp_path, publishing):
    options = {"manifest_path": str(tmp_path / "manifest"), "publishing": publishing}

    def manifest(result):
        schema = pl.manifest_of(spark, made, made.output_path, result.records.schema).schema
        rows = sources.read_partitioned(spark, made.manifest_path, schema).collect()
        assert len({r.drug for r in rows}) == len(rows)
        return {r.drug: (r.file_count, r.row_count, r.min_age, r.max_age, str(r.max_enrollment_date)) for r in rows}

    made = config(FIRST, **options)
    assert manifest(pl.run_pipeline(spark, made)) == {
        "A": (1, 2, 20, 30, "2023-01-06"), "B": (1, 1, 40, 40, "2023-01-07"), "C": (1, 1, 40, 40, "2023-01-07")
    }
    made = config(LATER, "later.csv", overwrite="dynamic", **options)
    after = manifest(pl.run_pipeline(spark, made))
    assert after == {
        "A": (1, 1, 50, 50, "2023-02-05"), "B": (1, 1, 40, 40, "2023-01-07"),
        "C": (1, 1, 40, 40, "2023-01-07"), "D": (1, 1, 60, 60, "2023-02-05"),
    }
    made = dataclasses.replace(made, manifest_path=str(tmp_path / "other"))
    assert manifest(pl.run_pipeline(spark, made)) == after


def test_a_manifest_needs_footers(spark, config, tmp_path):
    with pytest.raises(ValueError, match="footers"):
        pl.run_pipeline(spark, config(FIRST, manifest_path=str(tmp_path / "m"), output_format="csv"))
