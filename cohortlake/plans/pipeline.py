"""From raw record files to the partitioned table, its cohort statistics and a run summary.

The source is parsed twice: once for all metrics and the median, once for the write; or only once, if
no text of it is to be written and the median is exact. Statistics read only their columns of the written table. Everything is written to new folders, checked, and
then put in the place of what was there.
"""

from __future__ import annotations

import itertools
import posixpath
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import versions
from cohortlake.contract import (
    DOSAGE_EDGES,
    DOSAGE_LABELS,
    RECORDS,
    WEIGHT_EDGES,
    WEIGHT_LABELS,
    Contract,
    ContractError,
    EmptyInputError,
)
from cohortlake.functions.columns import (
    column,
    is_valid,
    no_nan,
    parse_failed,
    parsed,
    typed,
    without_nan,
)
from cohortlake.operators.features import bucketize, stamp
from cohortlake.operators.imputation import (
    bucket_totals,
    exact_median,
    fill_measure,
    magnitude,
    near_median,
)
from cohortlake.operators.quality import apply_contract, check_columns
from cohortlake.operators.stats import (
    COHORT_KEYS,
    NULL_KEYS,
    cohort_stats,
    ordered,
    record_measures,
)
from cohortlake.scratch import Publication, beside, discard, scratch_dir, staged, temporary
from cohortlake.sinks.tables import LAYOUTS, write_partitioned, write_table, write_validated
from cohortlake.sources.records import RAGGED, header_differs, raw_records, read_frames
from cohortlake.sources.tables import file_manifest, output_inventory, read_partitioned

OVERWRITE = ("static", "dynamic")
PUBLISHING = ("rename", "version")
RAGGED_ROWS = ("keep", "reject")


@dataclass(frozen=True)
class BucketRule:
    """A range label to add; the options are those of ``bucketize``."""

    col: str
    edges: Sequence[float]
    labels: Sequence[str]
    output: str
    closed: str = "left"
    lower: float | None = None
    null_label: str | None = None

    def add(self, df: DataFrame) -> DataFrame:
        return bucketize(
            df,
            self.col,
            self.edges,
            self.labels,
            self.output,
            self.closed,
            self.lower,
            self.null_label,
        )


DOSAGE_BUCKET = BucketRule("dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "dosage_bucket")
WEIGHT_GROUP = BucketRule("weight_kg", WEIGHT_EDGES, WEIGHT_LABELS, "weight_group")

# An edge belongs to the range above it; missing values get no label.
LEFT_CLOSED = (DOSAGE_BUCKET, WEIGHT_GROUP)
# The same, but missing values get the last label.
LEFT_CLOSED_NULL_LAST = tuple(replace(r, null_label=r.labels[-1]) for r in LEFT_CLOSED)
# An edge belongs to the range below it; zero, negative and missing values get no label.
RIGHT_CLOSED = tuple(replace(r, closed="right", lower=0) for r in LEFT_CLOSED)


@dataclass(frozen=True)
class PipelineConfig:
    """What to read, what to make of it and where to put it.

    ``validated_path`` (valid rows as CSV), ``invalid_path`` (rejected rows as CSV) and ``manifest_path``
    (files, rows, bytes and ranges of numbers and dates per partition of the records, from the footers of their
    Parquet files) are optional outputs. With one of the first two the second pass over the source
    stages its text as a columnar table, valid rows apart, and all outputs and the statistics are
    made from that. Without them, and with the exact median, the first pass stages the typed rows beside what it
    counts, and there is no second one. Staged tables lie in a new folder under ``work_path``, or else under
    ``spark.checkpoint.dir``, until the run ends.

    ``overwrite="dynamic"`` is a partial run, such as one day's: it replaces the partitions that occur in
    its valid records, and the cohorts of those partitions in the statistics, and leaves all others as they
    are, file by file. The partition column must then be one of the ``keys``. Validated and rejected
    rows are always those of the run.

    ``publishing="rename"`` puts finished folders in place by renaming. ``"version"`` makes every output a
    versioned table (``cohortlake.versions``): a run adds one small file per output, and nothing is moved.

    ``ragged`` says what becomes of rows with more or fewer fields than the header. They are counted in any
    case; ``"keep"`` cuts them or fills them with nulls, ``"reject"`` makes them invalid.

    ``cluster_by`` sorts the records of every file, see ``write_partitioned``.

    ``median_method="approx"`` is off by no more than ``median_error`` in rank and stages no column;
    both methods are reproducible.
    """

    input_path: str | list[str]
    output_path: str
    stats_path: str
    summary_path: str | None = None
    validated_path: str | None = None
    invalid_path: str | None = None
    manifest_path: str | None = None
    work_path: str | None = None
    contract: Contract = RECORDS
    trim: bool = False
    multi_line: bool = False
    read_options: Mapping[str, str] = field(default_factory=dict)
    measure: str = "outcome_score"
    median_method: str = "exact"
    median_error: float = 0.0025
    median_digits: int | None = 2
    buckets: Sequence[BucketRule] = LEFT_CLOSED
    processed_at: datetime | str | None = None
    partition_by: str = "drug"
    layout: str = "rebalance"
    max_records_per_file: int | None = None
    cluster_by: Sequence[str] = ()
    overwrite: str = "static"
    publishing: str = "rename"
    ragged: str = "keep"
    output_format: str = "parquet"
    stats_format: str = "parquet"
    keys: Sequence[str] = COHORT_KEYS
    measures: Mapping[str, Column] | None = None
    null_keys: str = "keep"
    name: str = "cohortlake"
    run_date: str = field(default_factory=lambda: datetime.now(timezone.utc).date().isoformat())

    def paths(self) -> list[str]:
        """All paths, inputs first."""
        inputs = [self.input_path] if isinstance(self.input_path, str) else list(self.input_path)
        outputs = [
            self.output_path,
            self.stats_path,
            self.summary_path,
            self.validated_path,
            self.invalid_path,
            self.manifest_path,
            self.work_path,
        ]
        return inputs + [p for p in outputs if p]


@dataclass(frozen=True)
class PipelineResult:
    """The written tables, read lazily, and the metrics of the run."""

    records: DataFrame
    stats: DataFrame
    summary: DataFrame
    metrics: dict[str, object]
    summary_path: str | None = None


def located(spark: SparkSession, path: str) -> tuple[str, str]:
    """The store and the absolute folder of a path as Hadoop sees it, with ``..`` and double slashes
    resolved; of a pattern, the folder that all its matches are in."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = made.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(made).toUri()
    parts = posixpath.normpath(uri.getPath()).split("/")
    fixed = itertools.takewhile(lambda part: not set("*?[{") & set(part), parts)
    scheme = re.sub("^s3[an]$", "s3", uri.getScheme() or "")
    return f"{scheme}://{uri.getAuthority() or ''}", "/".join(fixed).rstrip("/") + "/"


def check_paths(spark: SparkSession, config: PipelineConfig) -> None:
    """No path may equal or contain another one: an overwrite would destroy it."""
    found = [(path, *located(spark, path)) for path in config.paths()]
    for i, (one, store, folder) in enumerate(found):
        for other, other_store, other_folder in found[i + 1 :]:
            near = folder.startswith(other_folder) or other_folder.startswith(folder)
            if store == other_store and near:
                raise ValueError(f"paths overlap: {one} and {other}")


# One row of run metrics.
METRICS = T.StructType(
    [
        T.StructField("total_records", T.LongType()),
        T.StructField("valid_records", T.LongType()),
        T.StructField("invalid_records", T.LongType()),
        T.StructField("ragged_records", T.LongType()),
        T.StructField("imputed_records", T.LongType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("parse_failures", T.MapType(T.StringType(), T.LongType())),
    ]
)


def valid_row(raw: DataFrame, contract: Contract, trim: bool, ragged: str) -> Column:
    """Whether a row of the source has all critical fields, and if need be as many as the header."""
    valid = is_valid(raw.schema, contract.critical, contract.null_values, trim)
    return valid & F.col(RAGGED).isNull() if ragged == "reject" else valid


def source_metrics(
    raw: DataFrame,
    contract: Contract = RECORDS,
    measure: str = "outcome_score",
    method: str = "exact",
    error: float = 0.0025,
    trim: bool = False,
    work_path: str | None = None,
    ragged: str = "keep",
    keep: str | None = None,
) -> dict[str, object]:
    """The fields of ``METRICS`` from one pass over the source: total, valid, invalid, ragged and to be
    imputed records, the median of the valid records' measure, and parse failures per column. Ragged
    ones are counted if ``raw`` has the column ``RAGGED``, else they are None.

    For the exact median the pass writes, without a shuffle, a slim table of the measure and one
    flag per check, and all metrics are read off that table. For the approximate one it is an
    aggregation by the buckets of the median, whose totals hold everything else as well; the source is
    read again only if the bucket with the middle is too full. The metrics are results of ordinary
    aggregations: work redone after a lost executor is not counted twice, as it can be by
    accumulators and observed metrics ahead of a shuffle.

    With ``keep``, a new folder, the table of the exact median goes there with the typed columns of all rows
    (``kept_records`` reads the valid ones), so that nothing has to be parsed again.
    """
    if method not in ("exact", "approx"):
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")
    if not isinstance(contract.schema[measure].dataType, T.NumericType):
        raise ContractError(f"the measure {measure} must be numeric")
    valid = valid_row(raw, contract, trim, ragged)
    uneven = F.col(RAGGED).isNotNull() if RAGGED in raw.columns else F.lit(False)
    value = no_nan(typed(raw.schema[measure], contract.schema[measure], contract))
    checked = [f for f in contract.schema if not isinstance(f.dataType, T.StringType)]
    flags = {f.name: f"bad_{f.name}" for f in checked}
    if keep:
        slim = _kept(raw, contract, measure, valid, uneven)
    else:
        slim = raw.select(
            valid.alias("valid"),
            F.when(valid, value).alias("v"),
            uneven.alias("ragged"),
            *[parse_failed(raw.schema[f.name], f, contract).alias(flags[f.name]) for f in checked],
        )
    counted = {
        "total": F.count(F.lit(1)),
        "valid": F.count_if("valid"),
        "measured": F.count("v"),
        "ragged": F.count_if("ragged"),
        **{flag: F.count_if(flag) for flag in flags.values()},
    }
    with temporary(raw.sparkSession, work_path) as folder:
        if keep:
            slim.write.parquet(keep)
            slim = raw.sparkSession.read.schema(slim.schema).parquet(keep).drop(KEPT)
        elif method == "exact":
            slim = staged(slim, folder)
        totals = staged(bucket_totals(slim, magnitude(F.col("v")), counted), folder)
        counts = totals.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counted]).first()
        values = slim.select("v").where(F.col("v").isNotNull())
        if method == "exact":
            median = exact_median(values, totals, folder)
        else:
            median = near_median(values, error, totals, folder)
    return {
        "total_records": counts["total"],
        "valid_records": counts["valid"],
        "invalid_records": counts["total"] - counts["valid"],
        "ragged_records": counts["ragged"] if RAGGED in raw.columns else None,
        "imputed_records": counts["valid"] - counts["measured"],
        "median": median,
        "parse_failures": {name: counts[flag] for name, flag in flags.items()},
    }


#: Names of the table that holds the metrics' columns and the typed rows.
KEPT, PARSED = "__kept", "__parsed"


def _kept(
    raw: DataFrame, contract: Contract, measure: str, valid: Column, uneven: Column
) -> DataFrame:
    """The slim table of ``source_metrics`` with the typed columns of valid rows as the struct ``KEPT``.
    Every value is parsed once: a first projection does it, and the flags look at what came out."""
    # named by number, as names of the contract may be any
    value = {f.name: F.col(f"{PARSED}{i}") for i, f in enumerate(contract.schema)}
    rows = raw.withColumns(
        {
            "__valid": valid,
            "__uneven": uneven,
            **{
                f"{PARSED}{i}": parsed(raw.schema[f.name], f, contract)
                for i, f in enumerate(contract.schema)
            },
        }
    )
    typed_row = F.struct(*[without_nan(value[f.name], f).alias(f.name) for f in contract.schema])
    return rows.select(
        F.col("__valid").alias("valid"),
        F.when(F.col("__valid"), no_nan(value[measure])).alias("v"),
        F.col("__uneven").alias("ragged"),
        *[
            parse_failed(raw.schema[f.name], f, contract, value[f.name]).alias(f"bad_{f.name}")
            for f in contract.schema
            if not isinstance(f.dataType, T.StringType)
        ],
        F.when(F.col("__valid"), typed_row).alias(KEPT),
    )


def kept_records(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The typed valid rows that ``source_metrics`` has kept at a path."""
    schema = T.StructType([T.StructField("valid", T.BooleanType()), T.StructField(KEPT, contract.schema)])
    rows = spark.read.schema(schema).parquet(path).where("valid")
    return rows.select(*[F.col(KEPT)[f.name].alias(f.name) for f in contract.schema])


def metrics_row(spark: SparkSession, metrics: Mapping[str, object]) -> DataFrame:
    """The metrics as a frame of one row in one partition, so that it is written as one file."""
    failures = [F.lit(x) for pair in (metrics["parse_failures"] or {}).items() for x in pair]
    columns = {name: F.lit(value) for name, value in metrics.items() if name != "parse_failures"}
    columns["parse_failures"] = F.create_map(*failures)
    return spark.range(0, 1, 1, 1).select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in METRICS]
    )


def transform_records(
    records: DataFrame, config: PipelineConfig, fill: float | None
) -> DataFrame:
    """Typed valid records with the measure filled, range labels and load time added."""
    records = fill_measure(records, config.measure, fill, config.median_digits)
    for rule in config.buckets:
        records = rule.add(records)
    return stamp(records, config.processed_at)


def run_summary(
    metrics: DataFrame,
    name: str,
    run_date: str,
    status: str = "SUCCESS",
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The summary row of a run from its one row of metrics; further metrics are kept, and
    ``more`` columns follow."""
    kept = [c for c in ("ragged_records", "imputed_records", "median", "parse_failures") if c in metrics.columns]
    return metrics.select(
        F.lit(name).alias("pipeline"),
        F.lit(run_date).alias("run_date"),
        F.col("total_records").alias("total_records_ingested"),
        "valid_records",
        "invalid_records",
        F.lit(status).alias("status"),
        *kept,
        *[value.alias(name) for name, value in (more or {}).items()],
    )


#: A name that the run adds to its own table.
VALID = "__valid"


def summary_of(
    spark: SparkSession, config: PipelineConfig, found: Mapping[str, object], error: str | None
) -> DataFrame:
    """The summary row of a run, from all that was found before it ended. Its status tells whether
    the run went through; what wasn't reached is null."""
    metrics = dict.fromkeys(f.name for f in METRICS) | found.get("metrics", {})
    extra = found.get("extra_columns")
    names = F.lit(None) if extra is None else F.array(*[F.lit(name) for name in extra])
    more = {
        "extra_columns": names.cast("array<string>"),
        "written_records": F.lit(found.get("written_records")).cast("long"),
        "output_files": F.lit(found.get("output_files")).cast("long"),
        "error": F.lit(error).cast("string"),
    }
    status = "FAILED" if error else "SUCCESS"
    return run_summary(metrics_row(spark, metrics), config.name, config.run_date, status, more)


def check_options(config: PipelineConfig) -> None:
    """Raise for an option that isn't known, or that doesn't go with another one."""
    known = {
        "null_keys": NULL_KEYS,
        "layout": LAYOUTS,
        "overwrite": OVERWRITE,
        "publishing": PUBLISHING,
        "ragged": RAGGED_ROWS,
    }
    for name, values in known.items():
        if getattr(config, name) not in values:
            raise ValueError(f"{name} must be one of {values}, not {getattr(config, name)!r}")
    if config.manifest_path and config.output_format != "parquet":
        raise ValueError("a manifest is made from the footers of Parquet files")
    if config.overwrite == "dynamic" and config.partition_by not in config.keys:
        raise ValueError("a partial run needs the partition column among the keys of its statistics")


def put_in_place(
    spark: SparkSession, config: PipelineConfig, new: Mapping[str, str], publication: Publication
) -> None:
    """Make the finished folders ``new`` what readers of the outputs see."""
    for path, finished in new.items():
        partial = config.overwrite == "dynamic" and path == config.output_path
        depth = int(path == config.output_path)
        if config.publishing == "version":
            mode = "dynamic" if partial else "static"
            made = versions.commit(spark, path, finished, depth, mode)
            publication.on_failure(lambda p=path, v=made: versions.withdraw(spark, p, v))
        elif partial:
            if versions.current(spark, path):
                raise ValueError(f"{path} is a versioned table; its partitions can't be renamed into")
            parts = versions.partitions_of(spark, finished, depth)
            publication.replace_partitions(finished, path, parts)
        else:
            publication.replace(finished, path)


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> PipelineResult:
    """Run it all. Earlier results stay as they are until all new ones are written and checked, and come
    back if one of these can't be put in place; the summary is written in any case, also if the run fails."""
    check_paths(spark, config)
    found: dict[str, object] = {}
    outputs = [
        config.output_path,
        config.stats_path,
        config.validated_path,
        config.invalid_path,
        config.manifest_path,
    ]
    place = versions.new_folder if config.publishing == "version" else beside
    new = {path: place(path) for path in outputs if path}
    try:
        check_options(config)
        with temporary(spark, config.work_path) as folder:
            schemas = write_results(spark, config, new, folder, found)
        with Publication(spark) as publication:
            put_in_place(spark, config, new, publication)
    except Exception as error:
        for finished in new.values():
            discard(spark, finished)
        if config.summary_path:
            told = f"{type(error).__name__}: {error}".splitlines()[0]
            write_table(summary_of(spark, config, found, told), config.summary_path, "json")
        raise
    summary = summary_of(spark, config, found, None)
    if config.summary_path:
        write_table(summary, config.summary_path, "json")
    formats = {config.output_path: config.output_format, config.stats_path: config.stats_format}
    records, stats = (
        read_partitioned(
            spark, path, schema, format=formats[path], **lines_of(config, formats[path])
        )
        for path, schema in schemas.items()
    )
    return PipelineResult(records, stats, summary, found["metrics"], config.summary_path)


def lines_of(config: PipelineConfig, format: str) -> dict[str, str]:
    """Line breaks in fields come out as they came in."""
    return {"multiLine": "true"} if config.multi_line and format == "csv" else {}


def read_source(
    spark: SparkSession, config: PipelineConfig, folder: str, found: dict[str, object], whole: bool = False
) -> tuple[DataFrame, str | None]:
    """The source's contract columns as text, with ``RAGGED``, and if ``whole`` the folder that its typed
    rows are kept in; adds its metrics to ``found``.

    All files are taken to have one header, which Spark checks as it reads them. Only if one differs,
    files are sorted by header, and the pass is made again."""

    def measured(look: bool) -> tuple[DataFrame, str | None]:
        keep = scratch_dir(spark, folder) if whole else None
        options = dict(config.read_options)
        frames = read_frames(spark, config.input_path, config.multi_line, look, True, **options)
        extra = {c for f in frames for c in check_columns(f, config.contract)} - {RAGGED}
        raw = raw_records(frames, config.contract)
        metrics = source_metrics(
            raw,
            config.contract,
            config.measure,
            config.median_method,
            config.median_error,
            config.trim,
            folder,
            config.ragged,
            keep,
        )
        found.update(extra_columns=sorted(extra), metrics=metrics)
        return raw, keep

    try:
        return measured(look=False)
    except (ContractError, EmptyInputError):
        # the one file whose header was read may be the odd one
        return measured(look=True)
    except Exception as error:
        if not header_differs(error):
            raise
        return measured(look=True)


def with_others(
    spark: SparkSession,
    config: PipelineConfig,
    own: DataFrame,
    path: str,
    format: str,
    made_from: Callable[[], DataFrame],
) -> DataFrame:
    """A table with a row or more per partition of a partial run, with the earlier rows of all other partitions
    from ``path``; where there are none, with those that ``made_from`` has."""
    touched = own.select(column(config.partition_by).alias("__touched")).distinct()
    same = column(config.partition_by).eqNullSafe(F.col("__touched"))
    try:
        earlier = read_partitioned(spark, path, own.schema, format=format)
    except FileNotFoundError:
        try:
            earlier = made_from()
        except FileNotFoundError:
            return own
    return own.unionByName(earlier.join(touched, same, "left_anti"))


def manifest_of(
    spark: SparkSession, config: PipelineConfig, path: str, schema: T.StructType
) -> DataFrame:
    """The inventory of records at a path, with the ranges of numbers and dates."""
    kinds = (T.NumericType, T.DateType)
    ranged = [f.name for f in schema if isinstance(f.dataType, kinds) and f.name != config.partition_by]
    return output_inventory(spark, path, config.partition_by, schema, ranged)


def write_results(
    spark: SparkSession,
    config: PipelineConfig,
    new: Mapping[str, str],
    folder: str,
    found: dict[str, object],
) -> dict[str, T.StructType]:
    """Write all outputs of a run but the summary to their ``new`` folders, with staged tables in
    ``folder``. Gives the schemas of records and statistics; adds to ``found``."""
    contract = config.contract
    text = bool(config.validated_path or config.invalid_path)
    whole = not text and config.median_method == "exact"
    raw, kept_at = read_source(spark, config, folder, found, whole)
    metrics = found["metrics"]
    if metrics["total_records"] == 0:
        raise EmptyInputError(f"no records in {config.input_path}")
    if metrics["valid_records"] == 0:
        raise EmptyInputError(f"no valid records in {config.input_path}")

    valid = valid_row(raw, contract, config.trim, config.ragged)
    good = raw.where(valid)
    columnar = config.output_format != "csv"
    if text or not (whole or columnar):
        split = raw.withColumn(VALID, valid)
        write_partitioned(split, f"{folder}/split", VALID)
        good, bad = (
            read_partitioned(spark, f"{folder}/split", split.schema, {VALID: flag}).drop(VALID)
            for flag in (True, False)
        )
        if config.validated_path:
            write_validated(good, new[config.validated_path], contract.names)
        if config.invalid_path:
            write_validated(bad, new[config.invalid_path], contract.names)

    good = kept_records(spark, kept_at, contract) if kept_at else apply_contract(good, contract)
    records = transform_records(good, config, metrics["median"])
    seen = write_partitioned(
        records,
        new[config.output_path],
        config.partition_by,
        layout=config.layout,
        max_records_per_file=config.max_records_per_file,
        format=config.output_format,
        cluster_by=config.cluster_by,
        observe={"rows": F.count(F.lit(1))},
    )
    found["written_records"] = seen["rows"]
    written = read_partitioned(
        spark, new[config.output_path], records.schema, format=config.output_format
    )
    if columnar:
        files = file_manifest(
            spark, new[config.output_path], records.schema, format=config.output_format
        )
        found["output_files"], kept = files.agg(F.count(F.lit(1)), F.sum("rows")).first()
    else:
        # CSV files don't say how many rows they have
        found["output_files"], kept = len(written.inputFiles()), seen["rows"]
    if not seen["rows"] == kept == metrics["valid_records"]:
        raise RuntimeError(
            f"{seen['rows']} records written, {kept} in the files, {metrics['valid_records']} valid ones read"
        )

    measures = record_measures() if config.measures is None else config.measures
    stats = cohort_stats(written if columnar else records, config.keys, measures)
    if config.overwrite == "dynamic":
        stats = with_others(
            spark, config, staged(stats, folder), config.stats_path, config.stats_format,
            lambda: cohort_stats(
                read_partitioned(spark, config.output_path, records.schema, format=config.output_format),
                config.keys,
                measures,
            ),
        )
    if config.null_keys == "drop":
        stats = stats.dropna(subset=list(config.keys))
    stats = ordered(stats, config.keys)
    write_table(stats, new[config.stats_path], config.stats_format)
    if config.manifest_path:
        manifest = manifest_of(spark, config, new[config.output_path], records.schema)
        if config.overwrite == "dynamic":
            manifest = with_others(
                spark, config, staged(manifest, folder), config.manifest_path, "parquet",
                lambda: manifest_of(spark, config, config.output_path, records.schema),
            )
        write_table(manifest, new[config.manifest_path])
    return {config.output_path: records.schema, config.stats_path: stats.schema}
