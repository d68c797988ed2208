"""Registered queries, each next to the SQL a second engine answers it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import operators as ops
from cohortlake import sinks, sources, versions
from cohortlake.contract import (
    DOSAGE_EDGES,
    DOSAGE_LABELS,
    RECORDS,
    WEIGHT_EDGES,
    WEIGHT_LABELS,
    Contract,
)
from cohortlake.plans import pipeline as pl
from cohortlake.plans.tables import RECORDS_SQL, load, trial_records
from cohortlake.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

MISSING = "drug IS NULL OR drug = '' OR site IS NULL OR site = '' OR patient_id = ''"
WITH_RECORDS = f"""
WITH records AS ({RECORDS_SQL}),
valid AS (SELECT * FROM records WHERE NOT ({MISSING})),
middle AS (SELECT median(outcome_score) AS score FROM valid),
clean AS (SELECT * REPLACE (coalesce(outcome_score, round((SELECT score FROM middle), 2))
                            AS outcome_score) FROM valid)
""".strip()
STATS_SQL = """
SELECT trial_id, drug,
       count(patient_id) AS patient_count,
       avg(dosage_mg) AS avg_dosage_mg,
       avg(outcome_score) AS avg_outcome_score,
       avg(age) AS avg_age,
       count(DISTINCT site) AS site_count,
       cast(sum(CASE WHEN status = 'adverse_event' THEN 1 ELSE 0 END) AS bigint) AS adverse_events
""".strip()
NAMES_SQL = ", ".join(RECORDS.names)


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name together with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLE_SQL[function.__name__] = sql.strip()
        return function

    return register


def records_query(sql: str) -> Callable[[Query], Query]:
    """Like ``query`` for SQL over the views records, valid (complete) and clean (imputed)."""
    return query(f"{WITH_RECORDS}\n{sql.strip()}")


def _valid(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    wanted = dict.fromkeys([*RECORDS.critical, *(columns or RECORDS.names)])
    return ops.split_valid(trial_records(spark, sf_dir, *wanted), RECORDS.critical)[0]


def _clean(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return ops.impute_median(_valid(spark, sf_dir, *columns), "outcome_score", method="exact")


STATS_COLUMNS = (
    "trial_id", "drug", "site", "patient_id", "dosage_mg", "age", "status", "outcome_score",
)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, in reversed order and with one column more than the contract has."""
    columns = [F.col(name).cast("string").alias(name) for name in reversed(df.columns)]
    return df.select(F.lit("x").alias("note"), *columns)


# ---- sources -------------------------------------------------------------------------------


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(o_orderdate AS date) AS o_orderdate, o_orderpriority
    FROM orders
    """
)
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = Contract(
        schema=T.StructType(
            [
                T.StructField("o_orderkey", T.LongType()),
                T.StructField("o_custkey", T.LongType()),
                T.StructField("o_orderstatus", T.StringType()),
                T.StructField("o_totalprice", T.DoubleType()),
                T.StructField("o_orderdate", T.DateType()),
                T.StructField("o_orderpriority", T.StringType()),
            ]
        ),
        critical=("o_orderkey",),
        key="o_orderkey",
    )
    orders = load(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = scratch_dir(spark)
    sinks.write_table(orders.select(*reversed(contract.names)), path, "csv")
    return sources.read_records(spark, path, contract)


@records_query(f"SELECT {NAMES_SQL} FROM records")
def csv_named_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    sinks.write_table(as_text(trial_records(spark, sf_dir)), path, "csv")
    return sources.read_records(spark, path, RECORDS)


@records_query(f"SELECT {NAMES_SQL} FROM records")
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one source whose columns stand in two orders, one of them with a further column."""
    base = scratch_dir(spark)
    records = trial_records(spark, sf_dir)
    first = F.crc32(F.col("patient_id").cast("binary")) % 3 == 0
    sinks.write_table(records.where(first.eqNullSafe(True)), f"{base}/one", "csv")
    sinks.write_table(as_text(records.where(~first.eqNullSafe(True))), f"{base}/other", "csv")
    return sources.read_records(spark, [f"{base}/one", f"{base}/other"], RECORDS)


LINE_CONTRACT = Contract(
    schema=T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_returnflag", T.StringType()),
        ]
    ),
    critical=("l_orderkey",),
    key="l_orderkey",
)
LINES_SQL = """
SELECT l_orderkey, CASE
  WHEN l_orderkey % 7 = 0 THEN concat_ws(',', l_orderkey, l_linenumber)
  WHEN l_orderkey % 11 = 0 THEN concat_ws(',', l_orderkey, l_linenumber, l_returnflag, 'more')
  ELSE concat_ws(',', l_orderkey, l_linenumber, l_returnflag) END AS line
FROM lineitem
""".strip()


def uneven_lines(spark: SparkSession, sf_dir: str) -> str:
    """A folder of CSV files in which some rows have two or four fields under a header of three."""
    key, number, flag = (F.col(name) for name in LINE_CONTRACT.names)
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", key, number))
        .when(key % 11 == 0, F.concat_ws(",", key, number, flag, F.lit("more")))
        .otherwise(F.concat_ws(",", key, number, flag))
    )
    path = scratch_dir(spark)
    # one column whose name is the header; its separator doesn't occur, so nothing gets quoted
    lines = load(spark, sf_dir, "lineitem").select(line.alias(",".join(LINE_CONTRACT.names)))
    lines.write.format("csv").options(header=True, sep="\x01").save(path)
    return path


@query(f"SELECT line AS text FROM ({LINES_SQL}) WHERE l_orderkey % 7 = 0 OR l_orderkey % 11 = 0")
def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.ragged_rows(spark, uneven_lines(spark, sf_dir)).select("text")


@query(
    """
    SELECT l_orderkey, cast(l_linenumber AS integer) AS l_linenumber,
           CASE WHEN l_orderkey % 7 <> 0 THEN l_returnflag END AS l_returnflag
    FROM lineitem
    """
)
def ragged_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What rows of a wrong length share with the header is kept."""
    return sources.read_records(spark, uneven_lines(spark, sf_dir), LINE_CONTRACT)


@query(
    """
    SELECT count(*) AS total_records, count(*) FILTER (WHERE even) AS valid_records,
           count(*) FILTER (WHERE NOT even) AS invalid_records,
           count(*) FILTER (WHERE NOT even) AS ragged_records
    FROM (SELECT l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 AS even FROM lineitem)
    """
)
def ragged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of a run that rejects rows of a wrong length."""
    frames = sources.read_frames(spark, uneven_lines(spark, sf_dir), ragged=True)
    raw = sources.raw_records(frames, LINE_CONTRACT)
    metrics = pl.source_metrics(raw, LINE_CONTRACT, "l_linenumber", ragged="reject")
    return pl.metrics_row(spark, metrics).select(
        "total_records", "valid_records", "invalid_records", "ragged_records"
    )


@records_query(
    """
    SELECT column_name,
           cast(CASE column_name
                WHEN 'age' THEN (SELECT count(*) FROM records WHERE status = 'withdrawn')
                WHEN 'dosage_mg' THEN (SELECT count(*) FROM records WHERE drug = 'A')
                WHEN 'enrollment_date' THEN (SELECT count(*) FROM records WHERE status = 'active')
                ELSE 0 END AS bigint) AS failures
    FROM (SELECT unnest(['patient_id', 'trial_id', 'drug', 'site', 'dosage_mg', 'age',
                         'weight_kg', 'enrollment_date', 'status', 'outcome_score'])
          AS column_name)
    """
)
def parse_failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in the wrong notation, words and dates in another format are failures; empty text
    and NaN are missing values."""
    text = trial_records(spark, sf_dir)
    text = text.select(*[F.col(name).cast("string").alias(name) for name in text.columns])
    status, drug, age, day = (F.col(c) for c in ("status", "drug", "age", "enrollment_date"))

    def swapped(when: Column, value: Column, name: str) -> Column:
        return F.when(when, value).otherwise(F.col(name))

    done = status == "completed"
    text = text.withColumns(
        {
            "age": swapped(status == "withdrawn", F.concat(age, F.lit(".0")), "age"),
            "dosage_mg": swapped(drug == "A", F.lit("n/a"), "dosage_mg"),
            "enrollment_date": swapped(
                status == "active", F.translate(day, "-", "/"), "enrollment_date"
            ),
            "outcome_score": swapped(done, F.lit(""), "outcome_score"),
            "weight_kg": swapped(done, F.lit("NaN"), "weight_kg"),
        }
    )
    return ops.parse_failures(text, RECORDS)


@records_query("SELECT patient_id, trial_id, drug, outcome_score FROM valid WHERE drug = 'R'")
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _valid(spark, sf_dir, "patient_id", "trial_id", "drug", "outcome_score").drop("site")
    path = scratch_dir(spark)
    sinks.write_partitioned(df, path, "drug")
    return sources.read_partitioned(spark, path, df.schema, where={"drug": "R"})


@records_query(
    """
    SELECT patient_id, trial_id, drug, outcome_score FROM valid
    WHERE drug = 'R' AND trial_id = '1-URGENT'
    """
)
def clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trial of one drug: the folders of other drugs and the row groups of other trials are skipped."""
    df = _valid(spark, sf_dir, "patient_id", "trial_id", "drug", "outcome_score").drop("site")
    path = scratch_dir(spark)
    sinks.write_partitioned(df, path, "drug", layout="rebalance", cluster_by=["trial_id"])
    wanted = {"drug": "R", "trial_id": "1-URGENT"}
    return sources.read_partitioned(spark, path, df.schema, where=wanted)


# ---- sinks ---------------------------------------------------------------------------------


@records_query(f"SELECT {NAMES_SQL} FROM valid")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _valid(spark, sf_dir)
    path = scratch_dir(spark)
    sinks.write_partitioned(df, path, "drug", layout="rebalance")
    return sources.read_partitioned(spark, path, df.schema)


@records_query(
    """
    SELECT patient_id, drug, CASE WHEN drug = 'A' THEN age + 1 ELSE age END AS age
    FROM records
    """
)
def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "drug", "age")
    path = scratch_dir(spark)
    sinks.write_partitioned(df, path, "drug")
    later = df.where("drug = 'A'").withColumn("age", F.col("age") + 1)
    sinks.write_partitioned(later, path, "drug", overwrite="dynamic")
    return sources.read_partitioned(spark, path, df.schema)


AGED_SQL = "SELECT patient_id, drug, CASE WHEN drug = 'A' THEN age + {} ELSE age END AS age FROM records"


def _aged_twice(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A versioned table whose partition A was replaced twice, so that it has three versions."""
    df = trial_records(spark, sf_dir, "patient_id", "drug", "age")
    path = scratch_dir(spark)
    sinks.write_versioned(df, path, "drug")
    for years in (1, 2):
        later = df.where("drug = 'A'").withColumn("age", F.col("age") + years)
        sinks.write_versioned(later, path, "drug", overwrite="dynamic")
    return path, df


@records_query(AGED_SQL.format(2))
def versioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, df = _aged_twice(spark, sf_dir)
    return sources.read_partitioned(spark, path, df.schema)


@records_query(f"{AGED_SQL.format(1)} WHERE drug = 'A'")
def version_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of three versions brought back, all others removed."""
    path, df = _aged_twice(spark, sf_dir)
    versions.restore(spark, path, 2)
    versions.expire(spark, path)
    return sources.read_partitioned(spark, path, df.schema, where={"drug": "A"})


@records_query(f"{STATS_SQL} FROM clean GROUP BY trial_id, drug")
def stats_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = ops.ordered(ops.cohort_stats(_clean(spark, sf_dir, *STATS_COLUMNS)))
    path = scratch_dir(spark)
    sinks.write_table(stats, path)
    return sources.read_partitioned(spark, path, stats.schema)


@records_query(f"SELECT {NAMES_SQL} FROM valid")
def validated_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    sinks.write_validated(_valid(spark, sf_dir), path, RECORDS.names)
    return sources.read_records(spark, path, RECORDS)


SUMMARY_SQL = f"""
SELECT 'cohortlake' AS pipeline, '2024-06-01' AS run_date,
       count(*) AS total_records_ingested,
       count(*) FILTER (WHERE NOT ({MISSING})) AS valid_records,
       count(*) FILTER (WHERE {MISSING}) AS invalid_records,
       'SUCCESS' AS status
FROM records
"""


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ops.quality_counts(trial_records(spark, sf_dir, *RECORDS.critical), RECORDS.critical)
    return pl.run_summary(counts, "cohortlake", "2024-06-01")


@records_query(SUMMARY_SQL)
def summary_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = _summary(spark, sf_dir)
    path = scratch_dir(spark)
    sinks.write_table(summary, path, "json")
    return sources.read_partitioned(spark, path, summary.schema, format="json")


@query(
    """
    SELECT l_returnflag, count(*) AS row_count, count(DISTINCT l_orderkey % 4) AS file_count,
           min(l_linenumber) AS min_l_linenumber, max(l_linenumber) AS max_l_linenumber,
           min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity
    FROM lineitem GROUP BY l_returnflag
    """
)
def output_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tasks write, so a flag has a file for each of them that holds one of its rows."""
    df = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    task = (F.col("l_orderkey") % 4).cast("int")
    path = scratch_dir(spark)
    sinks.write_partitioned(df.repartitionById(4, task), path, "l_returnflag")
    ranges = ("l_linenumber", "l_quantity")
    found = sources.output_inventory(spark, path, "l_returnflag", df.schema, ranges)
    return found.drop("byte_count")


# ---- validation and quality ----------------------------------------------------------------


@query("SELECT count(*) AS record_count FROM lineitem")
def record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.record_count(load(spark, sf_dir, "lineitem"))


@records_query(f"SELECT {NAMES_SQL} FROM valid")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.split_valid(trial_records(spark, sf_dir), RECORDS.critical)[0]


@records_query(f"SELECT {NAMES_SQL} FROM records WHERE {MISSING}")
def invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.split_valid(trial_records(spark, sf_dir), RECORDS.critical)[1]


@records_query(
    f"""
    SELECT count(*) AS total_records,
           count(*) FILTER (WHERE NOT ({MISSING})) AS valid_records,
           count(*) FILTER (WHERE {MISSING}) AS invalid_records
    FROM records
    """
)
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.quality_counts(trial_records(spark, sf_dir, *RECORDS.critical), RECORDS.critical)


@records_query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) - count({name}) AS missing_count, "
        f"(count(*) - count({name})) / count(*) AS missing_share FROM records"
        for name in RECORDS.names
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.null_profile(trial_records(spark, sf_dir))


@query(
    """
    SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag FROM lineitem
    WHERE nullif(l_returnflag, 'N') IS NOT NULL
    """
)
def drop_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("nullif(l_returnflag, 'N')").alias("flag")
    )
    return ops.drop_null_key(df, "flag")


# ---- projections ---------------------------------------------------------------------------


@records_query(f"SELECT {NAMES_SQL} FROM records")
def apply_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.apply_contract(as_text(trial_records(spark, sf_dir)), RECORDS)


def _label_sql(col: str, edges, labels, op: str, lower: str = "", missing: str = "NULL") -> str:
    first, second = edges
    return f"""
    SELECT patient_id, {col},
           CASE WHEN {col} IS NULL THEN {missing} {lower}
                WHEN {col} {op} {first} THEN '{labels[0]}'
                WHEN {col} {op} {second} THEN '{labels[1]}'
                ELSE '{labels[2]}' END AS label
    FROM records
    """


@records_query(_label_sql("dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "<"))
def dosage_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "dosage_mg")
    return ops.bucketize(df, "dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "label")


@records_query(
    _label_sql("dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "<=", "WHEN dosage_mg <= 0 THEN NULL")
)
def dosage_bucket_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "dosage_mg")
    return ops.bucketize(
        df, "dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "label", closed="right", lower=0
    )


@records_query(_label_sql("dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "<", missing="'high'"))
def dosage_bucket_null_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "dosage_mg")
    return ops.bucketize(
        df, "dosage_mg", DOSAGE_EDGES, DOSAGE_LABELS, "label", null_label=DOSAGE_LABELS[-1]
    )


@records_query(_label_sql("weight_kg", WEIGHT_EDGES, WEIGHT_LABELS, "<"))
def weight_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "weight_kg")
    return ops.bucketize(df, "weight_kg", WEIGHT_EDGES, WEIGHT_LABELS, "label")


@records_query(
    _label_sql("weight_kg", WEIGHT_EDGES, WEIGHT_LABELS, "<=", "WHEN weight_kg <= 0 THEN NULL")
)
def weight_group_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "weight_kg")
    return ops.bucketize(
        df, "weight_kg", WEIGHT_EDGES, WEIGHT_LABELS, "label", closed="right", lower=0
    )


@records_query("SELECT patient_id, status, '2024-06-01 12:30:00' AS processed_at FROM records")
def stamp_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compared as text, which is the same whatever the time zones of the two engines are."""
    df = trial_records(spark, sf_dir, "patient_id", "status")
    at = F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss")
    return ops.stamp(df, at="2024-06-01 12:30:00").withColumn("processed_at", at)


@records_query(
    """
    SELECT patient_id, coalesce(drug, 'unknown') AS drug, coalesce(dosage_mg, 0) AS dosage_mg,
           coalesce(outcome_score, 50.5) AS outcome_score
    FROM records
    """
)
def fill_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trial_records(spark, sf_dir, "patient_id", "drug", "dosage_mg", "outcome_score")
    return ops.fill_missing(df, {"drug": "unknown", "dosage_mg": 0, "outcome_score": 50.5})


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN cast(o_orderdate AS date) END AS day
    FROM orders
    """
)
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd.MM.yyyy"))
    day = day.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    text = load(spark, sf_dir, "orders").select("o_orderkey", day.alias("text"))
    return ops.parse_date(text, "text", "day").drop("text")


# ---- aggregations --------------------------------------------------------------------------


@query("SELECT median(l_extendedprice) AS median FROM lineitem")
def median_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = ops.median(load(spark, sf_dir, "lineitem"), "l_extendedprice", method="exact", reread=True)
    return spark.range(1).select(F.lit(value).cast("double").alias("median"))


@query("SELECT count(l_extendedprice) AS n, TRUE AS within_error FROM lineitem")
def median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate median promises a rank, not a value: at most a quarter of a percent of all
    rows lie between it and the middle."""
    df = load(spark, sf_dir, "lineitem").select("l_extendedprice")
    error = 0.0025
    middle = ops.median(df, "l_extendedprice", method="approx", error=error)
    below = F.count_if(F.col("l_extendedprice") < F.lit(middle))
    upto = F.count_if(F.col("l_extendedprice") <= F.lit(middle))
    n = F.count("l_extendedprice")
    return df.agg(
        n.alias("n"),
        ((below <= n * (0.5 + error)) & (upto >= n * (0.5 - error))).alias("within_error"),
    )


@records_query("SELECT patient_id, outcome_score FROM clean")
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir, "outcome_score").select("patient_id", "outcome_score")


def _grouped(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        measure = {
            "avg_dosage_mg": "dosage_mg",
            "site_count": "site",
            "adverse_events": "status",
            "patient_count": "patient_id",
        }[name]
        df = trial_records(spark, sf_dir, "trial_id", "drug", measure)
        return ops.cohort_stats(df, measures={name: ops.record_measures()[name]})

    return run


@records_query(
    "SELECT trial_id, drug, count(patient_id) AS patient_count FROM records GROUP BY ALL"
)
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped("patient_count")(spark, sf_dir)


@records_query("SELECT trial_id, drug, avg(dosage_mg) AS avg_dosage_mg FROM records GROUP BY ALL")
def group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped("avg_dosage_mg")(spark, sf_dir)


@records_query(
    "SELECT trial_id, drug, count(DISTINCT site) AS site_count FROM records GROUP BY ALL"
)
def group_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped("site_count")(spark, sf_dir)


@records_query(
    """
    SELECT trial_id, drug, count(*) FILTER (WHERE status = 'adverse_event') AS adverse_events
    FROM records GROUP BY ALL
    """
)
def conditional_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped("adverse_events")(spark, sf_dir)


@records_query(f"{STATS_SQL} FROM clean GROUP BY trial_id, drug")
def cohort_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: valid rows, median imputation, all measures per cohort."""
    return ops.cohort_stats(_clean(spark, sf_dir, *STATS_COLUMNS))


@records_query(f"{STATS_SQL} FROM records GROUP BY trial_id, drug")
def cohort_stats_keep_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cohort_stats(trial_records(spark, sf_dir, *STATS_COLUMNS))


@records_query(f"{STATS_SQL} FROM records WHERE drug IS NOT NULL GROUP BY trial_id, drug")
def cohort_stats_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cohort_stats(trial_records(spark, sf_dir, *STATS_COLUMNS), null_keys="drop")


@records_query(
    f"{STATS_SQL} FROM records GROUP BY trial_id, drug "
    "ORDER BY trial_id NULLS FIRST, drug NULLS FIRST"
)
def stats_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ordered(ops.cohort_stats(trial_records(spark, sf_dir, *STATS_COLUMNS)))


@query("SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preview(load(spark, sf_dir, "orders"), 20, ["o_totalprice", "o_orderkey"])


# ---- whole runs and reporting --------------------------------------------------------------


@records_query(
    f"""
    SELECT 'cohortlake' AS pipeline, '2024-06-01' AS run_date,
           count(*) AS total_records_ingested,
           count(*) FILTER (WHERE NOT ({MISSING})) AS valid_records,
           count(*) FILTER (WHERE {MISSING}) AS invalid_records,
           'SUCCESS' AS status,
           count(*) FILTER (WHERE NOT ({MISSING}) AND outcome_score IS NULL) AS imputed_records,
           (SELECT score FROM middle) AS median,
           cast(0 AS bigint) AS parse_failures,
           'note' AS extra_columns,
           cast(0 AS bigint) AS ragged_records,
           count(*) FILTER (WHERE NOT ({MISSING})) AS written_records,
           TRUE AS has_files,
           cast(NULL AS varchar) AS error
    FROM records
    """
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary that a whole run writes, read back from its file."""
    result = run_on_tables(spark, sf_dir)
    failures = F.aggregate(F.map_values("parse_failures"), F.lit(0).cast("long"), lambda a, b: a + b)
    summary = result.summary
    written = sources.read_partitioned(spark, result.summary_path, summary.schema, format="json")
    return written.select(
        "pipeline",
        "run_date",
        "total_records_ingested",
        "valid_records",
        "invalid_records",
        "status",
        "imputed_records",
        "median",
        failures.alias("parse_failures"),
        F.array_join("extra_columns", ",").alias("extra_columns"),
        "ragged_records",
        "written_records",
        (F.col("output_files") > 0).alias("has_files"),
        "error",
    )


@records_query(
    f"""
    SELECT count(*) AS total_records,
           count(*) FILTER (WHERE NOT ({MISSING})) AS valid_records,
           count(*) FILTER (WHERE {MISSING}) AS invalid_records,
           count(*) FILTER (WHERE NOT ({MISSING}) AND outcome_score IS NULL) AS imputed_records,
           (SELECT score FROM middle) AS median,
           count(*) FILTER (WHERE status = 'withdrawn') AS bad_ages,
           count(*) FILTER (WHERE status = 'active') AS bad_days
    FROM records
    """
)
def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ages and days of some rows that don't parse."""
    text = as_text(trial_records(spark, sf_dir))
    age, day, status = (F.col(name) for name in ("age", "enrollment_date", "status"))
    text = text.withColumns(
        {
            "age": F.when(status == "withdrawn", F.concat(age, F.lit("y"))).otherwise(age),
            "enrollment_date": F.when(status == "active", F.translate(day, "-", ".")).otherwise(day),
        }
    )
    failed = F.col("parse_failures")
    return pl.metrics_row(spark, pl.source_metrics(text)).select(
        "total_records",
        "valid_records",
        "invalid_records",
        "imputed_records",
        "median",
        failed["age"].alias("bad_ages"),
        failed["enrollment_date"].alias("bad_days"),
    )


def run_on_tables(spark: SparkSession, sf_dir: str, **options: object) -> pl.PipelineResult:
    """Write the record view as CSV and run the whole pipeline on it."""
    base = scratch_dir(spark)
    sinks.write_table(as_text(trial_records(spark, sf_dir)), f"{base}/input", "csv")
    config = pl.PipelineConfig(
        input_path=f"{base}/input",
        output_path=f"{base}/records",
        stats_path=f"{base}/stats",
        summary_path=f"{base}/summary",
        work_path=f"{base}/work",
        run_date="2024-06-01",
        **options,
    )
    return pl.run_pipeline(spark, config)


@records_query(f"{STATS_SQL} FROM clean GROUP BY trial_id, drug")
def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on_tables(spark, sf_dir).stats


@records_query(
    f"""
    SELECT {NAMES_SQL},
           CASE WHEN dosage_mg < 100 THEN 'low' WHEN dosage_mg < 300 THEN 'medium'
                WHEN dosage_mg IS NOT NULL THEN 'high' END AS dosage_bucket,
           CASE WHEN weight_kg < 60 THEN 'underweight' WHEN weight_kg < 85 THEN 'normal'
                WHEN weight_kg IS NOT NULL THEN 'overweight' END AS weight_group
    FROM clean
    """
)
def end_to_end_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on_tables(spark, sf_dir).records.drop("processed_at")


def _run_labels_sql(op: str, first: str, missing: tuple[str, str]) -> str:
    """The two labels of a whole run: comparison with an edge, an extra branch, and the labels
    of missing values."""
    return f"""
           CASE WHEN dosage_mg IS NULL THEN {missing[0]} {first.format(col="dosage_mg")}
                WHEN dosage_mg {op} 100 THEN 'low' WHEN dosage_mg {op} 300 THEN 'medium'
                ELSE 'high' END AS dosage_bucket,
           CASE WHEN weight_kg IS NULL THEN {missing[1]} {first.format(col="weight_kg")}
                WHEN weight_kg {op} 60 THEN 'underweight' WHEN weight_kg {op} 85 THEN 'normal'
                ELSE 'overweight' END AS weight_group"""


@records_query(
    f"""
    SELECT patient_id, trial_id, drug, coalesce(outcome_score, (SELECT score FROM middle))
           AS outcome_score,
           {_run_labels_sql("<=", "WHEN {col} <= 0 THEN NULL", ("NULL", "NULL"))}
    FROM valid
    """
)
def end_to_end_right_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges closed on the right, the median as it is, null cohorts left out, results as CSV."""
    result = run_on_tables(
        spark,
        sf_dir,
        buckets=pl.RIGHT_CLOSED,
        median_digits=None,
        null_keys="drop",
        output_format="csv",
        stats_format="csv",
    )
    return result.records.select(
        "patient_id", "trial_id", "drug", "outcome_score", "dosage_bucket", "weight_group"
    )


@records_query(
    f"""
    SELECT patient_id, trial_id, drug, outcome_score,
           {_run_labels_sql("<", "", ("'high'", "'overweight'"))}
    FROM clean
    """
)
def end_to_end_null_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing dosages and weights in the last range; rows rebalanced before they are written."""
    result = run_on_tables(
        spark, sf_dir, buckets=pl.LEFT_CLOSED_NULL_LAST, layout="rebalance"
    )
    return result.records.select(
        "patient_id", "trial_id", "drug", "outcome_score", "dosage_bucket", "weight_group"
    )


@records_query(
    f"""
    {STATS_SQL}
    FROM (SELECT * REPLACE (coalesce(outcome_score, (SELECT score FROM middle)) AS outcome_score)
          FROM valid)
    GROUP BY trial_id, drug
    """
)
def end_to_end_csv_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the unrounded median, as CSV."""
    return run_on_tables(
        spark, sf_dir, median_digits=None, output_format="csv", stats_format="csv"
    ).stats


PARTIAL = "SELECT * REPLACE (CASE WHEN drug = 'A' THEN age + 1 ELSE age END AS age) FROM valid"


def _partial_run(spark: SparkSession, sf_dir: str, publishing: str) -> pl.PipelineResult:
    """A whole run, then one of a single drug's records, a year later."""
    records, base = trial_records(spark, sf_dir), scratch_dir(spark)
    later = records.where("drug = 'A'").withColumn("age", F.col("age") + 1)
    for name, df, overwrite in (("all", records, "static"), ("later", later, "dynamic")):
        sinks.write_table(as_text(df), f"{base}/{name}", "csv")
        config = pl.PipelineConfig(
            input_path=f"{base}/{name}",
            output_path=f"{base}/records",
            stats_path=f"{base}/stats",
            work_path=f"{base}/work",
            run_date="2024-06-01",
            overwrite=overwrite,
            publishing=publishing,
        )
        result = pl.run_pipeline(spark, config)
    return result


@records_query(f"SELECT patient_id, trial_id, drug, site, age, status FROM ({PARTIAL})")
def partial_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _partial_run(spark, sf_dir, "rename")
    return result.records.select("patient_id", "trial_id", "drug", "site", "age", "status")


@records_query(
    f"""
    SELECT trial_id, drug, count(patient_id) AS patient_count, avg(age) AS avg_age,
           count(DISTINCT site) AS site_count
    FROM ({PARTIAL}) GROUP BY trial_id, drug
    """
)
def partial_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published by pointing to versions."""
    stats = _partial_run(spark, sf_dir, "version").stats
    return stats.select("trial_id", "drug", "patient_count", "avg_age", "site_count")


@records_query(
    """
    SELECT drug, count(*) AS row_count, min(age) AS min_age, max(age) AS max_age,
           min(enrollment_date) AS min_enrollment_date, max(enrollment_date) AS max_enrollment_date,
           min(outcome_score) AS min_outcome_score, max(outcome_score) AS max_outcome_score
    FROM clean GROUP BY drug
    """
)
def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest that a run writes, from the footers of its records."""
    path = scratch_dir(spark)
    run_on_tables(spark, sf_dir, manifest_path=path)
    names = ("age", "enrollment_date", "outcome_score")
    return spark.read.parquet(path).select(
        "drug", "row_count", *[f"{end}_{name}" for name in names for end in ("min", "max")]
    )
