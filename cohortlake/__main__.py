"""``python -m cohortlake input output stats``: one run from the command line.

On a cluster, submit this file with ``spark-submit --py-files``; the session's own settings apply.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession

from cohortlake.plans import pipeline as pl

RANGES = {
    "left": pl.LEFT_CLOSED,
    "left-null-last": pl.LEFT_CLOSED_NULL_LAST,
    "right": pl.RIGHT_CLOSED,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cohortlake", description="Load record files.")
    p.add_argument("input", nargs="+", help="CSV files or folders, then the two outputs")
    p.add_argument("output", help="table of records, one folder per drug")
    p.add_argument("stats", help="table of cohort statistics")
    p.add_argument("--summary", help="folder of the run summary (JSON)")
    p.add_argument("--validated", help="folder of the valid rows (CSV)")
    p.add_argument("--invalid", help="folder of the rejected rows (CSV)")
    p.add_argument("--manifest", help="folder of the manifest of the records (Parquet)")
    p.add_argument("--run-date", help="YYYY-MM-DD, today by default")
    p.add_argument("--median", choices=("exact", "approx"), default="exact")
    p.add_argument("--digits", default="2", help="places the median is rounded to, or 'none'")
    p.add_argument("--ranges", choices=sorted(RANGES), default="left")
    p.add_argument("--null-keys", choices=("keep", "drop"), default="keep")
    p.add_argument("--layout", choices=("direct", "rebalance"), default="rebalance")
    p.add_argument("--format", choices=("parquet", "orc", "csv"), default="parquet")
    p.add_argument("--work", help="folder of staged tables")
    p.add_argument("--trim", action="store_true", help="a field of blanks counts as missing")
    p.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    p.add_argument("--null-value", action="append", help="text that stands for null; repeatable")
    p.add_argument("--processed-at", help="load time, now by default")
    p.add_argument("--error", type=float, default=0.0025, help="rank error of --median approx")
    p.add_argument("--max-records-per-file", type=int)
    p.add_argument("--overwrite", choices=pl.OVERWRITE, default="static", help="dynamic: a partial run")
    p.add_argument("--publishing", choices=pl.PUBLISHING, default="rename")
    p.add_argument("--ragged", choices=pl.RAGGED_ROWS, default="keep")
    p.add_argument("--cluster-by", nargs="*", default=[], metavar="COLUMN")
    return p


def config_of(args: argparse.Namespace) -> pl.PipelineConfig:
    dated = {"run_date": args.run_date} if args.run_date else {}
    contract = pl.PipelineConfig.contract
    if args.null_value:
        contract = dataclasses.replace(contract, null_values=tuple(args.null_value))
    return pl.PipelineConfig(
        input_path=args.input,
        output_path=args.output,
        stats_path=args.stats,
        summary_path=args.summary,
        validated_path=args.validated,
        invalid_path=args.invalid,
        manifest_path=args.manifest,
        median_method=args.median,
        median_digits=None if args.digits == "none" else int(args.digits),
        buckets=RANGES[args.ranges],
        null_keys=args.null_keys,
        layout=args.layout,
        output_format=args.format,
        stats_format=args.format,
        work_path=args.work,
        contract=contract,
        trim=args.trim,
        multi_line=args.multi_line,
        processed_at=args.processed_at,
        median_error=args.error,
        max_records_per_file=args.max_records_per_file,
        overwrite=args.overwrite,
        publishing=args.publishing,
        ragged=args.ragged,
        cluster_by=args.cluster_by,
        **dated,
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    config = config_of(parser().parse_args(argv))
    session = spark or SparkSession.builder.appName("cohortlake").getOrCreate()
    result = pl.run_pipeline(session, config)
    result.summary.show(truncate=False)
    result.stats.show(truncate=False)
    if spark is None:
        session.stop()


if __name__ == "__main__":
    main()
