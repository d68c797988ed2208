"""Writers. Every path may be any URI the cluster's file systems know."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation

from cohortlake import versions
from cohortlake.formats import options_of
from cohortlake.functions.columns import column
from cohortlake.scratch import discard

LAYOUTS = ("direct", "rebalance")


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] | str,
    overwrite: str = "static",
    layout: str = "direct",
    max_records_per_file: int | None = None,
    format: str = "parquet",
    cluster_by: Sequence[str] = (),
    observe: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Write a table in one folder per value of ``by``, replacing what is there.

    ``overwrite="static"`` replaces the whole table, ``"dynamic"`` only the partitions that
    occur in ``df``.

    ``layout="direct"`` writes from the tasks that hold the rows: no shuffle, and up to tasks x
    values files, so it suits few values and large input splits
    (``spark.sql.files.maxPartitionBytes``). ``"rebalance"`` first shuffles by ``by`` and lets
    adaptive execution join small partitions and split large ones, a value holding a third of
    the rows included; it suits many values, and needs adaptive execution: without it the
    largest value would be one task.

    ``cluster_by`` sorts the rows of every file by these columns, so that a reader that asks for one of
    their values skips all row groups whose range doesn't hold it.

    ``observe`` are aggregates over the rows as they are written; their values are returned. They belong to
    the stage that writes, whose tasks count once each however often they are tried.
    """
    by = [by] if isinstance(by, str) else list(by)
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"overwrite must be 'static' or 'dynamic', not {overwrite!r}")
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if layout == "rebalance":
        conf = df.sparkSession.conf
        for setting in (
            "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled",
        ):
            if conf.get(setting, "true").lower() != "true":
                raise ValueError(f"layout 'rebalance' needs {setting}")
        df = df.hint("rebalance", *by)
    if cluster_by:
        df = df.sortWithinPartitions(*[column(name) for name in [*by, *cluster_by]])
    seen = Observation()
    if observe:
        df = df.observe(seen, *[c.alias(name) for name, c in observe.items()])
    writer = (
        df.write.mode("overwrite")
        .partitionBy(*by)
        .format(format)
        .options(**options_of(format), partitionOverwriteMode=overwrite)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)
    return dict(seen.get) if observe else {}


def write_versioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] | str = (),
    overwrite: str = "static",
    format: str = "parquet",
    **options: object,
) -> versions.Version:
    """Make a frame the next version of a versioned table: the whole of it, or with
    ``overwrite="dynamic"`` its partitions. ``options`` are those of ``write_partitioned``."""
    by = [by] if isinstance(by, str) else list(by)
    folder = versions.new_folder(path)
    try:
        if by:
            write_partitioned(df, folder, by, format=format, **options)
        else:
            write_table(df, folder, format)
        return versions.commit(df.sparkSession, path, folder, len(by), overwrite)
    except Exception:
        discard(df.sparkSession, folder)
        raise


def write_table(
    df: DataFrame, path: str | None, format: str = "parquet", **options: str
) -> None:
    """Write a frame as one table, replacing what is there.

    CSV gets a header and doubled quotes. Formats without a path, such as ``jdbc`` for a
    statistics table that a database serves, take all they need from ``options``.
    """
    writer = df.write.mode("overwrite").format(format)
    writer.options(**(options_of(format) | options)).save(path)


def write_validated(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """The given columns in the given order as CSV with a header."""
    write_table(df.select(*columns), path, "csv")
