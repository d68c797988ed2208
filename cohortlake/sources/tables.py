"""Written tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import versions
from cohortlake.formats import options_of
from cohortlake.functions.columns import column
from cohortlake.sources.records import _loaded


def read_partitioned(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    where: Mapping[str, object] | None = None,
    format: str = "parquet",
    version: int | None = None,
    **options: str,
) -> DataFrame:
    """A written table under its own schema, restricted to the given column values; of a versioned
    table the newest version, or the one with the given number.

    The schema keeps partition values in their type: a drug named ``2023`` stays text. A
    restriction on a partition column skips the folders of all other values.
    """
    reader = spark.read.format(format).options(**options_of(format), **options)
    found = versions.current(spark, path) if version is None else versions.read_version(spark, path, version)
    if found is None:
        if version is not None:
            raise LookupError(f"{path} has no version {version}")
        df = _loaded(reader.schema(schema), path)
    elif not found.parts:
        df = spark.createDataFrame([], schema)
    else:
        own = T.StructType([*schema, T.StructField(versions.FOLDER, T.StringType())])
        reader = reader.schema(own).option("basePath", path)
        df = _loaded(reader, found.paths(path)).drop(versions.FOLDER)
    for name, value in (where or {}).items():
        df = df.where(column(name) == F.lit(value))
    return df


def file_manifest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    by: Sequence[str] | str = (),
    format: str = "parquet",
) -> DataFrame:
    """(``by``, file, bytes, rows) of every data file that has rows. No column is read: the tasks take
    the rows from the footers, and no list of files comes to the driver as a result."""
    df = read_partitioned(spark, path, schema, format=format)
    by = [column(name).alias(name) for name in ([by] if isinstance(by, str) else by)]
    file, size = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size")
    return df.groupBy(*by, file, size.alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))


def footer_ranges(
    spark: SparkSession, path: str, by: str, schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """(``by``, min and max of each column) of a Parquet table. Spark answers this from the footers'
    statistics, in tasks, without reading a page: numbers and dates only, as the statistics of
    texts may be cut short."""
    session = spark.newSession()
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.sources.useV1SourceList", "csv,json,orc,text")
    df = read_partitioned(session, path, schema)
    ends = [
        end(column(name)).alias(f"{word}_{name}")
        for name in columns
        for word, end in (("min", F.min), ("max", F.max))
    ]
    return df.groupBy(column(by).alias(by)).agg(*ends)


def output_inventory(
    spark: SparkSession,
    path: str,
    by: str,
    schema: T.StructType,
    ranges: Sequence[str] = (),
) -> DataFrame:
    """Data files, bytes and rows per partition value of a Parquet table, and the ranges of the given
    columns, all from the footers. Written as a table it is the manifest of the one it describes."""
    found = (
        file_manifest(spark, path, schema, by)
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            F.sum("rows").alias("row_count"),
            F.sum("bytes").alias("byte_count"),
        )
    )
    if not ranges:
        return found
    ends = footer_ranges(spark, path, by, schema, ranges).withColumnRenamed(by, "__by")
    return found.join(ends, column(by).eqNullSafe(F.col("__by"))).drop("__by")
