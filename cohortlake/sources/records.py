"""Delimited record files, addressed by header name."""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.contract import Contract, EmptyInputError
from cohortlake.formats import CSV_OPTIONS
from cohortlake.functions.columns import column
from cohortlake.operators.quality import apply_contract, check_columns
from cohortlake.scratch import hadoop_path

#: Options that say which files are read and how lines end.
LISTING = ("pathglobfilter", "recursivefilelookup", "modifiedbefore", "modifiedafter", "linesep")
#: Up to this many files are looked at from the driver, within this many bytes of each; more by tasks.
FEW_FILES, FIRST_BYTES = 1024, 1 << 16
#: Files that the driver opens at a time.
AT_A_TIME = 16
#: Text of a row that has more or fewer fields than its header; null for all other rows.
RAGGED = "__ragged"
#: Every file is one task of the pass over the headers, which ends after the first lines.
ONE_FILE_A_TASK = {
    "spark.sql.files.maxPartitionBytes": 1 << 40,
    "spark.sql.files.openCostInBytes": 1 << 40,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 16,
}


def _loaded(reader, path: str | list[str]) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input not found: {path}") from error
        raise


def _first_lines(text: DataFrame, whole: bool) -> DataFrame:
    """(file, line): the first line that isn't blank. Unless ``whole``, a task stops after the
    first one it finds, whatever files it has left."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["start"] == 0 and row["file"] != seen and row["line"].strip():
                    seen = row["file"]
                    yield pa.RecordBatch.from_pylist([{"file": seen, "line": row["line"]}])
                    if not whole:
                        return

    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    ).mapInArrow(first, "file string, line string")


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that isn't blank, if it ends within ``FIRST_BYTES``."""
    system, made = hadoop_path(spark, file)
    factory = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory
    codec = factory(spark._jsc.hadoopConfiguration()).getCodec(made)
    stream = system.open(made)
    try:
        data = codec.createInputStream(stream) if codec else stream
        start = bytes(data.readNBytes(FIRST_BYTES))
    finally:
        stream.close()
    # what follows the last line break may go on
    lines = re.split(rb"\r\n|\n|\r(?!\Z)", start)[:-1]
    whole = (line.decode("utf-8", "replace") for line in lines)
    return next((line for line in whole if line.strip()), None)


def _first_lines_by_tasks(session: SparkSession, files: list[str], wanted: dict) -> dict[str, str]:
    """The first line of every file, from tasks that read the first lines of a file each."""
    text = session.read.format("text").options(**wanted).load(files)
    lines = {unquote(f): line for f, line in _first_lines(text, whole=False).collect()}
    # files without a line, and any that shared a task with another
    rest = sorted(set(files) - lines.keys())
    if rest:
        others = session.read.format("text").options(**wanted).load(rest)
        lines |= {unquote(f): line for f, line in _first_lines(others, whole=True).collect()}
    return lines


def files_by_header(
    spark: SparkSession, path: str | list[str], **options: str
) -> dict[str, list[str]]:
    """The files of each distinct header line; empty if all files have the same one.

    The first lines of a few files are read from the driver, of many by tasks. Names of files come
    to the driver, which lists them anyway.
    """
    wanted = {k: v for k, v in options.items() if k.lower() in LISTING}
    text = _loaded(spark.read.format("text").options(**wanted), path)
    files = sorted({unquote(f) for f in text.inputFiles()})
    if len(files) < 2:
        return {}
    lines: dict[str, str] = {}
    if len(files) <= FEW_FILES and "linesep" not in map(str.lower, wanted):
        with ThreadPoolExecutor(AT_A_TIME) as pool:
            found = pool.map(lambda file: _first_line(spark, file), files)
            lines = {file: line for file, line in zip(files, found, strict=True) if line is not None}
    rest = [file for file in files if file not in lines]
    if rest:
        session = spark.newSession()
        for name, value in ONE_FILE_A_TASK.items():
            session.conf.set(name, value)
        lines |= _first_lines_by_tasks(session, rest, wanted)
    groups: dict[str, list[str]] = {}
    for file in sorted(lines):
        groups.setdefault(lines[file], []).append(file)
    return groups if len(groups) > 1 else {}


def header_differs(error: Exception) -> bool:
    """Whether a job failed because a file's header isn't the one that its frame has."""
    return "CSV header" in str(error)


def _with_ragged(reader, frame: DataFrame, path: str | list[str]) -> DataFrame:
    """The frame again with ``RAGGED``. Rows keep the fields they share with the header."""
    names = frame.columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, RAGGED]])
    # with pruned columns Spark wouldn't see how many fields a row has
    told = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", RAGGED)
    rows = _loaded(told.schema(schema), path)
    # always true; Spark refuses to read the text of such rows without any other column
    some = column(names[0])
    read = some.isNull() | (F.length(some) >= 0)
    return rows.withColumn(RAGGED, F.when(read, F.col(RAGGED)))


def read_frames(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    look: bool = True,
    ragged: bool = False,
    **options: str,
) -> list[DataFrame]:
    """CSV files with a header line, all columns as text: one frame per distinct header.

    Columns keep their names whatever order a file has them in. Spark compares every file's
    header with that of its frame (``enforceSchema`` off), so that no value can get into another
    column. No type inference. Quotes inside quoted fields are doubled. ``multi_line`` allows line
    breaks in quoted fields, but then a file cannot be split over tasks.

    Without ``look`` all files are taken to have the same header, and reading them fails if they don't
    (``header_differs``). With ``ragged`` the frames have ``RAGGED`` as their last column: the text of
    rows with more or fewer fields than the header, which otherwise are cut or filled with nulls.
    """

    def read(frame_path: str | list[str], **more: str) -> DataFrame:
        reader = spark.read.format("csv").options(**(CSV_OPTIONS | options | more))
        reader = reader.option("enforceSchema", False).option("multiLine", multi_line)
        frame = _loaded(reader, frame_path)
        return _with_ragged(reader, frame, frame_path) if ragged and frame.columns else frame

    groups = files_by_header(spark, path, **options) if look else {}
    if not groups:
        frames = [read(path)]
    else:
        base = isinstance(path, str) and not set("*?[{") & set(path)
        frames = [read(files, **({"basePath": path} if base else {})) for files in groups.values()]
    if not all(frame.columns for frame in frames):
        raise EmptyInputError(f"no header and no records in {path}")
    return frames


def read_text_columns(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, **options: str
) -> DataFrame:
    """All columns of all files by name, as text; null where a file lacks a column."""
    frames = read_frames(spark, path, multi_line, **options)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def raw_records(frames: list[DataFrame], contract: Contract) -> DataFrame:
    """The contract's columns of all frames, as text, and ``RAGGED`` if they have it; raises if a frame
    lacks a column."""
    for frame in frames:
        check_columns(frame, contract)
    kept = [name for name in (RAGGED,) if all(name in frame.columns for frame in frames)]
    names = [column(name) for name in [*contract.names, *kept]]
    return reduce(DataFrame.unionAll, [frame.select(*names) for frame in frames])


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """The contract's columns by name, as text; raises if a file lacks one."""
    return raw_records(read_frames(spark, path, multi_line, **options), contract)


def read_records(
    spark: SparkSession,
    path: str | list[str],
    contract: Contract,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """The contract's columns by name, typed; values that do not parse are null."""
    return apply_contract(read_raw(spark, path, contract, multi_line, **options), contract)


def ragged_rows(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, **options: str
) -> DataFrame:
    """(file, text) of the rows that have more or fewer fields than the header of their file."""
    frames = read_frames(spark, path, multi_line, ragged=True, **options)
    rows = [
        frame.where(F.col(RAGGED).isNotNull()).select(
            F.col("_metadata.file_path").alias("file"), F.col(RAGGED).alias("text")
        )
        for frame in frames
    ]
    return reduce(DataFrame.unionAll, rows)
