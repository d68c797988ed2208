"""Where staged tables go, and how finished ones get to their place."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, base: str | None = None) -> str:
    """A new folder name under ``base``, or else under the folder of ``spark.checkpoint.dir``, or
    else under the warehouse folder: each is one that all executors see."""
    base = (
        base
        or spark.conf.get(SETTING, None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{base.rstrip('/')}/cohortlake-{uuid.uuid4().hex}"


def staged(df: DataFrame, base: str | None = None) -> DataFrame:
    """Write a frame once, to a new folder, and go on from the written table: what follows reads
    it as often as it likes, also after executors are lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, base)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as Hadoop has it."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


@contextmanager
def temporary(spark: SparkSession, base: str | None = None) -> Iterator[str]:
    """A new folder for staged tables, which is removed at the end of the block: nothing that is
    read later may depend on it."""
    path = scratch_dir(spark, base)
    try:
        yield path
    finally:
        discard(spark, path)


def beside(path: str) -> str:
    """A new folder name next to a folder, so that ``publish`` can rename one into the other."""
    return f"{path.rstrip('/')}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that was made by this run, if it is there."""
    system, made = hadoop_path(spark, path)
    system.delete(made, True)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    system, made = hadoop_path(spark, path)
    if not system.rename(made, hadoop_path(spark, to)[1]):
        raise OSError(f"can't move {path} to {to}")


class Publication:
    """Finished folders that are put in place one after the other, as a block: if one can't be, or
    anything else in the block fails, those before it go back.

    What is replaced goes aside first and is removed at the end of the block. On file systems a
    rename is one step; object stores copy the files, so there use versioned tables.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._undo: list[Callable[[], None]] = []
        self._aside: list[str] = []

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind:
            for step in reversed(self._undo):
                step()
        for folder in self._aside:
            discard(self.spark, folder)

    def on_failure(self, step: Callable[[], None]) -> None:
        """What else to undo if the block fails."""
        self._undo.append(step)

    def replace(self, new: str, path: str, aside: str | None = None) -> None:
        """Put the folder ``new`` in the place of the one at ``path``."""
        system, place = hadoop_path(self.spark, path)
        if system.exists(place):
            if not aside:
                aside = beside(path)
                self._aside.append(aside)
            _rename(self.spark, path, aside)
            self.on_failure(lambda: _rename(self.spark, aside, path))
        else:
            system.mkdirs(place.getParent())
        _rename(self.spark, new, path)
        self.on_failure(lambda: _rename(self.spark, path, new))

    def replace_partitions(self, new: str, path: str, partitions: Iterable[str]) -> None:
        """Put the partitions that the folder ``new`` has in the places of those at ``path``; all others
        stay as they are."""
        aside = beside(path)
        self._aside += [aside, new]
        for part in partitions:
            folder = f"{aside}/{part}"
            system, made = hadoop_path(self.spark, folder)
            system.mkdirs(made.getParent())
            self.replace(f"{new}/{part}", f"{path.rstrip('/')}/{part}", folder)


def publish(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of the one at ``path``; if it can't be moved in, the old
    one goes back."""
    with Publication(spark) as publication:
        publication.replace(new, path)
