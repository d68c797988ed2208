"""Binary files in the shared folder, written and read by tasks.

Only folders that all executors see may be used. Their addresses are made whole on the driver, by
``qualified``: a path without a scheme belongs to Hadoop's default file system, and not to the
machine that a task happens to run on. ``file:`` is for folders that are mounted everywhere. A file appears under its name in one step, so a task that runs twice, or is lost
half-way, leaves a whole file or none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from cohortlake.scratch import hadoop_path


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as Hadoop has it."""
    system, made = hadoop_path(spark, folder)
    return system.makeQualified(made).toString()


def place(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def write_file(folder: str, name: str, parts: Iterable[bytes]) -> int:
    """Write the parts to a file of its own, then give it its name. Returns the bytes written."""
    system, path = place(folder)
    system.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    system.move(own, f"{path}/{name}")
    return size


def open_file(folder: str, name: str):
    """A seekable file to read from."""
    system, path = place(folder)
    return system.open_input_file(f"{path}/{name}")
