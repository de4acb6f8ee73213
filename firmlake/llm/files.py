"""Binary files written and read by tasks in the shared folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from firmlake.session import scratch_path

MOST_TASKS = 20_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder that driver and executors share."""
    path = scratch_path(spark, name)
    return path if urlsplit(path).scheme else f"file://{path}"


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Written:
    """A file that appears under its name when it is complete, so that a task's second attempt replaces the first one's."""

    def __init__(self, folder: str, name: str):
        self.files, base = place(folder)
        self.files.create_dir(base, recursive=True)
        self.final, self.temporary = f"{base}/{name}", f"{base}/_{name}-{uuid.uuid4().hex}"
        self.uri = f"{folder}/{name}"
        self.stream = self.files.open_output_stream(self.temporary, compression=None)
        self.size = 0

    def write(self, data) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> str:
        self.stream.close()
        self.files.move(self.temporary, self.final)
        return self.uri


def read_bytes(uri: str) -> bytes:
    files, path = place(uri)
    with files.open_input_file(path) as stream:
        return stream.read()


def one_task_each(listed: DataFrame, column: str) -> DataFrame:
    """One row per stored file, dealt out over as many tasks as there are files, up to ``MOST_TASKS``."""
    return listed.repartition(max(1, min(listed.count(), MOST_TASKS)), column)
