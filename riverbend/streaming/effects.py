"""A side effect for each record of a stream, once per record.

``foreach`` calls a writer in the executors: ``open`` with the partition and
the epoch, ``process`` with every row, ``close``.  After a failure an epoch
runs again, so the effect must be idempotent for partition and epoch: here
the rendered records go to a file of their own that gets its name, the same
at every attempt, only when the partition has been read to its end.  A
retried partition replaces its file, an attempt that dies leaves a hidden one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

from riverbend.session import path_exists
from riverbend.sources.sinks import start_foreach
from riverbend.streaming.runner import await_query


def file_system(root: str):
    """The file system and path of a folder in shared storage, for use in a
    Python worker; ``file:`` and bare paths, and the schemes that Arrow knows (hdfs, s3, gs, abfs)."""
    from pyarrow import fs

    local = re.match(r"(?:file:)?/+", root)
    if local:
        return fs.LocalFileSystem(), "/" + root[local.end():].rstrip("/")
    system, path = fs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


def as_json(row: Row) -> str:
    """A record as one JSON line; what JSON has no form for, as text."""
    return json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False)


class RecordFiles:
    """Writer for ``foreach``: one line a record, rendered by ``render``."""

    def __init__(self, root: str, render: Callable[[Row], str] = as_json):
        self.root, self.render = root, render

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.system, root = file_system(self.root)
        folder = f"{root}/epoch={epoch_id}"
        self.system.create_dir(folder, recursive=True)
        self.done = f"{folder}/part-{partition_id:05d}.txt"
        self.growing = f"{folder}/.part-{partition_id:05d}.{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(self.growing)
        return True

    def process(self, row: Row) -> None:
        self.out.write((self.render(row).replace("\n", " ") + "\n").encode())

    def close(self, error: Exception | None) -> None:
        self.out.close()
        if error is None:
            self.system.move(self.growing, self.done)
        else:
            self.system.delete_file(self.growing)


def run_effects(stream: DataFrame, root: str, render: Callable[[Row], str] = as_json, timeout_s: float | None = None) -> None:
    """Process what ``stream`` has, each record once; run again on the same root, it goes on where it stopped."""
    root = root.rstrip("/")
    await_query(start_foreach(stream, RecordFiles(f"{root}/records", render), f"{root}/checkpoint"), timeout_s)


def rendered(spark: SparkSession, root: str) -> DataFrame:
    """The rendered records: ``value`` and the ``epoch`` that wrote each."""
    path = f"{root.rstrip('/')}/records"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "value string, epoch int")
    return spark.read.text(path)
