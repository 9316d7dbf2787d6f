"""Files that tasks write to, and read from, the shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MOST_TASKS = 50_000  # of a stage that has one for each file


def slots(spark: SparkSession, parts: int) -> list[int]:
    """For each of `parts` partitions a number that hash partitioning puts there, so
    that what is numbered already is dealt evenly."""
    tried = spark.range(0, 24 * parts + 200).select(F.col("id").cast("int").alias("x"))
    found = tried.groupBy(F.pmod(F.hash("x"), F.lit(parts)).alias("p")).agg(F.min("x").alias("x")).collect()
    by_part = {r["p"]: r["x"] for r in found}
    return [by_part.get(p, 0) for p in range(parts)]


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or a uri."""
    if "://" in folder or folder.startswith("file:"):
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = "file://" + folder[len("file:"):]
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


class Committed:
    """A file that gets its name when it is whole: `with` writes to a temporary
    name and moves it. A second attempt of a task puts the same bytes there."""

    def __init__(self, folder: str, name: str):
        self.fs, self.folder = store(folder)
        self.path = f"{self.folder}/{name}"
        self.part = f"{self.folder}/_tmp-{name}-{uuid.uuid4().hex}"
        self.size = 0

    def __enter__(self):
        self.fs.create_dir(self.folder, recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        return self

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)


def read_range(folder: str, name: str, start: int = 0, size: int | None = None) -> bytes:
    files, path = store(folder)
    with files.open_input_file(f"{path}/{name}") as f:
        return f.read_at(size if size is not None else f.size() - start, start)
