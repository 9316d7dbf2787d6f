"""Where intermediate tables live, so that a lost executor costs a re-read only."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Make this package known to the workers of a session it was not submitted
    with. Once per application; not needed with `--py-files` or an installation."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="tempolane-")) / "tempolane"
    # Only the copy is made here; Spark serves it to the executors.
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _sent.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, or the checkpoint folder set
    on the context. A local session without either gets a temporary one."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tempolane-")
    context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once and go on from the written table."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
