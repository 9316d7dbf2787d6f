"""Reading series and writing their results."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolane.config import SeriesSpec
from tempolane.sources.shared import new_path, settled

LINE = "_line"
ROW = "_row"
SERIES = "_series"
# Files whose starts may be sent to all tasks; the lines of more are joined by shuffle.
MAX_SENT_FILES = 1_000_000


def read_series(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Numeric CSV with a header; the line order is the time order.

    Adds the order columns `_line` and `_row`: where the block of a file begins,
    counted through all files in the order of their names, and the row in the
    task that reads the block. Together they are unique and increase along the
    lines, so that a long series can be a folder of parts. With `one_per_file`, each file is a series of its own,
    named in `_series`. Types come from the header alone, without a pass over
    the data; text that is no number, or another header, stops the
    job; `read_series_leniently` sets such lines aside."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in names])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    lines = df.select(*[df[f"`{name}`"] for name in names], *_place())
    return lines if one_per_file else _through_files(spark, path, df, lines)


def _place() -> list:
    """A task may read several blocks, in any order, but each from its start to its end."""
    return [
        F.col("_metadata.file_path").alias(SERIES),
        F.col("_metadata.file_block_start").alias(LINE),
        F.monotonically_increasing_id().alias(ROW),
    ]


def _through_files(spark: SparkSession, path: str, df: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of one series: `_line` counts through all files in the order of their names."""
    # One row per file; its sizes come from the listing, not from its content.
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias(SERIES), F.col("_metadata.file_size").alias("size")
    )
    earlier = Window.orderBy(SERIES).rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(SERIES, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_tl_start"))
    if len(df.inputFiles()) <= MAX_SENT_FILES:
        starts = F.broadcast(starts)
    joined = lines.join(starts, SERIES)
    rest = [c for c in lines.columns if c not in (SERIES, LINE, ROW)]
    return joined.select(*[joined[f"`{c}`"] for c in rest], (F.col("_tl_start") + F.col(LINE)).alias(LINE), ROW)


class Parsed(NamedTuple):
    """`rows` as `read_series` gives them, and `rejects`: (_series, _line, _row, field,
    text) of what is no number, with the file, its block and the row in the block."""

    rows: DataFrame
    rejects: DataFrame


# What counts as a number: decimal, with or without an exponent, blanks around it.
NUMBER = r"^[ \t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"


def read_series_leniently(spark: SparkSession, path: str, one_per_file: bool = False) -> Parsed:
    """Like `read_series`, but lines that don't parse go to a table of their own.

    A line is rejected with each of its fields that is empty or no finite number. One
    with too many or too few fields is rejected once, with a null field and the whole
    line as text. Order columns of the other rows are as if the rejected ones were
    there. The files are read once: both tables come from a written one."""
    names = spark.read.option("header", True).csv(path).columns
    whole = "_tl_line"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, whole)])
    df = (
        spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", whole).csv(path)
    )
    cells = []
    for name in names:
        text = F.coalesce(df[f"`{name}`"], F.lit(""))
        value = F.when(text.rlike(NUMBER), text.try_cast("double"))
        cells.append((name, text, F.when(F.abs(value) < float("inf"), value)))
    bad = lambda field, text: F.struct(F.lit(field).cast("string").alias("field"), text.alias("text"))
    fields = F.filter(F.array(*[F.when(v.isNull(), bad(n, t)) for n, t, v in cells]), lambda x: x.isNotNull())
    rejects = F.when(F.col(whole).isNotNull(), F.array(bad(None, F.col(whole)))).otherwise(fields)
    parsed = df.select(*[v.alias(n) for n, _, v in cells], *_place(), rejects.alias("_tl_rejects"))
    parsed = settled(parsed, new_path(spark, "parsed"))
    good = parsed.where(F.size("_tl_rejects") == 0).drop("_tl_rejects")
    found = parsed.select(SERIES, LINE, ROW, F.explode("_tl_rejects").alias("r")).select(SERIES, LINE, ROW, "r.field", "r.text")
    return Parsed(good if one_per_file else _through_files(spark, path, df, good), found)


def series_spec(df: DataFrame, targets=()) -> SeriesSpec:
    """The specification of what `read_series` returns."""
    keys = [SERIES] if SERIES in df.columns else []
    return SeriesSpec(order=(LINE, ROW), values=[c for c in df.columns if c not in (LINE, ROW, SERIES)], keys=keys, targets=targets)


def _write_result(
    result: DataFrame, spec: SeriesSpec, path: str, place: list[str], run_id: str | None, fmt: str
) -> str:
    run_id = run_id or str(int(time.time()))
    # A range layout writes sorted files in parallel.
    by = [*spec.keys, *place]
    (
        result.withColumn("run_id", F.lit(run_id))
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .write.mode("append")
        .partitionBy("run_id")
        .option("header", True)
        .format(fmt)
        .save(path)
    )
    return run_id


def write_check(
    check: DataFrame, spec: SeriesSpec, path: str, run_id: str | None = None, fmt: str = "parquet"
) -> str:
    """Write check rows below `path/run_id=…`, in reading order; returns the id
    (seconds since 1970 unless given)."""
    return _write_result(check, spec, path, ["batch", "step"], run_id, fmt)


def write_forecast(
    forecast: DataFrame, spec: SeriesSpec, path: str, run_id: str | None = None, fmt: str = "parquet"
) -> str:
    """Write forecast rows; see `write_check`."""
    return _write_result(forecast, spec, path, ["step"], run_id, fmt)
