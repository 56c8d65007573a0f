"""CSV and Parquet files as ordered frames."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ReadFailed
from ..operators.frame import ROW, Frame


def framed(df: DataFrame) -> Frame:
    """A DataFrame's rows in the order in which it gives them."""
    return Frame(df.withColumn(ROW, F.monotonically_increasing_id()), "row")


_own: list[str] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that driver and executors share; only local
    sessions without one use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ReadFailed("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="larkspur-"))
            atexit.register(shutil.rmtree, _own[0], True)
        shared = _own[0]
    return f"{shared.rstrip('/')}/larkspur/{tag}-{uuid.uuid4().hex}"


def _broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line has an odd number of quotes: a quoted field goes on in
    the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).where(quotes % 2 == 1).take(1))


def csv(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool | None = None) -> Frame:
    """CSV files with a header.  Types are inferred unless a schema is given
    (inference reads the files once more).  Empty fields are null; quoted
    fields may hold commas, quotes written twice and line feeds.

    Files are cut into splits, which line feeds inside quotes forbid: with
    ``multi_line`` each file is one task, without it such a field is an error.
    Not given, the files are looked through for a line that quotes leave open.
    Rows are in the order of the files' paths, then of their lines."""
    if not isinstance(path, str):
        raise TypeError("a path is a string")
    try:
        whole = _broken_lines(spark, path) if multi_line is None else multi_line
        reader = spark.read.options(header=True, multiLine=whole, quote='"', escape='"', mode="FAILFAST")
        df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
        names = [c if c else f"V{i}" for i, c in enumerate(df.columns)]
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"))
        return Frame(df.withColumn(ROW, place).toDF(*names, ROW), "row")
    except PySparkException as e:
        raise ReadFailed(f"Failed to read CSV: {e}") from e


def parquet(spark: SparkSession, path: str) -> Frame:
    if not isinstance(path, str):
        raise TypeError("a path is a string")
    try:
        return Frame(spark.read.parquet(path), "file")
    except PySparkException as e:
        raise ReadFailed(f"Failed to read Parquet: {e}") from e
