"""The context: a Spark session with a lifetime."""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .errors import ContextClosed
from .sources import files
from .table import Table


class Context:
    """Makes tables.  Given no session it takes the active one or starts one,
    and stops only what it started."""

    def __init__(self, spark: SparkSession | None = None, threads: int = 4):
        active = spark or SparkSession.getActiveSession()
        self._owns = active is None
        self.spark = active or SparkSession.builder.getOrCreate()
        self._pool = ThreadPoolExecutor(threads, thread_name_prefix="larkspur")
        self._closed = False

    def check(self) -> None:
        if self._closed:
            raise ContextClosed

    def submit(self, work, *args) -> Future:
        self.check()
        return self._pool.submit(work, *args)

    def read_csv(self, path: str, schema: str | None = None, multi_line: bool | None = None) -> Table:
        self.check()
        return Table(self, files.csv(self.spark, path, schema, multi_line))

    def read_csv_async(self, path: str, schema: str | None = None, multi_line: bool | None = None) -> Future[Table]:
        return self.submit(self.read_csv, path, schema, multi_line)

    def read_parquet(self, path: str) -> Table:
        self.check()
        return Table(self, files.parquet(self.spark, path))

    def table(self, df: DataFrame) -> Table:
        """A table over any DataFrame."""
        self.check()
        return Table(self, files.framed(df))

    def destroy(self) -> None:
        """Close; a second call does nothing.  Work not begun is cancelled."""
        if not self._closed:
            self._closed = True
            self._pool.shutdown(wait=False, cancel_futures=True)
            if self._owns:
                self.spark.stop()

    def __enter__(self) -> Context:
        self.check()
        return self

    def __exit__(self, *_) -> None:
        self.destroy()
