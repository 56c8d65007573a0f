"""Shared pieces of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import slices

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Settings under which whole texts travel to Python: ten thousand at once, out and back, take more memory than a small executor has
#: beside its heap.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
#: Shuffle files of a written table serve nothing once it is written.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: A key with more than this share of the rows, and more than so many rows, is dealt out over several tasks.
HOT_SHARE, HOT_ROWS = 5000, 256

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors all see: the
    session's ``spark.checkpoint.dir``.  Only a local session without one (as
    in tests) gets a folder of its own; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(shutil.rmtree, _own[app], True)
    return _own[app]


def small_batches(spark: SparkSession) -> None:
    """Set ``BATCHES`` for a session.  Operators leave a caller's session as it
    is; the queries and the pipeline set their own."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with other settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Tables written inside ``temporaries``, innermost last; and those that nothing has dropped yet.
_open: list[list[DataFrame]] = []
_left: dict[str, DataFrame] = {}


def written(df: DataFrame, tag: str, **options) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: it cuts
    the lineage, and a lost executor loses nothing of it.  What nobody drops
    goes when the program ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/larkspur/{tag}-{uuid.uuid4().hex}"
    with settings(spark, BATCHES | CLEANUP):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._larkspur_path = path
    if not _left:
        atexit.unregister(_drop_left)
        atexit.register(_drop_left)
    _left[path] = out
    if _open:
        _open[-1].append(out)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more."""
    for df in tables:
        path = getattr(df, "_larkspur_path", None)
        if path and _left.pop(path, None) is not None:
            drop_path(df.sparkSession.sparkContext, path)


def drop_path(sc: SparkContext, path: str | None) -> None:
    if path:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def _drop_left() -> None:
    for df in list(_left.values()):
        if df.sparkSession.sparkContext._jsc is not None:  # else the session has ended
            drop(df)


@contextmanager
def temporaries():
    """Tables written inside are dropped at the end, but for those that are
    given to the function this yields; they belong to what is around."""
    _open.append([])
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        for df in _open.pop():
            if any(df is k for k in kept):
                if _open:
                    _open[-1].append(df)
            else:
                drop(df)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted,
    never assumed); beyond that as it is, so that the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def hot_limit(rows: int) -> int:
    """Rows of a key beyond which it is hot, in a table of ``rows``."""
    return max(HOT_ROWS, rows // HOT_SHARE)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: str, rows: int, held: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on columns of the same names, where some
    keys may hold much of ``left``.

    A key that has more of the ``rows`` rows of ``left`` than ``hot_limit``
    says is cut into parts by a hash of the column ``by``, and its rows of
    ``right`` are sent to each part.  There are at most ``HOT_SHARE`` such
    keys, so they are broadcast.  ``held`` may give the rows of each key (``on``
    and ``held``); else they are counted."""
    limit = hot_limit(rows)
    counted = held if held is not None else left.groupBy(*on).agg(F.count("*").alias("held"))
    hot = F.broadcast(counted.where(F.col("held") > limit).select(*on, F.ceil(F.col("held") / limit).cast("int").alias("__parts")))
    part = F.pmod(F.xxhash64(by), F.coalesce("__parts", F.lit(1))).cast("int").alias("__part")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)).alias("__part")
    dealt = left.join(hot, on, "left").select(*left.columns, part)
    sent = right.join(hot, on, "left").select(*right.columns, parts)
    return dealt.join(sent, [*on, "__part"], how).drop("__part")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def passing(df: DataFrame, text_col: str, kind: T.DataType, work) -> tuple[DataFrame, str]:
    """``df`` with one more column, made by ``work(texts)`` from whole Arrow
    arrays of its texts, and that column's name."""
    out = unused(df, "made")
    names, at = df.columns, df.columns.index(text_col)
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    schema = T.StructType([*flat.schema.fields, T.StructField(out, kind)])

    def run(batches):
        for batch in batches:
            for part in slices(batch, f"c{at}"):
                yield pa.RecordBatch.from_arrays([*part.columns, work(part.column(at))], [*part.schema.names, out])

    return flat.mapInArrow(run, schema).toDF(*names, out), out
