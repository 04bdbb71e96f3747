"""Where operators keep what must outlive a lost executor, and small guards for broadcasts and samples."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``. Only where it is unset and the driver is the one executor
    (master local, as in tests), a folder made once; on a cluster an unset folder is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tickforge.local.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tickforge-shared-")
        spark.conf.set("tickforge.local.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here and any executor can be lost. Who is
    done with such tables deletes them (``noted``); else they go with the folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that are written meanwhile, in order."""
    token = _made.set([])
    try:
        yield _made.get()
    finally:
        _made.reset(token)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def parts_for(spark: SparkSession, size: int, each: int = 16 << 20) -> int:
    """Into how many parts so many bytes are dealt: one for each ``each``, and not fewer than the session's partitions."""
    return max(shuffle_partitions(spark), -(-size // each))


def _bytes(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        flat = not isinstance(inner, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))
        return 24 + (F.greatest(F.size(c), F.lit(0)) * 8 if flat else F.aggregate(F.coalesce(c, F.array().cast(kind)), F.lit(0).cast("long"), lambda a, x: a + _bytes(x, inner).cast("long")))
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [_bytes(c.getField(f.name), f.dataType) for f in kind.fields], F.lit(16))
    return F.lit(16)


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if ``df``'s rows have at most ``most`` bytes, summed here; else ``df`` as it is, for a shuffled join."""
    row = reduce(lambda a, b: a + b, [_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], F.lit(16))
    return F.broadcast(df) if (df.agg(F.sum(row.cast("long"))).first()[0] or 0) <= most else df


def sampled(df: DataFrame, key: Column, n: int) -> DataFrame:
    """About ``n`` of the distinct 64-bit keys of ``df`` and all their rows, or all of both if there are no more: those of
    which a hash lies under a threshold taken from a count. Nothing but that count goes to the driver."""
    h = F.xxhash64(key, F.lit(77))
    found = df.select(F.approx_count_distinct(h, 0.02)).first()[0]
    if found <= n:
        return df
    return df.filter(h < int(-(2**63) + 2**64 * (n / found)))


def text_of(docs: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the columns an operator needs, so that others (of any name) cannot clash with its own."""
    return docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias(text_col), *[F.col(f"`{k}`") for k in keep])


def where(df: DataFrame, condition) -> DataFrame:
    """A filter that stays where it stands. One that is pushed down takes a copy of each expression it reads along; with
    stacked array functions such copies multiply."""
    holds = F.when(F.expr(condition) if isinstance(condition, str) else condition, 1).otherwise(-1)
    return df.filter(F.rand(0) + holds > 0)  # rand is in [0, 1)
