"""Journal files: lines with their byte offsets, read by Spark's own text reader from any store, as a batch or a tail."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def journal_lines(spark: SparkSession, path: str, start_offset: int = 0) -> DataFrame:
    """file, byte_offset, line_no (the offset again, a whole number that rises with the lines), line and complete of the
    lines that begin at start_offset or behind it (a cursor within a line goes on with the next).

    Files are read split by split; a line's offset is what its split holds before it and the splits before hold altogether.
    The last line is torn if the lines with a line feed each would be longer than the file."""
    raw = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("__size"), F.col("_metadata.file_block_start").alias("__split"), F.monotonically_increasing_id().alias("__id"))
    size = (F.octet_length("line") + 1).cast("long")
    inside = F.sum(size).over(W.partitionBy("file", "__split").orderBy("__id").rowsBetween(W.unboundedPreceding, -1))
    per = raw.groupBy("file", "__split").agg(F.sum(size).alias("__n"))
    before = per.select("file", "__split", F.sum("__n").over(W.partitionBy("file").orderBy("__split").rowsBetween(W.unboundedPreceding, -1)).alias("__before"))  # a row a split
    rows = raw.withColumn("__in", inside).join(before, ["file", "__split"])
    at = (F.coalesce("__before", F.lit(0)) + F.coalesce("__in", F.lit(0))).cast("long")
    out = rows.select("file", at.alias("byte_offset"), at.alias("line_no"), "line", (at + size <= F.col("__size")).alias("complete"))
    return out.filter(F.col("byte_offset") >= start_offset) if start_offset else out


def segment_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """line and file of the segments of these files, named as ``file`` names them: encoded as in an address, and no patterns."""
    plain = [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(name)) for name in files]
    return spark.read.option("lineSep", "\n").text(plain).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def journal_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = 16) -> DataFrame:
    """A stream of the lines of a folder's segment files as they come: line and file. Segments are whole when they appear (a
    writer commits them), so no line is torn. files_per_trigger bounds what is in flight; Spark then takes the files written
    first, whatever their names. None: all that are new."""
    stream = spark.readStream.option("lineSep", "\n")
    stream = stream if files_per_trigger is None else stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.text(folder).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
