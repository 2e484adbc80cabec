"""Log files as numbered lines, and folders of log files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from watchfold.functions.text import clean_utf8


def read_log_lines(
    spark: SparkSession, paths: str | list[str], numbered: bool = True
) -> DataFrame:
    """Lines of text files as ``file_path, line_number, raw``.

    The text scan stays splittable, so one huge file is read by many tasks. A
    line's number is its place within its split plus the lines of all earlier
    splits of the file. The second figure comes from a count per split, a table of
    one row for each 128 MB or so, which is joined back without a hint: Spark knows its
    measured size when it picks the join.

    Both scans must see the same splits. The join key holds the split's offset
    and its task, and a line that finds no partner fails the job rather than
    getting a wrong number. ``numbered=False`` skips the counting scan.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.spark_partition_id().alias("_task"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    raw = clean_utf8(F.col("value")).alias("raw")
    if not numbered:
        return lines.select("file_path", F.lit(None).cast("bigint").alias("line_number"), raw)

    splits = lines.groupBy("file_path", "_start", "_task").agg(
        F.count("*").alias("_n"), F.min("_id").alias("_first")
    )
    # One row per split of a file: the window runs over file size / split size rows.
    earlier = Window.partitionBy("file_path").orderBy("_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = splits.select(
        "file_path",
        "_start",
        "_task",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
    )
    number = F.coalesce(
        F.col("_id") + F.col("_offset"),
        F.raise_error(F.lit("text splits changed between two scans")).cast("bigint"),
    )
    return lines.join(offsets, ["file_path", "_start", "_task"], "left").select(
        "file_path", number.alias("line_number"), raw
    )


def read_log_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of lines; a stream has no line numbers."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.lit(None).cast("bigint").alias("line_number"),
        clean_utf8(F.col("value")).alias("raw"),
    )
