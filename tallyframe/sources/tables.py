"""Reading tables: plain, with a fixed schema, or stacked with a tag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.operators.running import running_sum


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small fixed table with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def stack_tagged(frames: Mapping[object, DataFrame], tag: str) -> DataFrame:
    """Tables of the same layout on top of one another, matched by position.

    Column names may be spelled differently; those of the first table are kept.
    Each row is marked with the key of its table.
    """
    tagged = [frame.withColumn(tag, F.lit(key)) for key, frame in frames.items()]
    return reduce(DataFrame.union, tagged)


def read_tagged(spark: SparkSession, paths: Sequence[str], tag: str, pattern: str) -> DataFrame:
    """Files of the same layout in one scan, marked with the part of the file name that ``pattern`` captures."""
    frame = spark.read.parquet(*paths)
    return frame.withColumn(tag, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def read_numbered(spark: SparkSession, paths: Sequence[str], out: str, format: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    """Rows of files with their number in file order from 1 on: files by their paths, rows as they stand in the file.

    Parquet knows the place of a row in its file, so only the row counts of the
    files are added up and the rows are not shuffled. Other formats (``csv``,
    ``text`` ...) know where the split of a row begins: rows are numbered within
    their split, which is never larger than the reader's partition size.
    """
    reader = spark.read.format(format).options(**options)
    frame = (reader.schema(schema) if schema else reader).load(list(paths))
    parquet = format == "parquet"
    block = F.lit(0).cast("long") if parquet else F.col("_metadata.file_block_start")
    place = F.col("_metadata.row_index") if parquet else F.monotonically_increasing_id()
    rows = frame.select("*", F.col("_metadata.file_path").alias("_file"), block.alias("_block"), place.alias("_place"))
    if not parquet:
        within = Window.partitionBy("_file", "_block").orderBy("_place")
        rows = rows.withColumn("_place", F.row_number().over(within) - 1)
    sizes = frame.select(F.col("_metadata.file_path").alias("_file"), block.alias("_block")).groupBy("_file", "_block").agg(F.count("*").alias("_size"))
    ends = running_sum(sizes, [], ["_file", "_block"], "_size", "_end").select("_file", "_block", (F.col("_end") - F.col("_size")).alias("_before"))
    numbered = rows.join(ends, ["_file", "_block"]).withColumn(out, (F.col("_before") + F.col("_place") + 1).cast("long"))
    return numbered.select(*frame.columns, out)
